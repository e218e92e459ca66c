"""Registered queries, each with the SQL that must give the same rows in DuckDB."""

from suite import q_files, q_folder, q_generic, q_phrases, q_semantic, q_text  # noqa: F401
from suite.corpus import ORACLES, QUERIES  # noqa: F401
