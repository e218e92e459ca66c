"""Tables written as delimited files of different headers and profiled as one folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from colsight.functions.text import quoted
from colsight.plans import batch, merge, profile as P
from colsight.sources import readers
from colsight.sources.corpus import Corpus, misfit_counts
from suite.corpus import MESSY, SPARSE, register, tables
from suite.q_files import folder, named_files, table_folders
from suite.q_generic import _KINDS, _profile_sql, RAW


def field(column) -> F.Column:
    """A cell as a file holds it: empty for null, quoted if empty text or if it holds a quote or tab."""
    text = column.cast("string")
    escaped = F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))
    return F.when(text.isNull(), "").when((text == "") | text.contains('"') | text.contains("\t"), escaped).otherwise(text)


def lines_of(name: str, df: DataFrame) -> DataFrame:
    """(file, place, value): a table's header and rows as lines."""
    head = "\t".join(df.columns)
    rows = df.select(F.concat_ws("\t", *[field(F.col(quoted(c))) for c in df.columns]).alias("value"))
    if len(df.columns) == 1:  # others have a tab; asking would make each line twice
        rows = rows.where("value <> ''")
    named = rows.select(F.lit(f"{name}.tsv").alias("file"), F.lit("1").alias("place"), "value")
    return df.sparkSession.sql(f"SELECT '{name}.tsv' AS file, '0' AS place, r'{head}' AS value").unionByName(named)


def folder_of(s: SparkSession, d: str, extra: DataFrame | None = None) -> str:
    named = {n: s.read.parquet(f"{d}/{n}.parquet").select(*RAW[n][1]) for n in _FILES}
    named |= {**tables(s, d, MESSY), **tables(s, d, SPARSE)}
    lines = reduce(DataFrame.unionByName, [lines_of(n, df) for n, df in named.items()])
    names = [f"{n}.tsv" for n in named]
    return table_folders(lines if extra is None else lines.unionByName(extra), names)


_FILES = ("customer", "part", "orders")
# columns whose values all read as numbers or times get such a type, whatever the table's own
_READ = {"whole": "DOUBLE", "odd.name `x`": "BIGINT"}
_CORPUS = {t: RAW[t] for t in _FILES} | {
    t: (table, {c: f"CAST(({e}) AS {_READ[c]})" if c in _READ else e for c, e in cols.items()}) for t, (table, cols) in {**MESSY, **SPARSE}.items()
}
_TYPES = {
    **{c: k for c, k in {**_KINDS, "o_orderdate": "DATE/TIME", "placed": "DATE/TIME"}.items()},
    "whole": "REAL", "odd.name `x`": "INTEGER (LONG)", "id": "INTEGER (LONG)", "id_or_null": "INTEGER (LONG)", "one_null": "INTEGER (LONG)", "price": "REAL",
}


def _folder_profile(s, d):
    return P.flatten(P.profile_folder(s, f"{folder_of(s, d)}/*").select("dataset", F.inline("columns")))


register("folder_profile", _folder_profile, _profile_sql(_CORPUS, _TYPES))

# lines that lack fields, have too many, or open a quote and don't close it
_BAD = {"short": "o_orderkey % 7 = 3", "long": "o_orderkey % 7 = 4", "open quote": "o_orderkey % 7 = 5 AND o_custkey % 2 = 0"}


def _folder_misfits(s, d):
    orders = s.read.parquet(f"{d}/orders.parquet")
    row = "concat_ws('\\t', o_orderkey, o_custkey, o_orderstatus)"
    value = f"CASE WHEN {_BAD['short']} THEN CAST(o_orderkey AS STRING) WHEN {_BAD['long']} THEN {row} || '\\tmore' WHEN {_BAD['open quote']} THEN {row} || '\"\\t' ELSE {row} END"
    value = value.replace(f"{row} || '\"\\t'", "concat_ws('\\t', o_orderkey, o_custkey, '\"open')")
    rows = orders.selectExpr("'damaged.tsv' AS file", "'1' AS place", f"{value} AS value")
    head = s.sql("SELECT * FROM VALUES ('damaged.tsv', '0', 'a\\tb\\tc'), ('whole.tsv', '0', 'x\\ty'), ('whole.tsv', '1', '1\\t'), ('none.tsv', '0', 'only a header') AS t(file, place, value)")
    root = table_folders(head.unionByName(rows), ["damaged.tsv", "whole.tsv", "none.tsv"])
    return misfit_counts(Corpus(s, f"{root}/*"))


register(
    "folder_misfits",
    _folder_misfits,
    f"""SELECT 'damaged' AS dataset, count(*) AS rows, count(*) FILTER ({_BAD["short"]}) AS short, count(*) FILTER ({_BAD["long"]}) AS long,
    count(*) FILTER ({_BAD["open quote"]}) AS open_quote FROM orders UNION ALL SELECT 'whole', 1, 0, 0, 0 UNION ALL SELECT 'none', 0, 0, 0, 0""",
)

# value counts with lines that lack a count, have a third field or no number; odd letters in them
_LINE = "CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN concat_ws(chr(9), 'é ' || p_name || ' \"' || chr(39) || '\\\\', 'many') WHEN 2 THEN concat_ws(chr(9), p_name, '3', 'x') ELSE concat_ws(chr(9), p_name, CAST(p_size AS STRING)) END"


def _odd_counts(s, d):
    rows = s.read.parquet(f"{d}/part.parquet").selectExpr("'ab.odd.txt' AS file", "lpad(p_partkey, 12, '0') AS place", f"{_LINE} AS value")
    return named_files(rows, ["ab.odd.txt"])


register(
    "value_count_misfits",
    lambda s, d: readers.value_count_misfits(s, _odd_counts(s, d)),
    f"""SELECT 'ab.odd' AS column_id, CASE p_partkey % 6 WHEN 0 THEN 'short' WHEN 1 THEN 'count' ELSE 'long' END AS problem,
    {_LINE.replace(chr(92) * 2, chr(92)).replace(chr(92) + '"', '"')} AS value FROM part WHERE p_partkey % 6 < 3""",
)


def _escaped_counts(s, d):
    raw = s.read.schema(readers.VALUE_COUNT_SCHEMA).csv(_odd_counts(s, d), sep="\t", quote="", escape="")
    return readers.repair_value_counts(raw, escape=True)


register(
    "escaped_values",
    _escaped_counts,
    r"""SELECT CASE WHEN p_partkey % 6 = 1 THEN '\xc3\xa9 ' || p_name || ' "\''\\' ELSE p_name END AS val,
    CAST(CASE p_partkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE p_size END AS BIGINT) AS count FROM part""",
)

# --- batches and merged profiles -----------------------------------------------------------------------


def _batch(s, d):
    """A catalog with a table that is skipped, one that isn't there and one that can't be read, run twice."""
    root = folder_of(s, d)
    broken = s.sql("SELECT 'bad.tsv.gz' AS file, '' AS place, 'no gzip' AS value")
    path = s._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(s._jsc.hadoopConfiguration())
    bad = named_files(broken, ["bad.tsv.gz"])
    fs.rename(path(f"{bad}/bad.tsv.gz"), path(root))
    catalog = s.sql("SELECT explode(array('customer', 'part', 'messy', 'bad', 'missing', 'sparse', 'part')) AS dataset")
    skip, out = s.sql("SELECT 'messy' AS dataset"), folder(s)
    batch.profile_catalog(s, catalog, root, out, skip, size=3)
    ledger = batch.profile_catalog(s, catalog, root, out, skip, size=3)
    cells = batch.read_batch(s, out).select("dataset", F.inline("columns")).groupBy("dataset").agg(F.sum("number_non_empty_cells").alias("filled"))
    return ledger.join(cells, "dataset", "left").select("dataset", "state", F.col("error").isNotNull().alias("has_error"), "filled")


_SPARSE_FILLED = " + ".join(f"count({e})" for e in SPARSE["sparse"][1].values())
register(
    "batch_ledger",
    _batch,
    f"""SELECT 'customer' AS dataset, 'done' AS state, false AS has_error, CAST(5 * count(*) AS BIGINT) AS filled FROM customer UNION ALL SELECT 'part', 'done', false, 6 * count(*) FROM part
    UNION ALL SELECT 'sparse', 'done', false, {_SPARSE_FILLED} FROM orders UNION ALL SELECT 'bad', 'failed', true, NULL UNION ALL SELECT 'missing', 'failed', true, NULL""",
)


def _halves(s, d):
    named = {n: s.read.parquet(f"{d}/{n}.parquet").select(*RAW[n][1]) for n in _FILES}
    return [{n: df.where(f"pmod({df.columns[0]}, 3) {test} 0") for n, df in named.items()} for test in ("=", "<>")]


register(
    "merged_profile",
    lambda s, d: P.flatten(merge.profile_state(merge.merge_values(*[merge.value_state(h) for h in _halves(s, d)]))),
    _profile_sql({t: RAW[t] for t in _FILES}, _TYPES),
)
_MERGED_COLUMNS = [(t, c) for t in _FILES for c in RAW[t][1]]
register(
    "merged_states",
    lambda s, d: merge.read_columns(merge.merge_columns(*[merge.column_states(h) for h in _halves(s, d)])).select(
        "dataset", "column_name", "non_empty", "empty", *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "low", "high")], "least", "greatest"
    ),
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, count({c}) AS non_empty, count(*) - count({c}) AS empty, "
        + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, round(CAST(min({c}) AS DOUBLE), 4) AS low, round(CAST(max({c}) AS DOUBLE), 4) AS high, CAST(NULL AS VARCHAR) AS least, CAST(NULL AS VARCHAR) AS greatest" if c in _KINDS
           else f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest")
        + f" FROM {t}"
        for t, c in _MERGED_COLUMNS
    ),
)
