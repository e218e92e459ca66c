"""Quality rules as a ledger of failure bits.

Every rule is evaluated once a document: its measurements and one bit a rule go to the
ledger. A policy is a mask of bits; applying another policy, or finding out what a rule
alone rejects, is integer arithmetic on the ledger and never reads a text again.

Words are runs of anything but ASCII white space. A null or empty text has no words and
fails `few_words`. Repeated rows are judged alike; no state is kept between documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from colsight.llm.common import WordHashes, grams, map_arrow, mix, names_apart, texts

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ellipsis_lines", "n_bullet_lines")

# rule -> SQL over the measurements that is true if the document fails; the place is the bit
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "ellipsis_lines": "10 * n_ellipsis_lines > 3 * n_lines",
    "bullet_lines": "10 * n_bullet_lines > 9 * n_lines",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = ("few_words", "repeated_words")
POLICIES = {"base": BASE, "v1": (*BASE, "symbols", "duplicate_lines"), "v2": tuple(RULES)}


def mask(rules) -> int:
    return sum(BITS[r] for r in rules)


def _repeat_words(hashes: np.ndarray) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    if len(hashes) < 4:
        return 0
    windows = mix(grams(hashes, 3))
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[place] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def measure(docs: DataFrame, carried: bool = False) -> DataFrame:
    """(doc_id, the measurements) of every whole text; `carried` adds them to all columns of `docs`,
    as `m_<name>`."""
    names = [f"m_{m}" for m in MEASURES] if carried else list(MEASURES)

    def make():
        memo = WordHashes()

        def one(text: bytes | None, chars: int) -> tuple:
            words = text.split() if text else []
            if not words:
                return (0, 0, sum(text.count(s) for s in SYMBOLS) if text else 0, 0, 0, 0, 0, 0)
            lines = [x for x in text.split(b"\n") if x.strip()]
            ends = [x.strip() for x in lines]
            return (
                len(words),
                chars - (len(text) - sum(map(len, words))),
                sum(text.count(s) for s in SYMBOLS),
                len(lines) - len(set(lines)),
                _repeat_words(memo.of(words)),
                len(lines),
                sum(x.endswith((b"...", "…".encode())) for x in ends),
                sum(x.startswith((b"- ", b"* ", "•".encode())) for x in ends),
            )

        def run(batch):
            if batch is None:
                return []
            chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            found = np.array([one(t, c) for t, c in zip(texts(batch), chars)], np.int64)
            columns = batch.columns if carried else [batch.column("doc_id")]
            before = batch.schema.names if carried else ["doc_id"]
            return [pa.RecordBatch.from_arrays([*columns, *(pa.array(found[:, i]) for i in range(len(names)))], [*before, *names])]

        return run

    rows = docs if carried else docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = StructType([*(rows.schema.fields if carried else rows.schema.fields[:1]), *(StructField(m, LongType()) for m in names)])
    return map_arrow(rows, make, schema)


def ledger(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """(doc_id, measurements, failed bigint): bit i of `failed` is rule i."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, rule in enumerate(rules.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed)


def apply_policy(rows: DataFrame, rules) -> DataFrame:
    """`kept` of the ledger's rows under a policy."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(rules))) == 0)


def ablation(rows: DataFrame, rules) -> DataFrame:
    """(rule, rejected, alone): documents a rule rejects, and those no other rule of the policy does.

    Counts per bit pattern come first (at most 2^rules rows), rules after.
    """
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(rules))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("bigint").alias("bit")) for r in rules)))
    return (
        patterns.select("bits", "n", each.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("alone"),
        )
    )


@names_apart
def keep(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """`docs` without what the policy rejects. The measurements travel with their row, so nothing
    is joined and rows without doc_id are judged too."""
    passed = F.lit(True)
    for rule in POLICIES[policy]:
        passed = passed & ~F.expr(re.sub(r"\b(" + "|".join(MEASURES) + r")\b", r"m_\1", RULES[rule]))
    return measure(docs, carried=True).where(passed).select(*docs.columns)


def quality(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed)."""
    rows = apply_policy(ledger(docs), POLICIES[policy])
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"), "failed",
    )
