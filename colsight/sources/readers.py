"""Readers. Each file layout has a `parse_*` step that works on lines from anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight.functions.text import ascii_escaped, file_name
from colsight.plans.profile import PROFILE_SCHEMA

VALUE_COUNT_SCHEMA = "val string, count string"

# --- tables and catalogs ------------------------------------------------------------------


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(dataset): first field of a tab-separated file without header."""
    return parse_catalog(spark.read.text(path))


def parse_catalog(lines: DataFrame) -> DataFrame:
    return lines.select(F.split_part("value", F.lit("\t"), F.lit(1)).alias("dataset")).where(F.col("dataset") != "")


def select_datasets(
    catalog: DataFrame, skip: DataFrame | None = None, offset: int = 0, limit: int | None = None
) -> DataFrame:
    """Catalog without the datasets in `skip(dataset)`, optionally one batch of it in id order."""
    out = catalog if skip is None else catalog.join(skip, "dataset", "left_anti")
    if not offset and limit is None:
        return out
    out = out.orderBy("dataset").offset(offset)
    return out if limit is None else out.limit(limit)


def read_table(spark: SparkSession, path: str, fmt: str = "tsv", spread: bool = False) -> DataFrame:
    """A typed table: Parquet, or tab-separated text with header and inferred types.

    A gzip file is one split whatever its size. `spread=True` shuffles its rows over the
    cluster after the read; no other input needs it.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = spark.read.csv(path, sep="\t", header=True, inferSchema=True)
    return df.hint("repartition") if spread else df


# --- value counts ----------------------------------------------------------------------------


def column_id_of(file: Column) -> Column:
    """`<dataset>.<column>` from a file name `<dataset>.<column>.txt[.gz]`."""
    return F.regexp_replace(file, r"\.txt(\.gz)?$", "")


def read_value_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column_id, val, count) of all value-count files under `path`, as one DataFrame."""
    raw = (
        spark.read.schema(VALUE_COUNT_SCHEMA)
        .csv(path, sep="\t", quote="")
        .select(column_id_of(file_name()).alias("column_id"), "val", "count")
    )
    return repair_value_counts(raw)


def _whole_count() -> Column:
    return F.when(F.col("count").rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim("count").try_cast("bigint"))


def repair_value_counts(raw: DataFrame, escape: bool = False) -> DataFrame:
    """Counts that aren't whole numbers become 0, so that the row stays; `escape` brings the values of
    such rows to ASCII."""
    whole = _whole_count()
    if escape:
        raw = raw.withColumn("val", F.when(whole.isNull(), ascii_escaped(F.col("val"))).otherwise(F.col("val")))
    return raw.withColumn("count", F.coalesce(whole, F.lit(0).cast("bigint")))


def value_count_misfits(spark: SparkSession, path: str) -> DataFrame:
    """(column_id, problem, value): lines of value-count files that aren't a value and its count.

    `short` has no count, `long` more than two fields, `count` a count that isn't a whole number.
    Read beside `read_value_counts`, which keeps what it can of them.
    """
    lines = spark.read.text(path).select(column_id_of(file_name()).alias("column_id"), "value").where("value <> ''")
    fields = F.split("value", "\t", -1)
    split = lines.select("column_id", "value", F.size(fields).alias("n"), F.get(fields, F.lit(1)).alias("count"))
    problem = F.when(F.col("n") < 2, "short").when(F.col("n") > 2, "long").when(_whole_count().isNull(), "count")
    return split.select("column_id", problem.alias("problem"), "value").where("problem IS NOT NULL")


def read_labelled_column(spark: SparkSession, path: str) -> DataFrame:
    """(column_id, labels, val, count) of hand-labelled value-count files; see `split_labelled`."""
    raw = spark.read.text(path).select(file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    return split_labelled(raw)


def split_labelled(raw: DataFrame) -> DataFrame:
    """`(file, block, line, value)` -> `(column_id, labels, val, count)`.

    A file's first line holds its labels, separated by commas; the others are `val <tab>
    count`. The first line is the one with the least (block, line); it is found for each file by
    a partial minimum and joined back on the file. The id is the file's name without its ending.
    """
    first = raw.groupBy("file").agg(F.min(F.struct("block", "line", "value")).alias("first"))
    labels = F.filter(F.transform(F.split("first.value", ","), lambda x: F.trim(F.split_part(x, F.lit("\t"), F.lit(1)))), lambda x: x != "")
    heads = first.select("file", labels.alias("labels"), F.col("first.block").alias("b"), F.col("first.line").alias("l"))
    rows = raw.join(heads, "file").where((F.col("block") != F.col("b")) | (F.col("line") != F.col("l")))
    val, count = F.split_part("value", F.lit("\t"), F.lit(1)), F.split_part("value", F.lit("\t"), F.lit(2))
    known = F.when(val != "", val)
    return repair_value_counts(rows.select(column_id_of(F.col("file")).alias("column_id"), "labels", known.alias("val"), count.alias("count")))


# --- lists and labels ---------------------------------------------------------------------------


def parse_terms(lines: DataFrame, strict: bool = True) -> DataFrame:
    """(term) from lines of comma-separated terms; quotes around a term keep its commas, and a
    quote inside is doubled.

    `strict=False` reads lists as older ones were written: brackets, all quotes and all blanks go.
    """
    if not strict:
        parts = lines.select(F.explode(F.split("value", ",")).alias("part"))
        bare = F.replace(F.regexp_replace("part", r"[\"'\[\]]", ""), F.lit(" "), F.lit(""))
        return parts.select(bare.alias("term")).where(F.col("term") != "")
    quoted = r'''\s*"((?:[^"]|"")*)"\s*(?:,|$)|([^,]+)(?:,|$)'''
    fields = lines.select(F.explode(F.regexp_extract_all("value", F.lit(quoted), F.lit(0))).alias("part"))
    whole = F.trim(F.regexp_replace("part", r",$", ""))
    inner = F.when(whole.startswith('"') & whole.endswith('"') & (F.length(whole) > 1), F.replace(F.regexp_replace(whole, r'^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(whole)
    return fields.select(inner.alias("term")).where(F.col("term") != "")


def read_keywords(spark: SparkSession, path: str, semantic_type: str, strict: bool = True) -> DataFrame:
    """(semantic_type, term)."""
    return parse_terms(spark.read.text(path), strict).select(F.lit(semantic_type).alias("semantic_type"), "term")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """(name) from a bracketed list."""
    return parse_terms(spark.read.text(path), strict=False).withColumnRenamed("term", "name")


def parse_labels(lines: DataFrame) -> DataFrame:
    """(column_id, labels) from `id <tab> ['a', 'b']`."""
    return lines.select(
        column_id_of(F.split_part("value", F.lit("\t"), F.lit(1))).alias("column_id"),
        F.regexp_extract_all(F.split_part("value", F.lit("\t"), F.lit(2)), F.lit("'([^']*)'"), F.lit(1)).alias("labels"),
    ).where(F.col("column_id") != "")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return parse_labels(spark.read.text(path))


def read_regex(spark: SparkSession, path: str) -> str:
    """A stored pattern: the one line of a small text file."""
    return spark.read.text(path, wholetext=True).first()["value"].rstrip("\n")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles written by `write_profiles`, with their schema given."""
    return spark.read.schema(PROFILE_SCHEMA).json(path)


# --- pages ----------------------------------------------------------------------------------------


def link_acronyms(pages: DataFrame) -> DataFrame:
    """(page_id, name, acronym): link texts that end in a bracketed acronym, split in two."""
    anchors = pages.select(
        "page_id", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<a(?:\s[^>]*)?>(.*?)</a>"), F.lit(1))).alias("inner")
    )
    text = F.trim(F.regexp_replace(F.regexp_replace("inner", r"(?s)<[^>]*>", ""), r"\s+", " "))
    pattern = r"^(?:(.*) )?\(([^ ]*)\)$"
    return (
        anchors.select("page_id", text.alias("text"))
        .where(F.col("text").rlike(pattern))
        .select("page_id", F.regexp_extract("text", pattern, 1).alias("name"), F.regexp_extract("text", pattern, 2).alias("acronym"))
    )
