"""Generic profile: one nested row per dataset, or one flat row per column and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from colsight.operators import cells, generic
from colsight.operators.cells import DATETIME, INTEGER, REAL, TEXT
from colsight.operators.ranking import top_per_group, top_rows
from colsight.plans.staging import stage
from colsight.sources.corpus import Corpus

KEY = list(cells.KEY)
TYPE_FIELDS = (
    "type string, count bigint, max_value string, min_value string, mean double, stddev double, "
    "shortest_values array<string>, longest_values array<string>, average_length double"
)


def _colon(fields: str) -> str:
    return ", ".join(": ".join(f.strip().split(" ", 1)) for f in fields.split(","))


PROFILE_SCHEMA = (
    "dataset string, key_column_candidates array<string>, columns array<struct<column_name: string, "
    "number_non_empty_cells: bigint, number_empty_cells: bigint, number_distinct_values: bigint, "
    f"frequent_values: array<string>, data_types: array<struct<{_colon(TYPE_FIELDS)}>>, "
    "semantic_types: array<struct<semantic_type: string, label: string, count: bigint>>>>"
)


def _in_order(rows: DataFrame, name: str) -> DataFrame:
    """Ranked values of each column as one array; at most k entries per column."""
    return rows.groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "val"))), lambda r: r["val"]).alias(name)
    )


def _typed(rows: DataFrame, kind: str | None, *fields: str) -> DataFrame:
    """Rows of one profile type in the common layout of TYPE_FIELDS."""
    present = {"type", "count", *fields}
    typed = rows.withColumn("type", F.lit(kind)) if kind else rows
    layout = [f.strip().split(" ", 1) for f in TYPE_FIELDS.split(",")]
    return typed.selectExpr(*KEY, *[f"CAST({n if n in present else 'NULL'} AS {t}) AS {n}" for n, t in layout])


def column_types(tables: dict[str, DataFrame] | None, kinds: DataFrame, k: int = 5, nan_to_zero: bool = False) -> DataFrame:
    """One row per column and type found in it: the entries of `data_types`.

    `kinds` is the value-count table with the kind, numbers and date of each value. Only native
    numbers are read from the tables themselves; without tables they are read from the values too.
    """
    if tables is None:
        numbers = generic.value_number_stats(kinds, nan_to_zero)
    else:
        numbers = generic.text_number_stats(kinds, nan_to_zero)
        native = generic.native_number_stats(tables, nan_to_zero)
        if native is not None:
            numbers = native.unionByName(numbers)
    dates = (
        kinds.where((F.col("kind") == "date") & F.col("as_ts").isNotNull())
        .groupBy(*KEY)
        .agg(F.sum("count").alias("count"), *generic._latest(F.struct("as_ts", "val")))
    )
    texts = kinds.where((F.col("kind") == "text") & (F.col("bucket") == TEXT))
    filled = texts.where(F.col("val") != "").withColumn("length", F.char_length("val"))
    shortest = top_rows(filled, KEY, [F.asc("length"), F.asc("val")], k)
    longest = top_rows(filled, KEY, [F.desc("length"), F.asc("val")], k)
    solid = F.col("val") != ""
    text_rows = (
        texts.groupBy(*KEY)
        .agg(
            F.sum("count").alias("count"),
            (
                F.sum(F.when(solid, F.char_length("val") * F.col("count"))) / F.sum(F.when(solid, F.col("count")))
            ).alias("average_length"),
        )
        .join(_in_order(shortest, "shortest_values"), KEY, "left")
        .join(_in_order(longest, "longest_values"), KEY, "left")
    )
    return (
        _typed(numbers, None, "max_value", "min_value", "mean", "stddev")
        .unionByName(_typed(dates, DATETIME, "max_value", "min_value"))
        .unionByName(_typed(text_rows, TEXT, "shortest_values", "longest_values", "average_length"))
    )


def profile_columns(
    tables: dict[str, DataFrame], k: int = 5, staged: bool = True, nan_to_zero: bool = False
) -> DataFrame:
    """One row per column: counts, key flag, frequent values, `data_types`.

    The tables are scanned twice whatever their number of columns: once for the value
    counts, once for the moments of native numbers. `staged` writes the interpreted value counts
    before the four steps that read them; without it each step plans its own grouping.
    """
    kinds = generic.with_kind(cells.value_counts(tables))
    return columns_of_values(stage(kinds) if staged else kinds, tables, k, nan_to_zero)


def columns_of_values(kinds: DataFrame, tables: dict[str, DataFrame] | None = None, k: int = 5, nan_to_zero: bool = False) -> DataFrame:
    """The same from value counts with their kinds, wherever they come from."""
    type_order = F.array_position(F.array(*[F.lit(t) for t in (INTEGER, REAL, DATETIME, TEXT)]), F.col("type"))
    fields = [f.strip().split(" ")[0] for f in TYPE_FIELDS.split(",")]
    entries = (
        column_types(tables, kinds, k, nan_to_zero)
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct(type_order.alias("position"), *fields))).alias("data_types"))
        .withColumn("data_types", F.transform("data_types", lambda e: F.struct(*[e[f].alias(f) for f in fields])))
    )
    ranked = top_per_group(kinds.where(F.col("val").isNotNull()), KEY, [F.desc("count"), F.asc("val")], k)
    return (
        cells.distinct_counts(kinds)
        .join(_in_order(ranked, "frequent_values"), KEY, "left")
        .join(entries, KEY, "left")
        .select(
            *KEY,
            F.col("non_empty").alias("number_non_empty_cells"),
            F.col("empty").alias("number_empty_cells"),
            F.col("distinct_values").alias("number_distinct_values"),
            F.coalesce("frequent_values", F.array().cast("array<string>")).alias("frequent_values"),
            F.coalesce("data_types", F.expr(f"CAST(array() AS array<struct<{_colon(TYPE_FIELDS)}>>)")).alias(
                "data_types"
            ),
            F.expr("CAST(array() AS array<struct<semantic_type: string, label: string, count: bigint>>)").alias(
                "semantic_types"
            ),
        )
    )


def nest(columns: DataFrame) -> DataFrame:
    """One row per dataset. A dataset's array is as long as its schema."""
    fields = [c for c in columns.columns if c != "dataset"]
    is_key = F.col("number_non_empty_cells") == F.col("number_distinct_values")
    return columns.groupBy("dataset").agg(
        F.array_sort(F.collect_list(F.when(is_key, F.col("column_name")))).alias("key_column_candidates"),
        F.sort_array(F.collect_list(F.struct(*fields))).alias("columns"),
    )


def profile(tables: dict[str, DataFrame], k: int = 5, staged: bool = True) -> DataFrame:
    """`dataset, key_column_candidates, columns[...]`, ready for the JSON sink."""
    return nest(profile_columns(tables, k, staged))


def profile_folder(
    spark: SparkSession, path: str | list[str], catalog: DataFrame | None = None, skip: DataFrame | None = None, sep: str = "\t", k: int = 5
) -> DataFrame:
    """Profiles of all delimited files under `path`, or of those a catalog names: one scan, and a plan
    and a number of jobs that don't depend on how many files there are."""
    values = Corpus(spark, path, catalog, skip, sep).value_counts()
    return nest(columns_of_values(stage(generic.with_kind(values)), k=k))


def flatten(columns: DataFrame) -> DataFrame:
    """One row per column and type, arrays joined with `|`."""
    entry = F.col("entry")
    return columns.withColumn("entry", F.explode_outer("data_types")).select(
        *KEY,
        F.col("number_non_empty_cells"),
        F.col("number_empty_cells"),
        F.col("number_distinct_values"),
        (F.col("number_non_empty_cells") == F.col("number_distinct_values")).alias("is_key"),
        F.array_join("frequent_values", "|").alias("frequent_values"),
        entry["type"].alias("type"),
        entry["count"].alias("count"),
        entry["max_value"].alias("max_value"),
        entry["min_value"].alias("min_value"),
        F.round(entry["mean"], 4).alias("mean"),
        F.round(entry["stddev"], 4).alias("stddev"),
        F.array_join(entry["shortest_values"], "|").alias("shortest_values"),
        F.array_join(entry["longest_values"], "|").alias("longest_values"),
        F.round(entry["average_length"], 4).alias("average_length"),
    )


def enrich_profile(columns: DataFrame, predictions: DataFrame) -> DataFrame:
    """Attach predicted types `(dataset, column_name, semantic_type, label, count)` to a profile."""
    found = predictions.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("semantic_type", "label", "count"))).alias("found")
    )
    return (
        columns.join(found, KEY, "left")
        .withColumn("semantic_types", F.coalesce("found", "semantic_types"))
        .drop("found")
    )
