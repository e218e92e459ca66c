"""Profiles that go on: the state of an earlier profile merged with that of new rows.

Exact state: the raw value counts `(dataset, column_name, val, count)`. Two states are added value by value,
and types are chosen anew from what the values of both rule out, so the profile of the sum is the profile of
all rows, also where new rows change a column's type.

Small state: a row a column with counts, moments, extremes and a distinct-count sketch, for columns
whose values are too many to keep. Moments are merged around their means, sketches by their union;
all but the distinct count are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from colsight.operators import generic
from colsight.operators.cells import INTEGER, KEY, REAL, per_column, value_counts
from colsight.plans.profile import columns_of_values
from colsight.plans.staging import stage
from colsight.sources import corpus as C

RAW = [*KEY, "val"]


def value_state(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, val, count) of tables as they are."""
    return value_counts(tables).select(*RAW, "count")  # one row a column and value already


def merge_values(*states: DataFrame) -> DataFrame:
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    return whole.groupBy(*RAW).agg(F.sum("count").alias("count"))


def profile_state(state: DataFrame, k: int = 5) -> DataFrame:
    """One row per column from a value state; types by what the values rule out."""
    return columns_of_values(stage(generic.with_kind(typed_values(stage(state)))), k=k)


def typed_values(state: DataFrame) -> DataFrame:
    """(dataset, column_name, bucket, val, count) of a staged value state, values as their column's type writes them.

    A join over the columns' names leaves a column's rows in one task, where they would be grouped as well;
    so the types are staged, which shows their size, and the rows are dealt by value before they are grouped.
    """
    typed = stage(C.column_types(state.withColumnRenamed("column_name", "place")).withColumnRenamed("place", "column_name"))
    read = state.join(typed, list(KEY)).select(*KEY, "bucket", C.as_type(F.col("type")).alias("val"), "count")
    return read.repartition(*KEY, "val").groupBy(*KEY, "bucket", "val").agg(F.sum("count").alias("count"))


# --- small state ---------------------------------------------------------------------------------------

STATE = ("non_empty", "empty", "n", "mean", "m2", "low", "high", "least", "greatest", "sketch")


def column_states(tables: dict[str, DataFrame], precision: int = 14) -> DataFrame:
    """(dataset, column_name, ...STATE): one scan a table; a sketch has a fixed size."""

    def stats(ref: str, bucket: str) -> dict[str, str]:
        number = f"CAST({ref} AS DOUBLE)" if bucket in (INTEGER, REAL) else "CAST(NULL AS DOUBLE)"
        return {
            "non_empty": f"count({ref})", "empty": f"count_if({ref} IS NULL)", "n": f"count({number})", "mean": f"avg({number})",
            "m2": f"var_pop({number}) * count({number})", "low": f"min({number})", "high": f"max({number})",
            "least": f"CAST(min({ref}) AS STRING)", "greatest": f"CAST(max({ref}) AS STRING)", "sketch": f"hll_sketch_agg(CAST({ref} AS STRING), {precision})",
        }

    # least and greatest as text are kept for columns that aren't numbers
    out = per_column(tables, stats)
    text = F.col("n") == 0
    return out.withColumns({c: F.when(text, F.col(c)) for c in ("least", "greatest")})


def merge_columns(*states: DataFrame) -> DataFrame:
    """States of the same columns as one; moments are shifted to the common mean."""
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    total = whole.groupBy(*KEY).agg((F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("n") > 0, F.col("n")))).alias("common"))
    shift = F.col("mean") - F.col("common")
    return whole.join(total, list(KEY)).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("non_empty", "empty", "n")],
        F.max("common").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def read_columns(state: DataFrame) -> DataFrame:
    """(dataset, column_name, non_empty, empty, mean, stddev, low, high, least, greatest, about_distinct)."""
    stddev = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))
    return state.select(*KEY, "non_empty", "empty", "mean", stddev.alias("stddev"), "low", "high", "least", "greatest", F.hll_sketch_estimate("sketch").alias("about_distinct"))
