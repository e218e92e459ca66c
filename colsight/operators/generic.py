"""Statistics of a column: frequent values, numbers, dates, texts, mixed types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from colsight.functions.interpret import REAL_PATTERN, interpret_int, interpret_real, with_interpretation
from colsight.functions.text import quoted
from colsight.operators.cells import DATETIME, INTEGER, KEY, REAL, TEXT, per_column, profiled_columns, value_counts
from colsight.operators.dates import settled
from colsight.operators.ranking import top_per_group, top_rows

COLUMN = list(KEY)


def frequent_values(vc: DataFrame, k: int = 5) -> DataFrame:
    """(dataset, column_name, rank, val, count); ties by value."""
    filled = vc.where(F.col("val").isNotNull())
    return top_per_group(filled, COLUMN, [F.desc("count"), F.asc("val")], k).select(*COLUMN, "rank", "val", "count")


# --- numbers --------------------------------------------------------------------------


def _moments(kind: str, ref: str, nan_to_zero: bool) -> dict[str, str]:
    out = {"max_value": f"max({ref})", "min_value": f"min({ref})", "mean": f"avg({ref})", "stddev": f"stddev_samp({ref})"}
    if nan_to_zero:
        out = {k: f"CASE WHEN isnan(CAST({v} AS DOUBLE)) THEN 0 ELSE coalesce({v}, 0) END" for k, v in out.items()}
    types = {"max_value": "STRING", "min_value": "STRING", "mean": "DOUBLE", "stddev": "DOUBLE"}
    return {"type": f"'{kind}'", "count": f"count({ref})", **{k: f"CAST({v} AS {types[k]})" for k, v in out.items()}}


def native_number_stats(tables: dict[str, DataFrame], nan_to_zero: bool = False) -> DataFrame | None:
    """Statistics of native number columns: one scan per table without grouping. None without any."""
    chosen = {t: df.select(*[quoted(n) for n, b in profiled_columns(df) if b in (INTEGER, REAL)]) for t, df in tables.items()}
    chosen = {t: df for t, df in chosen.items() if df.columns}
    if not chosen:
        return None
    return per_column(chosen, lambda ref, bucket: [_moments(bucket, ref, nan_to_zero)]).where(F.col("count") > 0)


def text_number_stats(values: DataFrame, nan_to_zero: bool = False) -> DataFrame:
    """Statistics of the integers and reals in string columns, from distinct values with their
    counts, `as_int` and `as_real`: each value is read once, not each cell."""
    return _weighted_stats(values.where(F.col("bucket") == TEXT), nan_to_zero)


def value_number_stats(values: DataFrame, nan_to_zero: bool = False) -> DataFrame:
    """The same for all columns where only values and counts are at hand: number columns are
    read by their type, string columns value by value."""
    whole = F.when(F.col("bucket") == INTEGER, F.col("val").try_cast("decimal(38,0)")).when(F.col("bucket") == TEXT, F.col("as_int").cast("decimal(38,0)"))
    real = F.when(F.col("bucket") == REAL, F.col("val").try_cast("double")).when(F.col("bucket") == TEXT, F.col("as_real"))
    return _weighted_stats(values.withColumns({"as_int": whole, "as_real": real}), nan_to_zero)


def _weighted_stats(values: DataFrame, nan_to_zero: bool) -> DataFrame:
    """The spread is summed around the mean, which takes a second pass over the values and loses
    nothing to cancellation; the means are one row per column."""
    texts = values.where(F.col("as_int").isNotNull() | F.col("as_real").isNotNull())
    kinds = {"as_int": INTEGER, "as_real": REAL}

    def sums(expr: str, name: str) -> list[Column]:
        return [F.expr(expr.format(c)).alias(f"{name}_{c}") for c in kinds]

    counted = texts.groupBy(*COLUMN).agg(
        *sums("CAST(sum(CASE WHEN {0} IS NOT NULL THEN count END) AS BIGINT)", "n"),
        *sums("sum(CAST({0} AS DOUBLE) * count)", "s"),
        *sums("CAST(max({0}) AS STRING)", "max"),
        *sums("CAST(min({0}) AS STRING)", "min"),
    )
    means = counted.select(*COLUMN, *[(F.col(f"s_{c}") / F.col(f"n_{c}")).alias(f"mean_{c}") for c in kinds])
    spread = (
        texts.join(means, COLUMN)
        .groupBy(*COLUMN)
        .agg(*[F.sum(F.col("count") * F.pow(F.col(c) - F.col(f"mean_{c}"), 2)).alias(f"ss_{c}") for c in kinds])
    )
    rows = []
    for c, kind in kinds.items():
        stddev = f"CASE WHEN n_{c} > 1 THEN sqrt(ss_{c} / (n_{c} - 1)) END"
        rows.append(
            f"struct('{kind}' AS type, n_{c} AS count, max_{c} AS max_value, min_{c} AS min_value, "
            f"s_{c} / n_{c} AS mean, {f'coalesce({stddev}, 0D)' if nan_to_zero else stddev} AS stddev)"
        )
    return counted.join(spread, COLUMN).selectExpr(*COLUMN, f"inline(array({', '.join(rows)}))").where(F.col("count") > 0)


def numeric_stats(tables: dict[str, DataFrame], nan_to_zero: bool = False, interpret: bool = True) -> DataFrame:
    """(dataset, column_name, type, count, max_value, min_value, mean, stddev).

    Native columns in one scan per table that shuffles one row per task. String columns are
    read as integers and as reals (`interpret`), each distinct value once.
    """
    parts = [native_number_stats(tables, nan_to_zero)]
    if interpret:
        texts = {t: df.select(*[quoted(n) for n, b in profiled_columns(df) if b == TEXT]) for t, df in tables.items()}
        texts = {t: df for t, df in texts.items() if df.columns}
        if texts:
            numbers = {"as_int": interpret_int(F.col("val")), "as_real": interpret_real(F.col("val"))}
            parts.append(text_number_stats(value_counts(texts).withColumns(numbers), nan_to_zero))
    found = [p for p in parts if p is not None]
    if not found:
        raise ValueError("no column to aggregate")
    return reduce(DataFrame.unionByName, found)


def describe_columns(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, column_name, count, mean, stddev, min, max) of every profiled column, one pass."""

    def stats(ref: str, bucket: str) -> dict[str, str]:
        number = f"CAST({ref} AS DOUBLE)" if bucket in (INTEGER, REAL) else "CAST(NULL AS DOUBLE)"
        return {
            "count": f"count({ref})",
            "mean": f"avg({number})",
            "stddev": f"stddev_samp({number})",
            "min": f"CAST(min({ref}) AS STRING)",
            "max": f"CAST(max({ref}) AS STRING)",
        }

    return per_column({dataset: df}, stats)


def integral_reals(vc: DataFrame) -> DataFrame:
    """Values that read as a real number with nothing after the point."""
    return (
        vc.where(F.col("val").rlike(REAL_PATTERN))
        .withColumn("as_real", F.trim("val").try_cast("double"))
        .where(F.col("as_real") % 1 == 0)
        .select(*COLUMN, "val", F.col("as_real").cast("bigint").alias("as_int"), "count")
    )


# --- dates ----------------------------------------------------------------------------


def _latest(order: Column) -> list[Column]:
    return [F.max_by("val", order).alias("max_value"), F.min_by("val", order).alias("min_value")]


def date_stats(vc: DataFrame, level: str = "high") -> DataFrame:
    """(dataset, column_name, count, max_value, min_value): the original strings of the extremes.

    Native dates and strings that read as dates. The condition sits inside the aggregates:
    as a filter it would move below the grouping and parse every cell instead of every value.
    """
    known = with_kind(vc, level)
    order = F.when((F.col("kind") == "date") & F.col("as_ts").isNotNull(), F.struct("as_ts", "val"))
    return (
        known.groupBy(*COLUMN)
        .agg(F.sum(F.when(order.isNotNull(), F.col("count"))).alias("count"), *_latest(order))
        .where(F.col("count") > 0)
    )


def date_range(tables: dict[str, DataFrame]) -> DataFrame:
    """Latest and earliest value of native date columns in one scan without grouping."""

    def stats(ref: str, bucket: str) -> list[dict[str, str]]:
        extremes = {"max_value": f"CAST(max({ref}) AS STRING)", "min_value": f"CAST(min({ref}) AS STRING)"}
        return [{"count": f"count({ref})", **extremes}] if bucket == DATETIME else []

    return per_column(tables, stats)


# --- texts ----------------------------------------------------------------------------


def _not_blank(vc: DataFrame) -> DataFrame:
    return vc.where(F.col("val").isNotNull() & (F.col("val") != ""))


def text_extremes(vc: DataFrame, longest: bool, k: int = 5, distinct: bool = False) -> DataFrame:
    """k shortest or longest non-blank values; equal cells repeat unless `distinct`."""
    sized = _not_blank(vc).withColumn("length", F.char_length("val"))
    order = [F.desc("length") if longest else F.asc("length"), F.asc("val")]
    ranked = (top_per_group if distinct else top_rows)(sized, COLUMN, order, k)
    return ranked.select(*COLUMN, "rank", "val", "length")


def text_average_length(vc: DataFrame) -> DataFrame:
    weight = F.sum("count")
    return _not_blank(vc).groupBy(*COLUMN).agg(
        weight.alias("count"),
        (F.sum(F.char_length("val") * F.col("count")) / weight).alias("average_length"),
    )


# --- mixed types ----------------------------------------------------------------------


def with_kind(vc: DataFrame, level: str = "high", by_column: bool = False) -> DataFrame:
    """Kind and date of each value: from its column for native types, from the value itself
    for strings. Adds kind, as_ts and, for strings, as_int and as_real. With `by_column` the order
    of day and month and the century are settled per column."""
    bucket = F.col("bucket")
    native = F.when(bucket == INTEGER, "int").when(bucket == REAL, "real").when(bucket == DATETIME, "date")
    read = with_interpretation(vc.withColumn("_text", F.when(bucket == TEXT, F.col("val"))), "_text", level, settled if by_column else None)
    return read.select(
        *vc.columns,
        F.when(F.col("val").isNotNull(), F.coalesce(native, F.col("kind"))).alias("kind"),
        F.when(bucket == DATETIME, F.col("val").try_cast("timestamp_ntz")).otherwise(F.col("as_ts")).alias("as_ts"),
        "as_int",
        "as_real",
    )


def mixed_type_counts(vc: DataFrame, level: str = "high") -> DataFrame:
    """Cells of each kind per column; the five counts add up to the non-empty cells."""
    text_columns = vc.where(F.col("bucket") == TEXT)

    def weight(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("count"))), F.lit(0)).cast("bigint")

    return with_interpretation(text_columns, "val", level).groupBy(*COLUMN).agg(
        weight("int").alias("n_int"),
        weight("real").alias("n_real"),
        weight("date").alias("n_date"),
        weight("text").alias("n_text"),
        weight("unclassified").alias("n_unclassified"),
    )
