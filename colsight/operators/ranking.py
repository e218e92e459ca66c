"""First k rows per column. The rank limit runs before the shuffle (WindowGroupLimit),
so a task never sends more than k rows of a column, however large the column is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_rows(df: DataFrame, keys: list[str], order: list[Column], k: int, count: str = "count") -> DataFrame:
    """First k *rows* where a row of `df` stands for `count` equal rows."""
    values = top_per_group(df, keys, order, k, "value_rank")
    upto = Window.partitionBy(*keys).orderBy("value_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = values.withColumn("seen", F.sum(count).over(upto) - F.col(count)).where(F.col("seen") < k)
    repeats = F.least(F.col(count), F.lit(k) - F.col("seen"))
    return (
        start.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), repeats)))
        .withColumn("rank", (F.col("seen") + F.col("copy")).cast("int"))
        .drop("value_rank", "seen", "copy")
    )
