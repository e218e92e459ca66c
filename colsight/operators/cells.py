"""From tables to long form: one row per cell, then one row per distinct value.

The value-count table `(dataset, column_name, bucket, val, count)` is the shared input of
the profile and of the column-type detectors. Values are combined on the map side, so the
one shuffle carries distinct values per partition and is spread by value: a value that
fills a third of a table arrives as one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from colsight.functions.text import quoted, sql_text

INTEGER, REAL, DATETIME, TEXT = "INTEGER (LONG)", "REAL", "DATE/TIME", "TEXT"
KEY = ("dataset", "column_name")


def bucket_of(dtype: T.DataType) -> str | None:
    """Profile type of a Spark type; None for types that aren't profiled."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INTEGER
    if isinstance(dtype, T.DecimalType):
        return INTEGER if dtype.scale == 0 else REAL
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return REAL
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATETIME
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return TEXT
    return None


def profiled_columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, bucket_of(f.dataType)) for f in df.schema.fields if bucket_of(f.dataType)]


def type_dispatch(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, column_name, spark_type, bucket) from the schema alone; no job."""
    rows = []
    for f in df.schema.fields:
        bucket = bucket_of(f.dataType)
        shown = "CAST(NULL AS STRING)" if bucket is None else sql_text(bucket)
        rows.append(
            f"struct({sql_text(dataset)} AS dataset, {sql_text(f.name)} AS column_name, "
            f"{sql_text(f.dataType.simpleString())} AS spark_type, {shown} AS bucket)"
        )
    return df.sparkSession.range(1).selectExpr(f"inline(array({', '.join(rows)}))")


def _numbered_cells(df: DataFrame, first: int) -> DataFrame:
    """(c, val): every profiled cell as a string, with its column's number as text."""
    names = [n for n, _ in profiled_columns(df)]
    numbers = [str(first + i) for i in range(len(names))]
    as_text = df.selectExpr(*[f"CAST({quoted(n)} AS STRING) AS {quoted(i)}" for i, n in zip(numbers, names)])
    return as_text.unpivot([], [quoted(i) for i in numbers], "c", "val")


def _names(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    return [(dataset, name, bucket) for dataset, df in tables.items() for name, bucket in profiled_columns(df)]


def _named(numbered: DataFrame, names: list[tuple[str, str, str]]) -> DataFrame:
    """Replace the column number by (dataset, column_name, bucket), looked up in a constant array."""
    entries = ", ".join(
        f"struct({sql_text(d)} AS dataset, {sql_text(n)} AS column_name, {sql_text(b)} AS bucket)" for d, n, b in names
    )
    rest = [c for c in numbered.columns if c != "c"]
    return numbered.selectExpr(f"get(array({entries}), CAST(c AS INT)) AS k", *rest).select("k.*", *rest)


def _cells(tables: dict[str, DataFrame]) -> DataFrame:
    parts, first = [], 0
    for dataset, df in tables.items():
        width = len(profiled_columns(df))
        if not width:
            raise ValueError(f"{dataset} has no column of a profiled type")
        parts.append(_numbered_cells(df, first))
        first += width
    return reduce(DataFrame.union, parts)


def cells_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, bucket, val): every profiled cell as a string, null if empty."""
    return _named(_cells(tables), _names(tables))


def to_cells(df: DataFrame, dataset: str) -> DataFrame:
    return cells_of({dataset: df})


def value_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, bucket, val, count); empty cells are one row with a null val.

    Grouped by the column's number, not by its names, which keeps the shuffled rows short;
    the names come back by position afterwards.
    """
    counted = _cells(tables).groupBy("c", "val").agg(F.count(F.lit(1)).alias("count"))
    return _named(counted, _names(tables)).select("dataset", "column_name", "bucket", "val", "count")


def column_id() -> Column:
    return F.concat_ws(".", "dataset", "column_name")


def column_values(vc: DataFrame) -> DataFrame:
    """(column_id, val, count): the detectors' input."""
    return vc.select(column_id().alias("column_id"), "val", "count")


def per_column(tables: dict[str, DataFrame], stats: Callable[[str, str], dict[str, str] | list[dict[str, str]]]) -> DataFrame:
    """One row per column from one aggregation per table.

    `stats(reference, bucket)` names the output fields of a column and their aggregate
    SQL, as one dict or one per row wanted. All of a table's aggregates run in a single
    scan whose tasks send one row each; the schema unrolls the result into rows.
    """
    parts = []
    for dataset, df in tables.items():
        aggregates: list[str] = []
        rows: list[str] = []
        for name, bucket in profiled_columns(df):
            wanted = stats(quoted(name), bucket)
            for fields in [wanted] if isinstance(wanted, dict) else wanted:
                cells = [f"{sql_text(dataset)} AS dataset", f"{sql_text(name)} AS column_name"]
                for field, sql in fields.items():
                    aggregates.append(f"{sql} AS a{len(aggregates)}")
                    cells.append(f"a{len(aggregates) - 1} AS {field}")
                rows.append(f"struct({', '.join(cells)})")
        if rows:
            parts.append(df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))"))
    if not parts:
        raise ValueError("no column to aggregate")
    return reduce(DataFrame.unionByName, parts)


def cell_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, non_empty, empty) in one scan per table and no value shuffle."""
    return per_column(tables, lambda c, _: {"non_empty": f"count({c})", "empty": f"count_if({c} IS NULL)"})


def approx_distinct_counts(tables: dict[str, DataFrame], rsd: float = 0.02) -> DataFrame:
    """Opt-in sketch for columns too wide to group by value: fixed-size state per column."""
    return per_column(tables, lambda c, _: {"distinct_values": f"approx_count_distinct({c}, {rsd})"})


def distinct_counts(vc: DataFrame) -> DataFrame:
    """Exact distinct values: rows of the value-count table, so no second shuffle of values."""
    return vc.groupBy("dataset", "column_name").agg(
        F.coalesce(F.sum(F.when(F.col("val").isNotNull(), F.col("count"))), F.lit(0)).cast("bigint").alias("non_empty"),
        F.coalesce(F.sum(F.when(F.col("val").isNull(), F.col("count"))), F.lit(0)).cast("bigint").alias("empty"),
        F.count("val").alias("distinct_values"),
    )


def key_candidates(vc: DataFrame, strict: bool = False) -> DataFrame:
    """Columns whose values don't repeat. `strict` counts an empty cell as one more value."""
    counts = distinct_counts(vc)
    if strict:
        rows = F.col("non_empty") + F.col("empty")
        values = F.col("distinct_values") + F.when(F.col("empty") > 0, 1).otherwise(0)
    else:
        rows, values = F.col("non_empty"), F.col("distinct_values")
    return counts.where(rows == values).select("dataset", "column_name", "distinct_values")
