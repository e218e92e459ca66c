"""Roll-ups over a corpus of profiles, and scores of predictions against labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from colsight.operators.cells import distinct_counts

# --- corpus -------------------------------------------------------------------------------


def columns_by_type(profile_columns: DataFrame) -> DataFrame:
    """(type, columns): a column that holds several types counts for each."""
    return (
        profile_columns.select(F.explode("data_types").alias("t"))
        .groupBy(F.col("t.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("columns"))
    )


def cells_by_type(profile_columns: DataFrame) -> DataFrame:
    """(type, cells)."""
    return (
        profile_columns.select(F.explode("data_types").alias("t"))
        .groupBy(F.col("t.type").alias("type"))
        .agg(F.sum("t.count").alias("cells"))
    )


def completeness(vc: DataFrame) -> DataFrame:
    """Mean non-empty, empty and distinct cells per column of the corpus."""
    return distinct_counts(vc).agg(
        F.count(F.lit(1)).alias("columns"),
        F.round(F.avg("non_empty"), 4).alias("mean_non_empty"),
        F.round(F.avg("empty"), 4).alias("mean_empty"),
        F.round(F.avg("distinct_values"), 4).alias("mean_distinct"),
    )


# --- hand labels ------------------------------------------------------------------------------


def labelled_weight(labelled: DataFrame) -> DataFrame:
    """(column_id, label, weight) from `(column_id, labels, val, count)`; blank and NULL values don't
    count. A column with several labels gives its weight to each."""
    solid = (F.col("val") != "") & (F.col("val") != "NULL")
    weight = F.coalesce(F.sum(F.when(solid, F.col("count"))), F.lit(0)).cast("bigint").alias("weight")
    return labelled.groupBy("column_id", "labels").agg(weight).select("column_id", F.explode("labels").alias("label"), "weight")


def _one_name(label: str, alias: Mapping[str, str]) -> Column:
    out = F.trim(label)
    known = F.create_map(*[F.lit(x) for pair in alias.items() for x in pair]) if alias else None
    return out if known is None else F.coalesce(F.element_at(known, out), out)


def precision_recall(predictions: DataFrame, labels: DataFrame, alias: Mapping[str, str] | None = None) -> DataFrame:
    """(label, tp, fp, fn, precision, recall) from `(column_id, types)` and `(column_id, labels)`.

    Only columns that have a label are scored. `alias` maps other spellings to the types' names.
    """
    alias = alias or {}
    truth = labels.select("column_id", F.explode("labels").alias("label")).select(
        "column_id", _one_name("label", alias).alias("label")
    )
    known = labels.select("column_id").distinct()
    guess = (
        predictions.join(known, "column_id", "left_semi")
        .select("column_id", F.explode("types").alias("label"))
        .select("column_id", _one_name("label", alias).alias("label"))
    )
    sides = truth.select("column_id", "label", F.lit(1).alias("t"), F.lit(0).alias("g")).unionByName(
        guess.select("column_id", "label", F.lit(0).alias("t"), F.lit(1).alias("g"))
    )
    cell = sides.groupBy("column_id", "label").agg(F.max("t").alias("t"), F.max("g").alias("g"))
    t, g = F.col("t") == 1, F.col("g") == 1
    counts = cell.groupBy("label").agg(
        F.count_if(t & g).alias("tp"), F.count_if(~t & g).alias("fp"), F.count_if(t & ~g).alias("fn")
    )
    return counts.select(
        "label", "tp", "fp", "fn",
        F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 4).alias("precision"),
        F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 4).alias("recall"),
    )


def eval_summary(predictions: DataFrame, scores: DataFrame) -> DataFrame:
    """(columns, typed, precision): columns seen, columns given a type, precision over all types."""
    zero = F.lit(0).cast("bigint")
    seen = predictions.agg(
        F.count(F.lit(1)).alias("columns"), F.count_if(F.size("types") > 0).alias("typed")
    ).select("columns", "typed", zero.alias("tp"), zero.alias("fp"))
    hits = scores.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp")).select(
        zero.alias("columns"), zero.alias("typed"), "tp", "fp"
    )
    return (
        seen.unionByName(hits)
        .agg(*[F.sum(c).alias(c) for c in ("columns", "typed", "tp", "fp")])
        .select("columns", "typed", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 4).alias("precision"))
    )
