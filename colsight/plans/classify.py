"""The whole column typing: patterns first, the other detectors only where none matched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from colsight import rules as R
from colsight.operators import semantic as S

FOUND = "array<struct<semantic_type: string, label: string, count: bigint>>"


def _either(condition: Column, column: Column, zero: object) -> Column:
    return F.when(condition, column).otherwise(F.lit(zero).cast("double" if isinstance(zero, float) else "bigint"))


def _measures(vc: DataFrame, keywords: DataFrame, entities: DataFrame, rules: tuple, kinds: list[str]) -> DataFrame:
    """One row per column with every sum the decisions need: one join, one grouping."""
    names = list(S.ENTITY_LABELS)
    terms = keywords.select(F.col("semantic_type").alias("kind"), "term").unionByName(
        entities.select(F.col("label").alias("kind"), "term")
    )
    marks = kinds + names
    return (
        S.with_codes(S._marked(vc, terms, "kind", marks))
        .groupBy("column_id")
        .agg(
            *[c.alias(n) for n, c in S._shape_measures().items()],
            *[S.weight(F.col("val").rlike(r.pattern)).alias(f"p_{r.semantic_type}") for r in rules],
            *[S.weight(S._has(marks, k)).alias(f"k_{k}") for k in kinds],
            *[S.weight(S._has(marks, k)).alias(f"w_{k}") for k in names],
        )
    )


def classify(
    vc: DataFrame,
    keywords: DataFrame,
    entities: DataFrame,
    rules: tuple = R.PATTERN_RULES,
    thresholds: dict[str, float] | None = None,
    gated: bool = False,
    entity_clears: bool = True,
) -> DataFrame:
    """One row per column.

    column_id, count_all, col_length, `<detector>_share`, `<detector>_weight`, types
    array<string>, found array<struct<semantic_type, label, count>>, types_count (the
    weights of all detectors, also of those below their threshold).

    `gated` also asks the column name to look like a city or a person; `entity_clears`
    lets a city or person drop initials, colour and make found before.
    """
    thresholds = dict(R.KEYWORD_THRESHOLDS if thresholds is None else thresholds)
    wide = _measures(vc, keywords, entities, rules, list(thresholds))
    total = F.col("total")

    # patterns
    first: list[tuple[Column, Column]] = []
    pattern_columns: dict[str, Column] = {}
    for r in rules:
        w = F.col(f"p_{r.semantic_type}")
        share = S.ratio(w, total)
        kind = F.when(S._reached(share, r), S._rule_type(r, F.col("average_length")))
        first.append((kind, w))
        pattern_columns[f"{r.semantic_type}_share"] = share
        pattern_columns[f"{r.semantic_type}_weight"] = w
    pairs = [F.struct(kind.alias("type"), w.alias("count")) for kind, w in first]
    known = wide.withColumns(pattern_columns).withColumn(
        "first", F.filter(F.array(*pairs), lambda p: p["type"].isNotNull())
    )
    known = known.withColumn("open", F.size("first") == 0)

    # the rest, where no pattern matched
    is_open, few = F.col("open"), F.col("n_values") <= R.FEW_VALUES
    shapes = S._shape_outcomes()
    later: dict[str, Column] = {}
    for name, o in shapes.items():
        later[f"{name}_share"] = _either(is_open, o["share"], 0.0)
        later[f"{name}_weight"] = _either(is_open, o["weight"], 0)
        later[f"{name}_type"] = F.when(is_open, o["semantic_type"])
    entity = S._entity_outcome(gated, few)
    for name in ("city", "person"):
        later[f"{name}_share"] = _either(is_open, entity[f"{name}_share"], 0.0)
        later[f"{name}_weight"] = _either(is_open, entity[f"{name}_weight"], 0)
    later["entity_type"] = F.when(is_open, entity["type"])
    for k, t in thresholds.items():
        share = S.ratio(F.col(f"k_{k}"), total)
        later[f"{k}_share"] = _either(is_open, share, 0.0)
        later[f"{k}_weight"] = _either(is_open, F.col(f"k_{k}"), 0)
        later[f"{k}_type"] = F.when(is_open & (share >= t), F.lit(k))
    known = known.withColumns(later)

    def pair(kind: Column, w: Column) -> Column:
        return F.struct(kind.alias("type"), w.alias("count"))

    cleared = F.col("entity_type").isNotNull() if entity_clears else F.lit(False)
    early = [pair(F.when(~cleared, F.col(f"{n}_type")), F.col(f"{n}_weight")) for n in ("initials", "color", "car_make")]
    borough = [pair(F.col("borough_type"), F.col("borough_weight"))]
    named = [pair(F.col("entity_type"), F.col("city_weight") + F.col("person_weight"))]
    listed = [pair(F.col(f"{k}_type"), F.col(f"{k}_weight")) for k in thresholds]
    second = F.filter(F.array(*early, *borough, *named, *listed), lambda p: p["type"].isNotNull())
    known = known.withColumn("hits", F.concat("first", second))

    def entry(p: Column) -> Column:
        as_label = p["type"].isin(list(R.LABEL_TYPES))
        return F.struct(
            F.when(~as_label, p["type"]).otherwise(F.lit("")).alias("semantic_type"),
            F.when(as_label, p["type"]).otherwise(F.lit("")).alias("label"),
            p["count"].alias("count"),
        )

    detectors = [r.semantic_type for r in rules] + [*shapes, "city", "person", *thresholds]
    weights = sum((F.col(f"{d}_weight") for d in detectors), F.lit(0).cast("bigint"))
    return known.select(
        "column_id",
        F.col("total").alias("count_all"),
        F.col("average_length").alias("col_length"),
        *[c for d in detectors for c in (f"{d}_share", f"{d}_weight")],
        F.transform("hits", lambda p: p["type"]).alias("types"),
        F.transform("hits", entry).cast(FOUND).alias("found"),
        weights.cast("bigint").alias("types_count"),
    )


def predictions(report: DataFrame) -> DataFrame:
    """(column_id, types): what evaluation reads."""
    return report.select("column_id", "types")


def types_found(report: DataFrame) -> DataFrame:
    """(n): columns that were given at least one type."""
    return report.agg(F.count_if(F.size("types") > 0).alias("n"))


def predicted_rows(report: DataFrame) -> DataFrame:
    """(column_id, semantic_type, label, count): one row per predicted type."""
    return report.select("column_id", F.inline("found"))


def semantic_json(report: DataFrame) -> DataFrame:
    """(column_name, semantic_type[...], count): one row per column, ready for the JSON sink."""
    return report.select(
        F.col("column_id").alias("column_name"), F.col("found").alias("semantic_type"), F.col("types_count").alias("count")
    )


def share_report(report: DataFrame, vc: DataFrame) -> DataFrame:
    """Flat report: id, mean and spread of the scaled counts, weight, length, one share per
    detector, types joined with `|`, and their weight."""
    shares = [c for c in report.columns if c.endswith("_share")]
    return report.join(S.scaled_count_stats(vc), "column_id").select(
        "column_id", "mean", "stdv", "count_all", "col_length", *shares,
        F.array_join("types", "|").alias("types"), "types_count",
    )
