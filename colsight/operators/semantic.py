"""What a column means, from its value counts `(column_id, val, count)`.

Every detector is a weighted conditional sum, so all of them share one grouping by
column with fixed-size state. Word lists and entity names of unknown size are joined on
the value; lists that are plain arguments become literals of the expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight import rules as R
from colsight.functions.text import first_word, soundex_code, sql_text
from colsight.rules import PatternRule

ENTITY_LABELS = ("GPE", "PERSON", "ORG")


def weight(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0)).cast("bigint")


def total_weight() -> Column:
    return F.sum("count").cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    return F.when(part > 0, part / whole).otherwise(F.lit(0.0))


def _reached(share: Column, rule: PatternRule) -> Column:
    return (share > rule.threshold) if rule.strict else (share >= rule.threshold)


def _rule_type(rule: PatternRule, average_length: Column) -> Column:
    if rule.short_type is None:
        return F.lit(rule.semantic_type)
    return F.when(average_length >= rule.split_length, rule.semantic_type).otherwise(rule.short_type)


def _pattern(rule: PatternRule, ignore_case: bool) -> str:
    return f"(?i){rule.pattern}" if ignore_case else rule.pattern


def _stack(wide: DataFrame, entries: list[dict[str, Column]]) -> DataFrame:
    """One row per detector from one row per column."""
    structs = [F.struct(*[c.alias(n) for n, c in e.items()]) for e in entries]
    return wide.select("column_id", F.inline(F.array(*structs)))


# --- columns as a whole ----------------------------------------------------------------


def column_weights(vc: DataFrame) -> DataFrame:
    """(column_id, count_all, n_values, col_length): weight, rows, mean value length."""
    return vc.groupBy("column_id").agg(
        total_weight().alias("count_all"),
        F.count(F.lit(1)).alias("n_values"),
        F.avg(F.char_length("val")).alias("col_length"),
    )


# --- patterns ----------------------------------------------------------------------------


def detect_patterns(vc: DataFrame, rules: Iterable[PatternRule], ignore_case: bool = False) -> DataFrame:
    """(column_id, semantic_type, weight, share, matched) for all rules in one grouping."""
    rules = list(rules)
    wide = vc.groupBy("column_id").agg(
        total_weight().alias("total"),
        F.avg(F.char_length("val")).alias("average_length"),
        *[weight(F.col("val").rlike(_pattern(r, ignore_case))).alias(f"w{i}") for i, r in enumerate(rules)],
    )
    entries = []
    for i, r in enumerate(rules):
        share = ratio(F.col(f"w{i}"), F.col("total"))
        entries.append(
            {
                "semantic_type": _rule_type(r, F.col("average_length")),
                "weight": F.col(f"w{i}"),
                "share": share,
                "matched": _reached(share, r),
            }
        )
    return _stack(wide, entries)


def weighted_share(vc: DataFrame, rules: Iterable[PatternRule]) -> DataFrame:
    """(column_id, semantic_type, weight, total, share) without a decision."""
    rules = list(rules)
    wide = vc.groupBy("column_id").agg(
        total_weight().alias("total"),
        *[weight(F.col("val").rlike(r.pattern)).alias(f"w{i}") for i, r in enumerate(rules)],
    )
    return _stack(
        wide,
        [
            {
                "semantic_type": F.lit(r.semantic_type),
                "weight": F.col(f"w{i}"),
                "total": F.col("total"),
                "share": ratio(F.col(f"w{i}"), F.col("total")),
            }
            for i, r in enumerate(rules)
        ],
    )


# --- lists and entities --------------------------------------------------------------------


def literal_terms(spark: SparkSession, terms: Mapping[str, Iterable[str]], kind: str = "semantic_type") -> DataFrame:
    """(kind, term) from literals: a local relation, so its exact size is known to the optimiser."""
    rows = ", ".join(f"({sql_text(k)}, {sql_text(t)})" for k, values in terms.items() for t in values)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({kind}, term)")


MASK_BITS = 62


def _bit_masks(value: Column, members: list[str]) -> list[Column]:
    """One bit per member, MASK_BITS to a bigint, set where `value` is that member."""
    masks = []
    for first in range(0, len(members), MASK_BITS):
        mask = F.lit(0).cast("bigint")
        for i, member in enumerate(members[first : first + MASK_BITS]):
            mask = F.when(value == member, F.lit(1 << i).cast("bigint")).otherwise(mask)
        masks.append(mask)
    return masks


def _marks(terms: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """(term, mark0, mark1, ...): one row per term, one bit per kind it belongs to."""
    masks = _bit_masks(F.col(kind), kinds)
    return terms.groupBy("term").agg(*[F.bit_or(m).alias(f"mark{i}") for i, m in enumerate(masks)])


def _marked(vc: DataFrame, terms: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """Value counts with the marks of each value. No hint: the optimiser compares the term
    table's measured size with the broadcast threshold, and splits hot values beyond it."""
    marks = _marks(terms, kind, kinds)
    return vc.join(marks, vc["val"] == marks["term"], "left").drop("term")


def _has(kinds: list[str], kind: str) -> Column:
    word, bit = divmod(kinds.index(kind), MASK_BITS)
    return F.col(f"mark{word}").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0


def detect_keywords(vc: DataFrame, keywords: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """(column_id, semantic_type, weight, share, matched) for `keywords(semantic_type, term)`."""
    kinds = list(thresholds)
    wide = _marked(vc, keywords, "semantic_type", kinds).groupBy("column_id").agg(
        total_weight().alias("total"), *[weight(_has(kinds, k)).alias(f"w{i}") for i, k in enumerate(kinds)]
    )
    return _stack(
        wide,
        [
            {
                "semantic_type": F.lit(k),
                "weight": F.col(f"w{i}"),
                "share": ratio(F.col(f"w{i}"), F.col("total")),
                "matched": ratio(F.col(f"w{i}"), F.col("total")) >= t,
            }
            for i, (k, t) in enumerate(thresholds.items())
        ],
    )


def city_name_gate(column_id: Column) -> Column:
    return F.lower(column_id).contains("city ")


def person_name_gate(column_id: Column) -> Column:
    low = F.lower(column_id)
    named = low.contains("name") & (low.contains("last") | low.contains("first"))
    return named | low.contains(".mi.") | low.contains("initial") | low.contains("candmi")


def _entity_outcome(gated: bool, few: Column) -> dict[str, Column]:
    """city/person shares and weights from w_GPE, w_PERSON, w_ORG; null type if undecided."""
    gpe, person, org = (F.col(f"w_{label}") for label in ENTITY_LABELS)
    both = ~few & (gpe > 0) & (person > 0)
    is_city, is_person = both & (gpe >= person), both & (gpe < person)
    if gated:
        is_city = is_city & city_name_gate(F.col("column_id"))
        is_person = is_person & person_name_gate(F.col("column_id"))
    return {
        "type": F.when(is_city, "city").when(is_person, "person_name"),
        "city_share": F.when(is_city, gpe / (gpe + person)).otherwise(F.lit(0.0)),
        "city_weight": F.when(is_city, gpe + org).otherwise(F.lit(0)).cast("bigint"),
        "person_share": F.when(is_person, person / (gpe + person)).otherwise(F.lit(0.0)),
        "person_weight": F.when(is_person, person + org).otherwise(F.lit(0)).cast("bigint"),
    }


def entity_share(vc: DataFrame, entities: DataFrame, gated: bool = False) -> DataFrame:
    """City or person by the weight of known names, `entities(label, term)`.

    (column_id, semantic_type, weight, share): one row per column, type null if undecided.
    """
    kinds = list(ENTITY_LABELS)
    wide = _marked(vc, entities, "label", kinds).groupBy("column_id").agg(
        F.count(F.lit(1)).alias("n_values"), *[weight(_has(kinds, k)).alias(f"w_{k}") for k in kinds]
    )
    return entity_decision(wide, gated, R.FEW_VALUES)


def entity_decision(wide: DataFrame, gated: bool, few_values: int) -> DataFrame:
    """(column_id, semantic_type, weight, share) from n_values and a weight for each entity label."""
    out = _entity_outcome(gated, F.col("n_values") <= few_values)
    return wide.select(
        "column_id",
        out["type"].alias("semantic_type"),
        (out["city_weight"] + out["person_weight"]).alias("weight"),
        (out["city_share"] + out["person_share"]).alias("share"),
    )


# --- codes and shapes ----------------------------------------------------------------------


def weight_by_code(vc: DataFrame, code: Column | None = None) -> DataFrame:
    """(column_id, code, weight): weights added up by phonetic code."""
    code = soundex_code(F.col("val")) if code is None else code
    return vc.groupBy("column_id", code.alias("code")).agg(total_weight().alias("weight"))


def make_code(c: Column) -> Column:
    return soundex_code(first_word(c, R.MAKE_WORD_LENGTH))


def code_weights(vc: DataFrame, codes: Mapping[str, str], code: Column | None = None) -> DataFrame:
    """(column_id, rank, name, weight) per known name by weight (ties by name), then an OTHERS row
    with what is left.

    Only columns in which at least one code occurs; one grouping, one sum per name, and the
    order of a column's names is sorted within its row.
    """
    code = soundex_code(F.col("val")) if code is None else code
    names = sorted(set(codes.values()))
    wide = vc.withColumn("code", code).groupBy("column_id").agg(
        total_weight().alias("total"),
        *[weight(F.col("code").isin([c for c, v in codes.items() if v == n])).alias(f"w{i}") for i, n in enumerate(names)],
    )
    known = reduce(lambda a, b: a + b, [F.col(f"w{i}") for i in range(len(names))])
    entries = F.array(*[F.struct((-F.col(f"w{i}")).alias("order"), F.lit(n).alias("name")) for i, n in enumerate(names)])
    ranked = F.array_sort(F.filter(entries, lambda e: e["order"] < 0))
    others = F.struct((known - F.col("total")).alias("order"), F.lit("OTHERS").alias("name"))
    return wide.where(known > 0).select("column_id", F.posexplode(F.concat(ranked, F.array(others))).alias("rank", "entry")).select(
        "column_id", (F.col("rank") + 1).alias("rank"), "entry.name", (-F.col("entry.order")).alias("weight")
    )


def _codes_present(code: Column, codes: Iterable[str]) -> Column:
    """How many of the codes a column has: the bits of the or of its values' masks."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.bit_or(m)) for m in _bit_masks(code, list(codes))])


def _shape_measures() -> dict[str, Column]:
    color, make = F.col("color_code"), F.col("make_code")
    starts_with_letter = "^[A-Za-z]"
    return {
        "total": total_weight(),
        "n_values": F.count(F.lit(1)),
        "average_length": F.avg(F.char_length("val")),
        "colors": _codes_present(color, R.COLOR_CODES),
        "w_color": weight(color.isin(list({**R.COLOR_CODES, **R.COLOR_SHORT_CODES}))),
        "w_color_letters": weight(color.rlike(starts_with_letter)),
        "makes": _codes_present(make, R.MAKE_CODES),
        "w_make_letters": weight(make.rlike(starts_with_letter)),
        "boroughs": F.count_if(F.col("val").isin(list(R.BOROUGHS))),
        "w_borough": weight(F.col("val").isin(list(R.BOROUGHS))),
    }


def with_codes(vc: DataFrame) -> DataFrame:
    return vc.withColumns({"color_code": soundex_code(F.col("val")), "make_code": make_code(F.col("val"))})


def _shape_outcomes() -> dict[str, dict[str, Column]]:
    """Initials, colour, make or model, borough: type (null if not found), share, weight."""
    total, zero, none = F.col("total"), F.lit(0).cast("bigint"), F.lit(0.0)
    initials = (F.col("average_length") <= R.INITIALS_LENGTH) & (F.col("n_values") > R.INITIALS_VALUES)
    color_share = ratio(F.col("w_color"), total)
    color = (F.col("colors") / len(R.COLOR_CODES) >= R.CODE_SHARE) & (color_share >= R.CODE_SHARE)
    make_share = F.col("makes") / len(R.MAKE_CODES)
    make = (make_share >= R.CODE_SHARE) & F.lower("column_id").contains("vehicle")
    make_type = F.when(F.col("average_length") > R.MODEL_MEAN_LENGTH, "car_model").otherwise("car_make")
    borough = (F.col("n_values") <= R.FEW_VALUES) & (F.col("boroughs") >= R.BOROUGH_VALUES)

    def outcome(found: Column, kind: Column, share: Column, weight_: Column) -> dict[str, Column]:
        return {
            "semantic_type": F.when(found, kind),
            "weight": F.when(found, weight_).otherwise(zero),
            "share": F.when(found, share).otherwise(none),
        }

    return {
        "initials": outcome(initials, F.lit("person_name_initials"), F.lit(R.INITIALS_SHARE), total),
        "color": outcome(color, F.lit("color"), color_share, F.col("w_color_letters")),
        "car_make": outcome(make, make_type, make_share, F.col("w_make_letters")),
        "borough": outcome(borough, F.lit("borough"), ratio(F.col("w_borough"), total), F.col("w_borough")),
    }


def detect_shape(vc: DataFrame, detectors: Iterable[str] = ("initials", "color", "car_make", "borough")) -> DataFrame:
    """(column_id, detector, semantic_type, weight, share); type null where not found."""
    wide = with_codes(vc).groupBy("column_id").agg(*[c.alias(n) for n, c in _shape_measures().items()])
    outcomes = _shape_outcomes()
    return _stack(wide, [{"detector": F.lit(d), **outcomes[d]} for d in detectors])


# --- min-max scaling of counts ----------------------------------------------------------------


def scaled_thousandths(x: Column, low: Column, high: Column) -> Column:
    """1000 * (x - low) / (high - low), rounded half up in whole numbers; 500 for a constant column."""
    span = high - low
    part, whole = F.lit(2000) * (x - low) + span, F.nullif(F.lit(2) * span, F.lit(0))
    # part - part % whole is a multiple of whole, so the quotient is a whole number again
    exact = F.round((part - part % whole) / whole)
    return F.when(span == 0, F.lit(500)).otherwise(exact).cast("bigint")


def _count_range(vc: DataFrame) -> DataFrame:
    return vc.groupBy("column_id").agg(F.min("count").alias("low"), F.max("count").alias("high"))


def minmax_scale(vc: DataFrame) -> DataFrame:
    """(column_id, val, count, scaled): counts scaled to 0..1 per column, three digits.

    The range is one row per column and is joined without a hint: it is broadcast if it
    measures small, and a column too large for one task is split by the skew join if not.
    """
    scaled = scaled_thousandths(F.col("count"), F.col("low"), F.col("high")) / 1000
    return vc.join(_count_range(vc), "column_id").select("column_id", "val", "count", scaled.alias("scaled"))


def scaled_count_stats(vc: DataFrame) -> DataFrame:
    """(column_id, mean, stdv) of the scaled counts.

    Works on how often each count occurs: counts that differ add up to the column's rows,
    so a column of n rows has at most sqrt(2n) of them. Sums are whole numbers, so the
    spread loses nothing to cancellation.
    """
    sizes = vc.groupBy("column_id", "count").agg(F.count(F.lit(1)).alias("n"))
    joined = sizes.join(_count_range(sizes), "column_id").withColumn(
        "x", scaled_thousandths(F.col("count"), F.col("low"), F.col("high"))
    )
    sums = joined.groupBy("column_id").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("x")).alias("s1"),
        F.sum(F.col("n") * F.col("x") * F.col("x")).alias("s2"),
    )
    n, s1, s2 = (F.col(c).cast("decimal(38,0)") for c in ("n", "s1", "s2"))
    spread = (n * s2 - s1 * s1).cast("double") / (F.col("n").cast("double") * (F.col("n") - 1))
    return sums.select(
        "column_id",
        (F.col("s1") / F.col("n") / 1000).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(spread) / 1000).alias("stdv"),
    )


def scaled_sorted(vc: DataFrame) -> DataFrame:
    """Scaled counts, largest first; a range-partitioned sort, not one task."""
    return minmax_scale(vc).orderBy(F.desc("count"), "column_id", "val")
