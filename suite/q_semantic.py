"""Column typing queries: patterns, lists, codes, entities, cascade, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsight import rules as R
from colsight.functions import text as T
from colsight.operators import evaluate, semantic as S
from colsight.plans import classify as C, profile as P
from suite import expected as E
from suite.corpus import SEMANTIC, load, register, semantic_values, tables, values_sql

VC = f"vc AS MATERIALIZED ({values_sql()})"

# --- patterns ---------------------------------------------------------------------------------


def _sized(kind: str, short: str | None) -> str:
    return f"CASE WHEN avg_len >= {E.SHORT} THEN '{kind}' ELSE '{short}' END" if short else f"'{kind}'"


def _pattern_sql(patterns, ignore_case=False) -> str:
    parts = []
    for kind, (condition, reached, short) in patterns.items():
        if ignore_case:
            condition = condition.replace("val,", "upper(val),").replace("val IN", "upper(val) IN")
        parts.append(
            f"""SELECT column_id, {_sized(kind, short)} AS semantic_type, w AS weight, round(w / total, 6) AS share, w / total {reached} AS matched FROM (
            SELECT column_id, CAST(coalesce(sum(n) FILTER (WHERE {condition}), 0) AS BIGINT) AS w,
            CAST(sum(n) AS BIGINT) AS total, avg(length(val)) AS avg_len FROM vc GROUP BY 1)"""
        )
    return f"WITH {VC} " + " UNION ALL ".join(parts)


def _share6(df):
    return df.withColumn("share", F.round("share", 6))


_BY_TYPE = {r.semantic_type: r for r in R.PATTERN_RULES}
for _name, _type in {
    "sem_website": "website", "sem_zip_code": "zip_code", "sem_building_class": "building_classification",
    "sem_phone": "phone_number", "sem_lat_lon": "lat_lon_cord", "sem_address": "address",
    "sem_school_name": "school_name", "sem_house_number": "house_number", "sem_school_subject": "subject_in_school",
    "sem_school_level": "school_level",
}.items():
    register(
        _name,
        lambda s, d, rule=_BY_TYPE[_type]: _share6(S.detect_patterns(semantic_values(s, d), [rule])),
        _pattern_sql({_type: E.PATTERNS[_type]}),
    )
register("sem_regex", lambda s, d: _share6(S.detect_patterns(semantic_values(s, d), R.PATTERN_RULES)), _pattern_sql(E.PATTERNS))
register(
    "sem_regex_ignore_case",
    lambda s, d: _share6(S.detect_patterns(semantic_values(s, d), R.PATTERN_RULES, ignore_case=True)),
    _pattern_sql(E.PATTERNS, ignore_case=True),
)
register("sem_regex_table", lambda s, d: _share6(S.detect_patterns(semantic_values(s, d), R.PATTERN_TABLE)), _pattern_sql(E.PATTERN_TABLE))
register("sem_ruleset_v0", lambda s, d: _share6(S.detect_patterns(semantic_values(s, d), R.PATTERN_RULES_V0)), _pattern_sql(E.PATTERNS_V0))
register("sem_ruleset_v1", lambda s, d: _share6(S.detect_patterns(semantic_values(s, d), R.PATTERN_RULES_V1)), _pattern_sql(E.PATTERNS_V1))
register(
    "weighted_share",
    lambda s, d: _share6(S.weighted_share(semantic_values(s, d), R.PATTERN_RULES)),
    f"WITH {VC} "
    + " UNION ALL ".join(
        f"""SELECT column_id, '{kind}' AS semantic_type, CAST(coalesce(sum(n) FILTER (WHERE {condition}), 0) AS BIGINT) AS weight,
        CAST(sum(n) AS BIGINT) AS total, round(coalesce(sum(n) FILTER (WHERE {condition}), 0) / sum(n), 6) AS share FROM vc GROUP BY 1"""
        for kind, (condition, _, _) in E.PATTERNS.items()
    ),
)

# --- columns as a whole -------------------------------------------------------------------------

register(
    "total_weight",
    lambda s, d: S.column_weights(semantic_values(s, d)).select("column_id", "count_all", "n_values"),
    f"WITH {VC} SELECT column_id, CAST(sum(n) AS BIGINT) AS count_all, count(*) AS n_values FROM vc GROUP BY 1",
)
register(
    "avg_value_length",
    lambda s, d: S.column_weights(semantic_values(s, d)).select("column_id", F.round("col_length", 6).alias("col_length")),
    f"WITH {VC} SELECT column_id, round(avg(length(val)), 6) AS col_length FROM vc GROUP BY 1",
)
_SCALED = """CASE WHEN high = low THEN 500 ELSE (2000 * (n - low) + (high - low)) // (2 * (high - low)) END"""
_RANGED = "SELECT *, min(n) OVER (PARTITION BY column_id) AS low, max(n) OVER (PARTITION BY column_id) AS high FROM vc"
register(
    "minmax_scale",
    lambda s, d: S.minmax_scale(semantic_values(s, d)),
    f"WITH {VC} SELECT column_id, val, n AS count, {_SCALED} / 1000 AS scaled FROM ({_RANGED})",
)
register(
    "scaled_sorted",
    lambda s, d: S.scaled_sorted(semantic_values(s, d)),
    f"WITH {VC} SELECT column_id, val, n AS count, {_SCALED} / 1000 AS scaled FROM ({_RANGED}) ORDER BY n DESC, column_id, val",
)
register(
    "scaled_count_stats",
    lambda s, d: S.scaled_count_stats(semantic_values(s, d)).withColumns({c: F.round(c, 6) for c in ("mean", "stdv")}),
    f"WITH {VC} SELECT column_id, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS stdv FROM (SELECT column_id, {_SCALED} / 1000 AS x FROM ({_RANGED})) GROUP BY 1",
)

# --- phonetic codes ---------------------------------------------------------------------------------


def soundex_sql(c: str) -> str:
    """First letter, then runs of the digits 1 to 6 that stand for letters; 0 marks every other letter."""
    word = f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]', '', 'g')"
    out = f"translate(regexp_replace(lower({word}), '[0-9]', '_', 'g'), 'bfpvcgjkqsxzdtlmnr', '111122222222334556')"
    out = f"regexp_replace({out}, '[^1-6]', '0', 'g')"
    for digit in range(7):
        out = f"regexp_replace({out}, '{digit}{{2,}}', '{digit}', 'g')"
    return f"CASE WHEN {word} = '' THEN '' ELSE rpad(replace(upper(left({word}, 1)), 'ẞ', 'SS') || replace(substr({out}, 2), '0', ''), 4, '0') END"


def first_word_sql(c: str, n: int) -> str:
    return f"substr(regexp_extract({c}, '(\\S+)', 1), 1, {n})"


_WORDS = "SELECT DISTINCT val FROM (SELECT unnest(string_split(text, ' ')) AS val FROM documents UNION ALL SELECT c_name FROM customer UNION ALL SELECT p_name FROM part)"


def _word_values(s, d):
    words = load(s, d, "documents").select(F.explode(F.split("text", " ")).alias("val"))
    names = load(s, d, "customer").select(F.col("c_name").alias("val")).unionByName(load(s, d, "part").select(F.col("p_name").alias("val")))
    return words.unionByName(names).distinct()


register(
    "soundex_codes",
    lambda s, d: _word_values(s, d).select("val", T.soundex_code(F.col("val")).alias("code")),
    f"SELECT val, {soundex_sql('val')} AS code FROM ({_WORDS})",
)
register(
    "first_word",
    lambda s, d: _word_values(s, d).select("val", T.first_word(F.col("val"), 5).alias("word")),
    f"SELECT val, {first_word_sql('val', 5)} AS word FROM ({_WORDS})",
)
register(
    "weight_by_soundex",
    lambda s, d: S.weight_by_code(semantic_values(s, d).where(F.col("val").isNotNull())),
    f"WITH {VC} SELECT column_id, {soundex_sql('val')} AS code, CAST(sum(n) AS BIGINT) AS weight FROM vc WHERE val IS NOT NULL GROUP BY 1, 2",
)
MAKE_SQL = soundex_sql(first_word_sql("val", E.MAKE_LETTERS))


def _breakdown_sql(codes, code: str) -> str:
    name = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    return f"""WITH {VC}, named AS (SELECT column_id, n, CASE {code} {name} END AS name FROM vc),
    hit AS (SELECT column_id FROM named GROUP BY 1 HAVING count(name) > 0),
    known AS (SELECT column_id, name, CAST(sum(n) AS BIGINT) AS weight FROM named WHERE name IS NOT NULL GROUP BY 1, 2)
    SELECT column_id, CAST(row_number() OVER (PARTITION BY column_id ORDER BY weight DESC, name) AS INTEGER) AS rank, name, weight FROM known
    UNION ALL SELECT column_id, CAST(count(DISTINCT name) + 1 AS INTEGER), 'OTHERS', CAST(coalesce(sum(n) FILTER (WHERE name IS NULL), 0) AS BIGINT) FROM named
    WHERE column_id IN (SELECT column_id FROM hit) GROUP BY 1"""


ALL_COLORS = {**E.COLOR_CODES, **E.SHORT_COLORS}
register(
    "color_breakdown",
    lambda s, d: S.code_weights(semantic_values(s, d), {**R.COLOR_CODES, **R.COLOR_SHORT_CODES}),
    _breakdown_sql(ALL_COLORS, soundex_sql("val")),
)
register(
    "make_breakdown",
    lambda s, d: S.code_weights(semantic_values(s, d), R.MAKE_CODES, S.make_code(F.col("val"))),
    _breakdown_sql(E.MAKES, MAKE_SQL),
)

# --- shapes -------------------------------------------------------------------------------------------


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _weight(cond: str) -> str:
    return f"CAST(coalesce(sum(n) FILTER (WHERE {cond}), 0) AS BIGINT)"


SHAPES = f"""shapes AS (SELECT column_id, CAST(sum(n) AS BIGINT) AS total, count(*) AS n_values, avg(length(val)) AS avg_len,
    count(DISTINCT code) FILTER (WHERE code IN {_in(E.COLOR_CODES)}) AS colors, {_weight(f'code IN {_in(ALL_COLORS)}')} AS w_color,
    {_weight("regexp_matches(code, '^[A-Za-z]')")} AS w_color_letters,
    count(DISTINCT make) FILTER (WHERE make IN {_in(E.MAKES)}) AS makes, {_weight("regexp_matches(make, '^[A-Za-z]')")} AS w_make_letters,
    count(*) FILTER (WHERE val IN {_in(E.BOROUGHS)}) AS boroughs, {_weight(f'val IN {_in(E.BOROUGHS)}')} AS w_borough
    FROM (SELECT *, {soundex_sql('val')} AS code, {MAKE_SQL} AS make FROM vc) GROUP BY 1)"""
OUTCOMES = {
    "initials": ("avg_len <= 2 AND n_values > 20", "'person_name_initials'", "100.0", "total"),
    "color": ("colors / 10 >= 0.5 AND w_color / total >= 0.5", "'color'", "w_color / total", "w_color_letters"),
    "car_make": ("makes / 10 >= 0.5 AND lower(column_id) LIKE '%vehicle%'", "CASE WHEN avg_len > 7 THEN 'car_model' ELSE 'car_make' END", "makes / 10", "w_make_letters"),
    "borough": ("n_values <= 10 AND boroughs >= 5", "'borough'", "w_borough / total", "w_borough"),
}
for _name, (_cond, _kind, _s, _w) in OUTCOMES.items():
    register(
        f"sem_{_name}",
        lambda s, d, name=_name: _share6(S.detect_shape(semantic_values(s, d), [name])),
        f"""WITH {VC}, {SHAPES} SELECT column_id, '{_name}' AS detector, CASE WHEN {_cond} THEN {_kind} END AS semantic_type,
        CASE WHEN {_cond} THEN {_w} ELSE 0 END AS weight, CAST(CASE WHEN {_cond} THEN round({_s}, 6) ELSE 0 END AS DOUBLE) AS share FROM shapes""",
    )

# --- lists and entities ------------------------------------------------------------------------------


def entities(s, d):
    """Known names from the tables: nations are places, customers people, suppliers firms."""
    def side(table, column, label):
        return load(s, d, table).select(F.lit(label).alias("label"), F.col(column).alias("term"))

    return side("nation", "n_name", "GPE").unionByName(side("customer", "c_name", "PERSON")).unionByName(side("supplier", "s_name", "ORG"))


ENTITIES = """entities AS (SELECT 'GPE' AS label, n_name AS term FROM nation UNION SELECT 'PERSON', c_name FROM customer UNION SELECT 'ORG', s_name FROM supplier)"""
ENTITY_SUMS = """esums AS (SELECT vc.column_id, count(DISTINCT coalesce(val, chr(1))) AS n_values,
    """ + ", ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE val IN (SELECT term FROM entities WHERE label = '{k}')), 0) AS BIGINT) AS {k.lower()}"
    for k in E.ENTITIES
) + " FROM vc GROUP BY 1)"


def _entity_sql(gated: bool) -> str:
    low = "lower(column_id)"
    city = f"{low} LIKE '%city %'" if gated else "true"
    person = (
        f"(({low} LIKE '%name%' AND ({low} LIKE '%last%' OR {low} LIKE '%first%')) OR {low} LIKE '%.mi.%' OR {low} LIKE '%initial%' OR {low} LIKE '%candmi%')"
        if gated
        else "true"
    )
    return f"""SELECT column_id, CASE WHEN is_city THEN 'city' WHEN is_person THEN 'person_name' END AS semantic_type,
        CASE WHEN is_city THEN gpe + org WHEN is_person THEN person + org ELSE 0 END AS weight,
        CAST(CASE WHEN is_city THEN gpe / (gpe + person) WHEN is_person THEN person / (gpe + person) ELSE 0 END AS DOUBLE) AS share
        FROM (SELECT *, n_values > 10 AND gpe > 0 AND person > 0 AND gpe >= person AND {city} AS is_city,
            n_values > 10 AND gpe > 0 AND person > 0 AND gpe < person AND {person} AS is_person FROM esums)"""


for _name, _gated in (("sem_city_person", False), ("sem_city_person_gated", True)):
    register(
        _name,
        lambda s, d, gated=_gated: _share6(S.entity_share(semantic_values(s, d), entities(s, d), gated)),
        f"WITH {VC}, {ENTITIES}, {ENTITY_SUMS} SELECT * REPLACE (round(share, 6) AS share) FROM ({_entity_sql(_gated)})",
    )


def _keyword_sql(kind: str, threshold: float | None = None) -> str:
    members, reached = E.LISTS[kind]
    w = _weight(f"val IN {_in(members)}")
    return f"""SELECT column_id, '{kind}' AS semantic_type, w AS weight, round(w / total, 6) AS share, w / total >= {threshold or reached} AS matched
    FROM (SELECT column_id, {w} AS w, CAST(sum(n) AS BIGINT) AS total FROM vc GROUP BY 1)"""


THRESHOLDS = {**R.KEYWORD_THRESHOLDS, **R.EXTRA_KEYWORD_THRESHOLDS}
for _name, _list in {
    "subject": "subject_in_school", "business": "business_name", "neighborhood": "neighborhood", "area": "area_of_study",
    "agency": "city_agency", "location": "location_type", "park": "park_playground",
}.items():
    register(
        f"sem_list_{_name}",
        lambda s, d, kind=_list: _share6(
            S.detect_keywords(semantic_values(s, d), S.literal_terms(s, {kind: R.KEYWORDS[kind]}), {kind: THRESHOLDS[kind]})
        ),
        f"WITH {VC} {_keyword_sql(_list)}",
    )
register(
    "sem_list",
    lambda s, d: _share6(S.detect_keywords(semantic_values(s, d), S.literal_terms(s, R.KEYWORDS), THRESHOLDS)),
    f"WITH {VC} " + " UNION ALL ".join(map(_keyword_sql, E.LISTS)),
)

register(
    "sem_list_v1",
    lambda s, d: _share6(S.detect_keywords(semantic_values(s, d), S.literal_terms(s, R.KEYWORDS), R.KEYWORD_THRESHOLDS_V1)),
    f"WITH {VC} " + " UNION ALL ".join(_keyword_sql(k, 0.3 if k == "area_of_study" else None) for k in E.CASCADE_LISTS),
)

# --- cascade -------------------------------------------------------------------------------------------


def report(s, d, gated=False):
    cascade = {k: R.KEYWORDS[k] for k in R.KEYWORD_THRESHOLDS}
    return C.classify(semantic_values(s, d), S.literal_terms(s, cascade), entities(s, d), gated=gated)


def _cascade_ctes(gated=False) -> str:
    """rep: column_id, count_all, col_length, <detector>_share / _weight, hits [(type, count)], types_count."""
    pat = [f"{_weight(condition)} AS p{i}" for i, (condition, _, _) in enumerate(E.PATTERNS.values())]
    kw = [f"{_weight(f'val IN {_in(E.LISTS[k][0])}')} AS k{i}" for i, k in enumerate(E.CASCADE_LISTS)]
    sums = f"sums AS (SELECT column_id, {', '.join(pat + kw)} FROM vc GROUP BY 1)"
    base = f"""base AS (SELECT * FROM shapes JOIN sums USING (column_id) JOIN (SELECT column_id, semantic_type AS e_type, weight AS e_weight, share AS e_share FROM ({_entity_sql(gated)})) USING (column_id))"""
    kinds, shares, weights, order = [], [], [], []
    for i, (name, (_, reached, short)) in enumerate(E.PATTERNS.items()):
        kinds.append((f"CASE WHEN p{i} / total {reached} THEN {_sized(name, short)} END", f"p{i}"))
        shares.append((name, f"CAST(p{i} / total AS DOUBLE)", f"p{i}"))
    n_first = " AND ".join(f"({k}) IS NULL" for k, _ in kinds)
    first = ", ".join(f"{{'type': {k}, 'count': {w}}}" for k, w in kinds)
    later = []
    cleared = "e_type IS NOT NULL"
    for name, (cond, kind, share, w) in OUTCOMES.items():
        shares.append((name, f"CAST(CASE WHEN is_open AND {cond} THEN {share} ELSE 0 END AS DOUBLE)", f"CASE WHEN is_open AND {cond} THEN {w} ELSE 0 END"))
        keep = "" if name == "borough" else f" AND NOT ({cleared})"
        later.append((f"CASE WHEN is_open AND {cond}{keep} THEN {kind} END", f"CASE WHEN {cond} THEN {w} ELSE 0 END"))
    for name, kind in (("city", "city"), ("person", "person_name")):
        shares.append((name, f"CAST(CASE WHEN is_open AND e_type = '{kind}' THEN e_share ELSE 0 END AS DOUBLE)", f"CASE WHEN is_open AND e_type = '{kind}' THEN e_weight ELSE 0 END"))
    later.append(("CASE WHEN is_open THEN e_type END", "e_weight"))
    for i, k in enumerate(E.CASCADE_LISTS):
        shares.append((k, f"CAST(CASE WHEN is_open THEN k{i} / total ELSE 0 END AS DOUBLE)", f"CASE WHEN is_open THEN k{i} ELSE 0 END"))
        later.append((f"CASE WHEN is_open AND k{i} / total >= {E.LISTS[k][1]} THEN '{k}' END", f"k{i}"))
    second = ", ".join(f"{{'type': {k}, 'count': {w}}}" for k, w in later)
    cols = ", ".join(f"{s} AS {n}_share, {w} AS {n}_weight" for n, s, w in shares)
    total = " + ".join(f"({w})" for _, _, w in shares)
    return f"""{VC}, {SHAPES}, {ENTITIES}, {ENTITY_SUMS}, {sums}, {base},
    opened AS (SELECT *, {n_first} AS is_open FROM base),
    rep AS (SELECT column_id, total AS count_all, avg_len AS col_length, {cols}, CAST({total} AS BIGINT) AS types_count,
        list_filter([{first}] || [{second}], lambda h: h.type IS NOT NULL) AS hits FROM opened)"""


CASCADE = _cascade_ctes()
SHARE_NAMES = [*E.PATTERNS, *OUTCOMES, "city", "person", *E.CASCADE_LISTS]
_TYPES = "array_to_string(list_transform(hits, lambda h: h.type), '|')"
_HIT_ROWS = f"""SELECT column_id, CASE WHEN type IN {_in(E.LABELS)} THEN '' ELSE type END AS semantic_type,
    CASE WHEN type IN {_in(E.LABELS)} THEN type ELSE '' END AS label, CAST(count AS BIGINT) AS count
    FROM (SELECT column_id, unnest(hits, recursive := true) FROM rep)"""
register("sem_cascade", lambda s, d: C.predicted_rows(report(s, d)), f"WITH {CASCADE} {_HIT_ROWS}")
register("sem_cascade_gated", lambda s, d: C.predicted_rows(report(s, d, gated=True)), f"WITH {_cascade_ctes(True)} {_HIT_ROWS}")
register(
    "sem_type_count",
    lambda s, d: report(s, d).select("column_id", "types_count"),
    f"WITH {CASCADE} SELECT column_id, types_count FROM rep",
)
register(
    "sem_report",
    lambda s, d: _round_doubles(C.share_report(report(s, d), semantic_values(s, d))),
    f"""WITH {CASCADE}, stats AS (SELECT column_id, avg(x) AS mean, stddev_samp(x) AS stdv FROM (SELECT column_id, {_SCALED} / 1000 AS x FROM ({_RANGED})) GROUP BY 1)
    SELECT column_id, round(mean, 6) AS mean, round(stdv, 6) AS stdv, count_all, round(col_length, 6) AS col_length,
    {', '.join(f'round({n}_share, 6) AS {n}_share' for n in SHARE_NAMES)}, {_TYPES} AS types, types_count FROM rep JOIN stats USING (column_id)""",
)


def _round_doubles(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


register(
    "predictions",
    lambda s, d: C.predictions(report(s, d)).withColumn("types", F.array_join("types", "|")),
    f"WITH {CASCADE} SELECT column_id, {_TYPES} AS types FROM rep",
)
register("types_found", lambda s, d: C.types_found(report(s, d)), f"WITH {CASCADE} SELECT count(*) AS n FROM rep WHERE len(hits) > 0")

# --- profile with types ------------------------------------------------------------------------------------


def _enriched(s, d):
    found = C.predicted_rows(report(s, d)).withColumns(
        {"dataset": F.substring_index("column_id", ".", 1), "column_name": F.expr("substr(column_id, instr(column_id, '.') + 1)")}
    )
    columns = P.enrich_profile(P.profile_columns(tables(s, d, SEMANTIC)), found)
    return columns.select(
        "dataset", "column_name", "number_distinct_values", F.inline_outer("semantic_types")
    ).select("dataset", "column_name", "number_distinct_values", "semantic_type", "label", "count")


register(
    "profile_enrich",
    _enriched,
    f"""WITH {CASCADE}, hitrows AS ({_HIT_ROWS}), counts AS (SELECT column_id, count(val) AS number_distinct_values FROM vc GROUP BY 1)
    SELECT split_part(column_id, '.', 1) AS dataset, substr(column_id, instr(column_id, '.') + 1) AS column_name, number_distinct_values, semantic_type, label, count
    FROM counts LEFT JOIN hitrows USING (column_id)""",
)

# --- evaluation ----------------------------------------------------------------------------------------------

# --- fixed values: what the derived columns hold; two are deliberately named otherwise or wrong ---
TRUTH = {
    "people.zip": "zip", "people.zip_half": "zip_code", "people.phone": "phone", "people.phone_spaced": "phone_number",
    "people.location": "lat_lon_cord", "people.address": "address", "people.street": "street",
    "people.borough": "borough,neighborhood", "people.borough_code": "borough", "people.boroughs_four": "borough",
    "vehicles.Vehicle_Color": "color", "vehicles.Vehicle_Make": "car_make", "vehicles.maker": "car_make",
    "vehicles.Vehicle_Model": "car_model", "schools.building_class": "building_classification",
    "schools.school": "school_name", "schools.academy": "school_name", "schools.subject": "school_subject",
    "schools.level": "school_level", "schools.interest3": "area_of_study", "places.agency": "agency",
    "places.neighborhood": "neighborhood", "places.premise": "location_type", "places.park": "parks_playgrounds",
    "places.business": "business", "places.priority": "vehicle_type", "names.town": "city", "names.last_name": "person",
    "web.URL_UPPER": "website", "web.url": "website",
}


def labels(s):
    """Hand labels in the layout of the label file, read by the label parser."""
    from colsight.sources.readers import parse_labels

    lines = [f"{k}\t[" + ", ".join(f"'{x}'" for x in v.split(",")) + "]" for k, v in TRUTH.items()]
    return parse_labels(s.range(1).select(F.explode(F.array(*[F.lit(x) for x in lines])).alias("value")))


_TRUTH_SQL = "truth AS (SELECT DISTINCT column_id, label FROM (VALUES " + ", ".join(
    f"('{k}', '{E.OTHER_NAMES.get(x, x)}')" for k, v in TRUTH.items() for x in v.split(",")
) + ") t(column_id, label))"
_SCORE = f"""WITH {CASCADE}, {_TRUTH_SQL},
    guess AS (SELECT column_id, type AS label FROM (SELECT column_id, unnest(hits, recursive := true) FROM rep) WHERE column_id IN (SELECT column_id FROM truth)),
    cell AS (SELECT coalesce(t.label, g.label) AS label, t.label IS NOT NULL AS t, g.label IS NOT NULL AS g
        FROM truth t FULL JOIN guess g ON t.column_id = g.column_id AND t.label = g.label),
    scores AS (SELECT label, count(*) FILTER (WHERE t AND g) AS tp, count(*) FILTER (WHERE g AND NOT t) AS fp, count(*) FILTER (WHERE t AND NOT g) AS fn FROM cell GROUP BY 1)"""
register(
    "precision_recall",
    lambda s, d: evaluate.precision_recall(C.predictions(report(s, d)), labels(s), R.LABEL_ALIASES),
    f"{_SCORE} SELECT label, tp, fp, fn, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 4) END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 4) END AS recall FROM scores",
)


def _summary(s, d):
    found = C.predictions(report(s, d))
    return evaluate.eval_summary(found, evaluate.precision_recall(found, labels(s), R.LABEL_ALIASES))


register(
    "eval_summary",
    _summary,
    f"{_SCORE} SELECT (SELECT count(*) FROM rep) AS columns, (SELECT count(*) FROM rep WHERE len(hits) > 0) AS typed, round(sum(tp) / (sum(tp) + sum(fp)), 4) AS precision FROM scores",
)
