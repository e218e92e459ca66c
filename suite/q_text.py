"""Sources, keyword mining, n-grams, similarity, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsight import rules as R
from colsight.functions import text as T
from colsight.operators import components as K, forest as H, minindex as X, mining as M, similarity as Z
from colsight.plans import profile as P
from colsight.sources import readers
from suite import expected as E
from suite.corpus import load, raw, register, semantic_values
from suite.q_generic import _profile_sql
from suite.q_semantic import VC

# --- catalogs and files ---------------------------------------------------------------------------

_CATALOG = "concat('ds-', lpad(CAST(page_id AS STRING), 5, '0')) || chr(9) || url"


def _catalog(s, d):
    return readers.parse_catalog(load(s, d, "pages").selectExpr(f"{_CATALOG} AS value"))


_CATALOG_SQL = "SELECT 'ds-' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS dataset FROM pages"
register("catalog_columns", _catalog, _CATALOG_SQL)


def _skip(s, d):
    return _catalog(s, d).where(F.col("dataset").endswith("7"))


register(
    "catalog_skip",
    lambda s, d: readers.select_datasets(_catalog(s, d), skip=_skip(s, d)),
    f"SELECT dataset FROM ({_CATALOG_SQL}) WHERE dataset NOT LIKE '%7'",
)
register(
    "catalog_slice",
    lambda s, d: readers.select_datasets(_catalog(s, d), skip=_skip(s, d), offset=10, limit=154),
    f"SELECT dataset FROM ({_CATALOG_SQL}) WHERE dataset NOT LIKE '%7' ORDER BY dataset OFFSET 10 LIMIT 154",
)

_RAW_COUNT = "CASE o_orderkey % 6 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN CAST(o_custkey AS STRING) || '.5' WHEN 3 THEN ' ' || CAST(o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END"
register(
    "repair_counts",
    lambda s, d: readers.repair_value_counts(
        load(s, d, "orders").selectExpr("concat_ws('.', 'orders', o_orderpriority) AS column_id", "CAST(o_orderkey AS STRING) AS val", f"{_RAW_COUNT} AS count")
    ),
    f"""SELECT 'orders.' || o_orderpriority AS column_id, CAST(o_orderkey AS VARCHAR) AS val,
        CASE WHEN regexp_matches(c, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(c) AS BIGINT) ELSE 0 END AS count
    FROM (SELECT *, {_RAW_COUNT} AS c FROM orders)""",
)
_LINE = """'["' || p_name || '", "' || upper(p_type) || '",''' || p_brand || ''']'"""


def _term_lines(s, d):
    line = F.concat(F.lit('["'), "p_name", F.lit('", "'), F.upper("p_type"), F.lit("\",'"), "p_brand", F.lit("']"))
    return load(s, d, "part").select(line.alias("value"))


_PART_TERMS = "SELECT unnest([p_name, upper(p_type), p_brand]) AS t FROM part"
_QUOTED = """concat('"', p_name, '", "', replace(upper(p_type), ' ', '""'), '",', p_brand)"""
register(
    "keyword_load",
    lambda s, d: readers.parse_terms(load(s, d, "part").selectExpr(f"{_QUOTED} AS value")),
    """SELECT unnest([p_name, replace(upper(p_type), ' ', '"'), p_brand]) AS term FROM part""",
)
register(
    "name_list",
    lambda s, d: readers.parse_terms(_term_lines(s, d), strict=False).withColumnRenamed("term", "name"),
    f"SELECT replace(t, ' ', '') AS name FROM ({_PART_TERMS})",
)


def _label_lines(s, d):
    line = F.concat(
        F.lit("ds"), F.col("doc_id").cast("string"), F.lit(".text.txt.gz\t['q"), F.col("quality").cast("string"),
        F.lit("', 't"), F.col("toxic").cast("string"), F.lit("']"),
    )
    return load(s, d, "labels").select(line.alias("value"))


register(
    "labels_parse",
    lambda s, d: readers.parse_labels(_label_lines(s, d)).select("column_id", F.explode("labels").alias("label")),
    "SELECT 'ds' || doc_id || '.text' AS column_id, unnest(['q' || quality, 't' || toxic]) AS label FROM labels",
)


def _roundtrip(s, d):
    """Write the profile as JSON, read it back with its schema, and show it flat."""
    from colsight.plans.staging import scratch_folder
    from colsight.sources.writers import write_profiles

    path = scratch_folder(s, "profiles")
    write_profiles(P.profile(raw(s, d, ("customer",))), path)
    back = readers.read_profiles(s, path)
    return P.flatten(back.select("dataset", F.inline("columns")))


register(
    "profile_roundtrip",
    _roundtrip,
    _profile_sql(
        {"customer": ("customer", {c: c for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")})},
        {"c_custkey": "INTEGER (LONG)", "c_nationkey": "INTEGER (LONG)", "c_acctbal": "REAL"},
    ),
)
_HTML = "replace(html, '</a>', ' (A' || CAST(page_id % 7 AS STRING) || 'B)</a>')"
_PLAIN = "regexp_replace(regexp_replace(inner_html, '(?s)<[^>]*>', '', 'g'), '\\s+', ' ', 'g')"
register(
    "link_acronyms",
    lambda s, d: readers.link_acronyms(
        load(s, d, "pages").selectExpr("page_id", f"CASE WHEN page_id % 3 = 0 THEN html ELSE {_HTML} END AS html")
    ),
    f"""SELECT page_id, regexp_extract(t, '^(?:(.*) )?\\(([^ ]*)\\)$', 1) AS name, regexp_extract(t, '^(?:(.*) )?\\(([^ ]*)\\)$', 2) AS acronym
    FROM (SELECT page_id, trim({_PLAIN}) AS t FROM (SELECT page_id, unnest(regexp_extract_all(CASE WHEN page_id % 3 = 0 THEN html ELSE {_HTML} END, '(?is)<a(?:\\s[^>]*)?>(.*?)</a>', 1)) AS inner_html FROM pages))
    WHERE regexp_matches(t, '^(?:(.*) )?\\(([^ ]*)\\)$')""",
)

# --- words --------------------------------------------------------------------------------------------


def _doc_values(s, d):
    """Texts of each language as one column, with counts."""
    return load(s, d, "documents").groupBy(F.concat(F.lit("documents."), "lang").alias("column_id"), F.col("text").alias("val")).agg(F.count(F.lit(1)).alias("count"))


_DOC_VC = "SELECT 'documents.' || lang AS column_id, text AS val, count(*) AS n FROM documents GROUP BY 1, 2"
_CLEAN = "regexp_replace(val, '[\\-$#&,]', '', 'g')"
_WORD_ROWS = f"SELECT column_id, n, unnest(string_split(lower({_CLEAN}), ' ')) AS word FROM ({_DOC_VC})"
for _name, _weighted, _count in (("top_words", False, "count(*)"), ("top_words_weighted", True, "CAST(sum(n) AS BIGINT)")):
    register(
        _name,
        lambda s, d, w=_weighted: M.top_words(_doc_values(s, d), 20, w),
        f"""SELECT column_id, CAST(r AS INTEGER) AS rank, word, count FROM (SELECT *, row_number() OVER (PARTITION BY column_id ORDER BY count DESC, word) AS r
        FROM (SELECT column_id, word, {_count} AS count FROM ({_WORD_ROWS}) WHERE word <> '' GROUP BY 1, 2)) WHERE r <= 20""",
    )

# --- fixed values: which derived columns feed which list ---
_FEEDS = {
    "schools.school": "school_name", "schools.academy": "school_name", "schools.interest3": "area_of_study",
    "schools.subject": "subject_in_school", "places.agency": "city_agency", "places.neighborhood": "neighborhood",
    "people.address": "neighborhood", "places.premise": "location_type", "places.park": "park_playground",
    "web.url": "business_name", "people.street": "business_name",
}
_FEED_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in _FEEDS.items())


def _feeds(s):
    return s.sql(f"SELECT * FROM VALUES {_FEED_VALUES} AS t(column_id, semantic_type)")


def _mine_sql(weighted: bool) -> str:
    limit = " ".join(f"WHEN '{k}' THEN {n}" for k, n in E.TOP_WORDS.items())
    dash = ", ".join(f"'{k}'" for k in E.KEEPS_DASH)
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in R.STOP_WORDS)
    removed = ", ".join(f"('{k}', '{w}')" for k, ws in E.REMOVED_WORDS.items() for w in ws)
    return f"""WITH {VC}, feeds(column_id, semantic_type) AS (VALUES {_FEED_VALUES}),
    words AS (SELECT semantic_type, column_id, n, unnest(string_split(lower(CASE WHEN semantic_type IN ({dash}) THEN regexp_replace(val, '[$#&,]', '', 'g') ELSE {_CLEAN} END), ' ')) AS word FROM vc JOIN feeds USING (column_id)),
    counted AS (SELECT semantic_type, column_id, word, {'sum(n)' if weighted else 'count(*)'} AS c FROM words WHERE word <> '' GROUP BY 1, 2, 3),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY semantic_type, column_id ORDER BY c DESC, word) AS r FROM counted),
    kept AS (SELECT DISTINCT semantic_type, word FROM ranked WHERE r <= CASE semantic_type {limit} END)
    SELECT semantic_type, upper(word) AS term FROM kept WHERE word NOT IN ({stop}) AND (semantic_type, word) NOT IN (VALUES {removed})
    AND (semantic_type <> 'business_name' OR length(word) >= 3)"""


register("mine_keywords", lambda s, d: M.mine_keywords(semantic_values(s, d), _feeds(s)), _mine_sql(False))
register("mine_keywords_weighted", lambda s, d: M.mine_keywords(semantic_values(s, d), _feeds(s), weighted=True), _mine_sql(True))

_MERGE_REMOVED = {"en": ["the", "of"], "fr": ["le"]}
_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in R.STOP_WORDS)


def _merge(s, d):
    docs = load(s, d, "documents").select("lang", F.explode(F.split("text", " ")).alias("word"))
    talk = load(s, d, "conversations").select(F.lit("en").alias("lang"), F.explode(F.split("text", " ")).alias("word"))
    words = docs.unionByName(talk).withColumnRenamed("lang", "semantic_type").where("word <> ''")
    return M.merge_keywords(words, R.STOP_WORDS, _MERGE_REMOVED, {"de": 3})


# upper case of the sharp s differs between the engines, so the oracle spells it out
register(
    "keyword_merge",
    _merge,
    f"""SELECT semantic_type, replace(upper(replace(word, 'ß', '{chr(0xDF)}')), 'ẞ', 'SS') AS term FROM (
        SELECT DISTINCT semantic_type, lower(word) AS word FROM (SELECT lang AS semantic_type, unnest(string_split(text, ' ')) AS word FROM documents
        UNION ALL SELECT 'en', unnest(string_split(text, ' ')) FROM conversations) WHERE word <> '')
    WHERE word NOT IN ({_STOP_SQL}) AND NOT (semantic_type = 'en' AND word IN ('the', 'of')) AND NOT (semantic_type = 'fr' AND word = 'le')
    AND (semantic_type <> 'de' OR length(word) >= 3)""",
)


# --- frequent word sets -----------------------------------------------------------------------------------


def _keyed_baskets(s, d):
    """(basket, items): part types and flags met in each order; one shuffle besides the join's."""
    lines = load(s, d, "lineitem").join(load(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    words = F.array(F.col("p_type"), F.col("l_returnflag"), F.concat(F.lit("line"), F.col("l_linestatus")))
    return lines.groupBy(F.col("l_orderkey").alias("basket")).agg(F.array_distinct(F.flatten(F.collect_set(words))).alias("items"))


def _baskets(s, d):
    return _keyed_baskets(s, d).select("items")


_BASKET_SQL = """b AS (SELECT DISTINCT l_orderkey, unnest([p_type, l_returnflag, 'line' || l_linestatus]) AS w FROM lineitem JOIN part ON l_partkey = p_partkey),
    total AS (SELECT count(DISTINCT l_orderkey) AS n FROM b),
    s1 AS (SELECT w AS a, count(*) AS f FROM b GROUP BY 1),
    s2 AS (SELECT x.w AS a, y.w AS b, count(*) AS f FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.w < y.w GROUP BY 1, 2),
    s3 AS (SELECT x.w AS a, y.w AS b, z.w AS c, count(*) AS f FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.w < y.w JOIN b z ON y.l_orderkey = z.l_orderkey AND y.w < z.w GROUP BY 1, 2, 3),
    s4 AS (SELECT x.w AS a, y.w AS b, z.w AS c, u.w AS d, count(*) AS f FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.w < y.w JOIN b z ON y.l_orderkey = z.l_orderkey AND y.w < z.w JOIN b u ON z.l_orderkey = u.l_orderkey AND z.w < u.w GROUP BY 1, 2, 3, 4),
    s5 AS (SELECT x.w AS a, y.w AS b, z.w AS c, u.w AS d, v.w AS e, count(*) AS f FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.w < y.w JOIN b z ON y.l_orderkey = z.l_orderkey AND y.w < z.w JOIN b u ON z.l_orderkey = u.l_orderkey AND z.w < u.w JOIN b v ON u.l_orderkey = v.l_orderkey AND u.w < v.w GROUP BY 1, 2, 3, 4, 5),
    sets AS (SELECT a AS items, f FROM s1 UNION ALL SELECT a || ',' || b, f FROM s2 UNION ALL SELECT a || ',' || b || ',' || c, f FROM s3
        UNION ALL SELECT a || ',' || b || ',' || c || ',' || d, f FROM s4 UNION ALL SELECT a || ',' || b || ',' || c || ',' || d || ',' || e, f FROM s5),
    freq AS (SELECT items, f AS freq FROM sets, total WHERE f >= ceil(0.3 * n))"""
register(
    "frequent_itemsets",
    lambda s, d: M.frequent_itemsets(_baskets(s, d), 0.3).select(F.array_join("items", ",").alias("items"), "freq"),
    f"WITH {_BASKET_SQL} SELECT items, freq FROM freq",
)
_RULES_SQL = """ante AS (SELECT freq.items AS whole, freq.freq AS wf, unnest(string_split(freq.items, ',')) AS consequent FROM freq WHERE contains(freq.items, ',')),
    split AS (SELECT *, array_to_string(list_filter(string_split(whole, ','), lambda x: x <> consequent), ',') AS antecedent FROM ante)
    SELECT antecedent, consequent, round(wf / p.freq, 6) AS confidence, round(wf / p.freq / (q.freq / n), 6) AS lift, round(wf / n, 6) AS support
    FROM split JOIN freq p ON p.items = antecedent JOIN freq q ON q.items = consequent, total WHERE wf / p.freq >= 0.7"""
register(
    "association_rules",
    lambda s, d: M.association_rules(_baskets(s, d), 0.3, 0.7).select(
        F.array_join("antecedent", ",").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")],
    ),
    f"WITH {_BASKET_SQL}, {_RULES_SQL}",
)

register(
    "apply_rules",
    lambda s, d: M.apply_rules(_keyed_baskets(s, d), M.association_rules(_baskets(s, d), 0.3, 0.5)).withColumn("confidence", F.round("confidence", 6)),
    f"""WITH {_BASKET_SQL}, rules AS MATERIALIZED (SELECT string_split(antecedent, ',') AS ante, consequent, confidence FROM ({_RULES_SQL.replace('ante AS', 'WITH ante AS').replace('>= 0.7', '>= 0.5')})),
    held AS MATERIALIZED (SELECT l_orderkey AS basket, list(w) AS items FROM b GROUP BY 1)
    SELECT basket, consequent, max(confidence) AS confidence FROM held, rules WHERE list_has_all(items, ante) AND NOT list_contains(items, consequent) GROUP BY 1, 2""",
)

# --- names and n-grams --------------------------------------------------------------------------------------

_NAME_SOURCES = (("part", "p_name"), ("part", "p_type"), ("nation", "n_name"), ("region", "r_name"), ("customer", "c_mktsegment"), ("events", "event_type"), ("pages", "url"))


def names(s, d):
    """(item): distinct cleaned names."""
    out = None
    for table, column in _NAME_SOURCES:
        part = load(s, d, table).select(T.clean_name(F.col(column)).alias("item"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


_CLEANED = "regexp_replace(lower({}), '[^a-z0-9\\s]', ' ', 'g')"
NAMES_SQL = "SELECT DISTINCT item FROM (" + " UNION ALL ".join(f"SELECT {_CLEANED.format(c)} AS item FROM {t}" for t, c in _NAME_SOURCES) + ")"
register(
    "clean_name",
    lambda s, d: load(s, d, "pages").select("url", T.clean_name(F.col("url")).alias("name")),
    f"SELECT url, {_CLEANED.format('url')} AS name FROM pages",
)


def _grams_sql(rows: str, key: str, text: str, n: int) -> str:
    return f"SELECT {key}, substr({text}, CAST(i AS INTEGER), {n}) AS gram FROM (SELECT {key}, {text}, unnest(range(1, length({text}) - {n - 2})) AS i FROM ({rows}))"


def _word_grams_sql(rows: str, key: str, words: str, n: int) -> str:
    """`rows` has `key` and a list of words."""
    return f"SELECT {key}, array_to_string(list_slice({words}, i, i + {n - 1}), ' ') AS gram FROM (SELECT {key}, {words}, unnest(range(1, len({words}) - {n - 2})) AS i FROM ({rows}))"


_ALPHA = "string_split(trim(regexp_replace({}, '[^a-zA-Z]+', ' ', 'g')), ' ')"
_DOC_GRAMS = _word_grams_sql(f"SELECT doc_id, {_ALPHA.format('text')} AS w FROM documents", "doc_id", "w", 4)
register(
    "char_ngrams",
    lambda s, d: Z.gram_bags(names(s, d), T.char_ngrams(F.col("item"))),
    f"SELECT item, gram, count(*) AS n FROM ({_grams_sql(NAMES_SQL, 'item', 'item', 3)}) GROUP BY 1, 2",
)
register(
    "word_ngrams",
    lambda s, d: Z.gram_counts(load(s, d, "documents").withColumnRenamed("doc_id", "item"), T.word_ngrams(F.col("text"))),
    f"SELECT gram, count(DISTINCT doc_id) AS items, count(*) AS n FROM ({_DOC_GRAMS}) GROUP BY 1",
)
register(
    "sentence_ngrams",
    lambda s, d: Z.gram_counts(load(s, d, "documents").withColumnRenamed("doc_id", "item"), T.word_ngrams(F.col("text"), sentences=True)),
    "SELECT gram, count(DISTINCT doc_id) AS items, count(*) AS n FROM ("
    + _word_grams_sql(
        f"SELECT doc_id, {_ALPHA.format('sentence')} AS w FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[.\\n]')) AS sentence FROM documents)",
        "doc_id", "w", 4,
    )
    + ") GROUP BY 1",
)

# --- similarity -------------------------------------------------------------------------------------------------

_DOC_REPS = "reps AS (SELECT min(doc_id) AS item, text FROM documents GROUP BY text)"


def _documents(s, d):
    kept, _ = Z.representatives(load(s, d, "documents").select(F.col("doc_id").alias("item"), "text"))
    return kept


def _pairs_sql(bag: str, metric: str, score: float) -> str:
    value = "dot / (sqrt(x.m) * sqrt(y.m))" if metric == "cosine" else "common / (x.m + y.m - common)"
    mass = "sum(n * n)" if metric == "cosine" else "count(*)"
    return f"""{bag}, sizes AS (SELECT item, CAST({mass} AS BIGINT) AS m FROM bag GROUP BY 1),
    shared AS (SELECT p.item AS a, q.item AS b, CAST(sum(p.n * q.n) AS BIGINT) AS dot, count(*) AS common FROM bag p JOIN bag q ON p.gram = q.gram AND p.item < q.item GROUP BY 1, 2),
    edges AS (SELECT a, b, {value} AS score FROM shared JOIN sizes x ON x.item = a JOIN sizes y ON y.item = b WHERE {value} >= {score})"""


_DOC_BAG = f"{_DOC_REPS}, bag AS (SELECT item, gram, count(*) AS n FROM ({_word_grams_sql('SELECT item, ' + _ALPHA.format('text') + ' AS w FROM reps', 'item', 'w', 4)}) GROUP BY 1, 2)"
_NAME_BAG = f"bag AS (SELECT item, gram, count(*) AS n FROM ({_grams_sql(NAMES_SQL, 'item', 'item', 3)}) GROUP BY 1, 2)"
for _metric in ("jaccard", "cosine"):
    register(
        f"{_metric}_pairs",
        lambda s, d, m=_metric: Z.similar_pairs(_documents(s, d), T.word_ngrams(F.col("text")), m, 0.5).withColumn("score", F.round("score", 6)),
        f"WITH {_pairs_sql(_DOC_BAG, _metric, 0.5)} SELECT a, b, round(score, 6) AS score FROM edges",
    )


def _minhash_recall(s, d):
    """Pairs of the exact join, whether the index finds nine of ten of them, and how many it finds besides."""
    docs, grams = _documents(s, d), T.word_ngrams(F.col("text"))
    found = X.near_pairs(docs, grams, 0.5).select("a", "b", F.lit(1).alias("found"))
    exact = Z.similar_pairs(docs, grams, "jaccard", 0.5).select("a", "b", F.lit(1).alias("exact"))
    both = exact.join(found, ["a", "b"], "full")
    hits = F.count(F.when(F.col("exact").isNotNull() & F.col("found").isNotNull(), 1))
    return both.agg(F.count("exact").alias("pairs"), (hits >= 0.9 * F.count("exact")).alias("recall_reached"), F.count(F.when(F.col("exact").isNull(), 1)).alias("wrong"))


register("minhash_recall", _minhash_recall, f"WITH {_pairs_sql(_DOC_BAG, 'jaccard', 0.5)} SELECT count(*) AS pairs, true AS recall_reached, CAST(0 AS BIGINT) AS wrong FROM edges")
register(
    "document_copies",
    lambda s, d: Z.representatives(load(s, d, "documents").select(F.col("doc_id").alias("item"), "text"))[1],
    "SELECT doc_id AS item, min(doc_id) OVER (PARTITION BY text) AS representative FROM documents",
)


def _name_edges(s, d, score=0.8, metric="cosine"):
    return Z.similar_pairs(names(s, d), T.char_ngrams(F.col("item")), metric, score)


register(
    "name_similarity",
    lambda s, d: _name_edges(s, d).withColumn("score", F.round("score", 6)),
    f"WITH {_pairs_sql(_NAME_BAG, 'cosine', 0.8)} SELECT a, b, round(score, 6) AS score FROM edges",
)
register(
    "name_similarity_jaccard",
    lambda s, d: _name_edges(s, d, 0.6, "jaccard").withColumn("score", F.round("score", 6)),
    f"WITH {_pairs_sql(_NAME_BAG, 'jaccard', 0.6)} SELECT a, b, round(score, 6) AS score FROM edges",
)


def _clusters(s, d):
    return K.components(_name_edges(s, d), names(s, d))


_CLUSTER_SQL = f"""WITH RECURSIVE {_pairs_sql(_NAME_BAG, 'cosine', 0.8)}, both_ways AS MATERIALIZED (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach(item, other) AS (SELECT item, item FROM ({NAMES_SQL}) UNION SELECT r.item, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
    clusters AS (SELECT item, min(other) AS cluster_id FROM reach GROUP BY 1)"""
register("name_clusters", _clusters, f"{_CLUSTER_SQL} SELECT item, cluster_id FROM clusters")


# one forest and its cuts; scores are rounded first, so that both engines order equal ones alike
_LEVELS = (0.8, 0.88, 0.95)


def _name_forest(s, d):
    return H.spanning_forest(_name_edges(s, d).withColumn("score", F.round("score", 6)))


_FOREST_SQL = f"""WITH RECURSIVE {_pairs_sql(_NAME_BAG, 'cosine', 0.8)}, e AS MATERIALIZED (SELECT a, b, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 6) DESC, a, b) AS r FROM edges),
    near AS MATERIALIZED (SELECT a AS x, b AS y, r FROM e UNION ALL SELECT b, a, r FROM e),
    walk(r, x) AS (SELECT r, a FROM e UNION SELECT w.r, near.y FROM walk w JOIN near ON near.x = w.x AND near.r < w.r),
    forest AS MATERIALIZED (SELECT a, b, score FROM e ANTI JOIN walk ON walk.r = e.r AND walk.x = e.b)"""
register("name_forest", _name_forest, f"{_FOREST_SQL} SELECT a, b, score FROM forest")
register(
    "name_cuts",
    lambda s, d: H.cuts(_name_forest(s, d), names(s, d), _LEVELS),
    f"""WITH RECURSIVE {_pairs_sql(_NAME_BAG, 'cosine', 0.8)}, levels(level) AS (VALUES (0.8::DOUBLE), (0.88), (0.95)),
    near AS MATERIALIZED (SELECT a AS x, b AS y, round(score, 6) AS s FROM edges UNION ALL SELECT b, a, round(score, 6) FROM edges),
    reach(item, level, other) AS (SELECT item, level, item FROM ({NAMES_SQL}), levels UNION SELECT r.item, r.level, near.y FROM reach r JOIN near ON near.x = r.other AND near.s >= r.level)
    SELECT item, level, min(other) AS cluster_id FROM reach GROUP BY 1, 2""",
)
register(
    "name_inconsistency",
    lambda s, d: H.inconsistency(_name_forest(s, d)).withColumn("coefficient", F.round("coefficient", 4)),
    f"""{_FOREST_SQL}, met AS (SELECT p.a, p.b, p.score, 1 - q.score AS h FROM forest p LEFT JOIN forest q ON (p.a IN (q.a, q.b) OR p.b IN (q.a, q.b)) AND (p.a, p.b) <> (q.a, q.b))
    SELECT a, b, score, count(h) AS neighbours, round(CASE WHEN count(h) > 1 AND round(stddev_samp(h), 9) > 0 THEN (1 - score - avg(h)) / stddev_samp(h) END, 4) AS coefficient FROM met GROUP BY 1, 2, 3""",
)


def _cluster_lists(s, d):
    clusters = _clusters(s, d)
    chosen = clusters.select("cluster_id", F.upper(F.split_part("cluster_id", F.lit(" "), F.lit(1))).alias("semantic_type")).distinct()
    return K.cluster_lists(clusters, chosen, contains="en")


register(
    "cluster_lists",
    _cluster_lists,
    f"{_CLUSTER_SQL} SELECT upper(split_part(cluster_id, ' ', 1)) AS semantic_type, item FROM clusters WHERE contains(item, 'en')",
)


def _minhash_sql(rows: str, n_hashes: int) -> str:
    x = "CAST(0 AS BIGINT)"
    for i in (1, 2, 3):
        x = f"((({x}) * {Z.CODE_POINTS} + unicode(substr(gram, {i}, 1))) % {Z.MINHASH_PRIME})"
    mins = ", ".join(f"min((CAST({a} AS BIGINT) * x + {b}) % {Z.MINHASH_PRIME}) AS h{i}" for i, (a, b) in enumerate(Z.minhash_family(n_hashes)))
    return f"SELECT r.item, {', '.join(f'h{i}' for i in range(n_hashes))} FROM ({rows}) r LEFT JOIN (SELECT item, {mins} FROM (SELECT item, CAST({x} AS BIGINT) AS x FROM ({_grams_sql(rows, 'item', 'text', 3)})) GROUP BY 1) m ON r.item = m.item"


register(
    "minhash_signatures",
    lambda s, d: Z.minhash(load(s, d, "documents").select(F.col("doc_id").alias("item"), "text"), T.char_ngrams(F.col("text"))),
    _minhash_sql("SELECT doc_id AS item, text FROM documents", 8),
)
