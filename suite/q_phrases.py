"""Names inside longer values, and large term lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsight.operators import cells, phrases
from suite.corpus import load, register, tables, values_sql
from suite.q_semantic import ENTITIES, _entity_sql, _share6, entities

# values with none, one or several names, once or twice
_PERSON = "'Customer#' || lpad(CAST({0} AS STRING), 9, '0')"
_LINES = {
    "lines": (
        "supplier",
        {
            "who city ": f"CASE s_suppkey % 4 WHEN 0 THEN {_PERSON.format('s_suppkey')} || ', NATION_' || CAST(s_nationkey AS STRING) || ' (NATION_1)' WHEN 1 THEN 'c/o ' || s_name || '; NATION_' || CAST(s_nationkey AS STRING) WHEN 2 THEN 'nobody' ELSE 'NATION_' || CAST(s_nationkey AS STRING) || 'x' END",
            "first name": f"{_PERSON.format('s_suppkey')} || ' and ' || {_PERSON.format('s_suppkey + 1')} || CASE WHEN s_suppkey % 3 = 0 THEN ' of NATION_' || CAST(s_nationkey AS STRING) ELSE '' END",
            "only people": _PERSON.format("s_suppkey"),
        },
    )
}
_NORM = "' ' || trim(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' '"


def _line_values(s, d):
    return cells.column_values(cells.value_counts(tables(s, d, _LINES)))


# four blanks between words and two around a name: how often it stands in a value, by what its removal takes off
_FOUND = f"""found AS (SELECT column_id, n, val, label, (length(v) - length(replace(v, t, ''))) // length(t) AS times
    FROM (SELECT *, replace({_NORM.format('val')}, ' ', '    ') AS v FROM ({values_sql(_LINES)})),
    (SELECT DISTINCT label, '  ' || replace(trim({_NORM.format('term')}), ' ', '    ') || '  ' AS t FROM entities) WHERE contains(v, t))"""
_SUMS = "esums AS (SELECT vc.column_id, max(n_values) AS n_values, " + ", ".join(
    f"CAST(coalesce(sum(w) FILTER (label = '{k}'), 0) AS BIGINT) AS {k.lower()}" for k in ("GPE", "PERSON", "ORG")
) + f" FROM (SELECT column_id, count(*) AS n_values FROM ({values_sql(_LINES)}) GROUP BY 1) vc LEFT JOIN (SELECT column_id, label, n * times AS w FROM found) f ON f.column_id = vc.column_id GROUP BY 1)"
for _name, _gated in (("names_within", False), ("names_within_gated", True)):
    register(
        _name,
        lambda s, d, gated=_gated: _share6(phrases.entity_share_within(_line_values(s, d), entities(s, d), gated)),
        f"WITH {ENTITIES}, {_FOUND}, {_SUMS} SELECT * REPLACE (round(share, 6) AS share) FROM ({_entity_sql(_gated)})",
    )


# every customer is a term, and so are short texts; values name one, two or none, some without a blank before
_TERMS = "SELECT 'customer' AS semantic_type, c_name AS term FROM customer UNION ALL SELECT 'short', 'of' UNION ALL SELECT 'short', 'X' UNION ALL SELECT 'brand', p_brand || '(+)' FROM part"
_NOTES = {
    "notes": (
        "orders",
        {
            "note": f"CASE o_orderkey % 5 WHEN 0 THEN 'sold to ' || {_PERSON.format('o_custkey')} WHEN 1 THEN {_PERSON.format('o_custkey')} WHEN 2 THEN 'copy of ' || {_PERSON.format('o_custkey')} || ' for ' || {_PERSON.format('o_custkey + 3')} WHEN 3 THEN 'X-' || o_orderpriority || ' X' ELSE 'like Brand#' || CAST(o_custkey % 60 AS STRING) || '(+)' END",
            "status": "o_orderstatus",
        },
    )
}


def _terms(s, d):
    part = load(s, d, "part").select(F.lit("brand").alias("semantic_type"), F.concat("p_brand", F.lit("(+)")).alias("term"))
    short = s.sql("SELECT * FROM VALUES ('short', 'of'), ('short', 'X') AS t(semantic_type, term)")
    return load(s, d, "customer").select(F.lit("customer").alias("semantic_type"), F.col("c_name").alias("term")).unionByName(part).unionByName(short)


register(
    "detect_terms",
    lambda s, d: _share6(phrases.detect_terms(cells.column_values(cells.value_counts(tables(s, d, _NOTES))), _terms(s, d))),
    f"""WITH vc AS MATERIALIZED ({values_sql(_NOTES)}), terms AS MATERIALIZED (SELECT DISTINCT * FROM ({_TERMS})),
    hits AS (SELECT DISTINCT column_id, val, n, semantic_type FROM vc, terms WHERE contains(val, ' ' || term))
    SELECT column_id, semantic_type, CAST(sum(n) AS BIGINT) AS weight, round(sum(n) / any_value(total), 6) AS share
    FROM hits JOIN (SELECT column_id, sum(n) AS total FROM vc GROUP BY 1) USING (column_id) GROUP BY 1, 2""",
)
