"""Profile queries: counts, statistics, interpretation, corpus roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsight.functions import interpret as I
from colsight.operators import cells, dates, evaluate, generic
from colsight.plans import profile as P
from suite.corpus import (
    AMBIGUOUS,
    MESSY,
    SPARSE,
    cells_sql,
    load,
    raw,
    raw_corpus,
    register,
    tables,
    vc_sql,
)

RAW_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
RAW = raw_corpus(RAW_COLUMNS)
NAMES = tuple(RAW)
LINEITEM = raw_corpus(
    {
        "lineitem": [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        ]
    }
)
BOTH = {**RAW, **LINEITEM}


def raw_vc(spark, sf_dir, names=NAMES):
    return cells.value_counts(raw(spark, sf_dir, names))


def made_vc(spark, sf_dir, corpus):
    return cells.value_counts(tables(spark, sf_dir, corpus))


# --- counts -------------------------------------------------------------------------------

register(
    "value_counts",
    lambda s, d: raw_vc(s, d, ("customer", "part", "orders", "lineitem")).select("dataset", "column_name", "val", "count"),
    f"SELECT dataset, column_name, val, n AS count FROM ({vc_sql(BOTH, ('customer', 'part', 'orders', 'lineitem'))})",
)
register(
    "cell_counts",
    lambda s, d: cells.cell_counts({**raw(s, d, (*NAMES, "lineitem")), **tables(s, d, SPARSE)}),
    f"""SELECT dataset, column_name, count(val) AS non_empty, count(*) - count(val) AS empty
    FROM ({cells_sql(BOTH)} UNION ALL {cells_sql(SPARSE)}) GROUP BY 1, 2""",
)
register(
    "distinct_counts",
    lambda s, d: cells.distinct_counts(raw_vc(s, d, (*NAMES, "lineitem")).unionByName(made_vc(s, d, SPARSE))),
    f"""SELECT dataset, column_name, count(val) AS non_empty, count(*) - count(val) AS empty,
        count(DISTINCT val) AS distinct_values
    FROM ({cells_sql(BOTH)} UNION ALL {cells_sql(SPARSE)}) GROUP BY 1, 2""",
)
register(
    "key_candidates",
    lambda s, d: cells.key_candidates(raw_vc(s, d).unionByName(made_vc(s, d, SPARSE))),
    f"""SELECT dataset, column_name, count(DISTINCT val) AS distinct_values
    FROM ({cells_sql(RAW)} UNION ALL {cells_sql(SPARSE)}) GROUP BY 1, 2 HAVING count(val) = count(DISTINCT val)""",
)
register(
    "key_candidates_strict",
    lambda s, d: cells.key_candidates(raw_vc(s, d).unionByName(made_vc(s, d, SPARSE)), strict=True),
    f"""SELECT dataset, column_name, count(DISTINCT val) AS distinct_values
    FROM ({cells_sql(RAW)} UNION ALL {cells_sql(SPARSE)}) GROUP BY 1, 2
    HAVING count(*) = count(DISTINCT val) + max(CASE WHEN val IS NULL THEN 1 ELSE 0 END)""",
)
register(
    "quoted_names",
    lambda s, d: cells.distinct_counts(made_vc(s, d, MESSY)),
    f"""SELECT dataset, column_name, count(val) AS non_empty, count(*) - count(val) AS empty,
        count(DISTINCT val) AS distinct_values FROM ({cells_sql(MESSY)}) GROUP BY 1, 2""",
)
register(
    "bool_profile",
    lambda s, d: generic.frequent_values(made_vc(s, d, SPARSE).where(F.col("column_name") == "is big")),
    """SELECT 'sparse' AS dataset, 'is big' AS column_name, CAST(row_number() OVER (ORDER BY count(*) DESC, val) AS INTEGER) AS rank,
        val, count(*) AS count FROM (SELECT CAST(o_totalprice > 250000 AS VARCHAR) AS val FROM orders) GROUP BY val""",
)

# spark type and bucket of every column, with its cells
_DISPATCH = {"INTEGER": ("int", "INTEGER (LONG)"), "BIGINT": ("bigint", "INTEGER (LONG)"), "DOUBLE": ("double", "REAL"),
             "TIMESTAMP": ("timestamp_ntz", "DATE/TIME"), "VARCHAR": ("string", "TEXT"), "FLOAT[]": ("array<float>", None)}


def _type_dispatch(s, d):
    names = (*NAMES, "embeddings")
    parts = [cells.type_dispatch(load(s, d, n), n) for n in names]
    types = parts[0]
    for p in parts[1:]:
        types = types.unionByName(p)
    counts = cells.cell_counts(raw(s, d, names))
    return types.join(counts, ["dataset", "column_name"], "left").select(
        "dataset", "column_name", "spark_type", "bucket", "non_empty"
    )


def _dispatch_sql():
    parts = []
    for t, cols in {**RAW_COLUMNS, "embeddings": ["vec_id", "embedding", "label"]}.items():
        for c in cols:
            kind = f"(SELECT typeof({c}) FROM {t} LIMIT 1)"
            spark_type = f"CASE {kind} " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in _DISPATCH.items()) + " END"
            bucket = f"CASE {kind} " + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in _DISPATCH.items() if v[1]) + " END"
            parts.append(
                f"SELECT '{t}' AS dataset, '{c}' AS column_name, {spark_type} AS spark_type, {bucket} AS bucket, "
                f"CASE WHEN {bucket} IS NOT NULL THEN (SELECT count({c}) FROM {t}) END AS non_empty"
            )
    return " UNION ALL ".join(parts)


register("type_dispatch", _type_dispatch, _dispatch_sql())

# --- frequent values, shortest, longest ------------------------------------------------------

_RANKED = "row_number() OVER (PARTITION BY dataset, column_name ORDER BY {})"
register(
    "frequent_values",
    lambda s, d: generic.frequent_values(raw_vc(s, d, (*NAMES, "lineitem"))),
    f"""SELECT dataset, column_name, CAST(r AS INTEGER) AS rank, val, n AS count FROM (
        SELECT *, {_RANKED.format('n DESC, val')} AS r FROM ({vc_sql(BOTH)}) WHERE val IS NOT NULL) WHERE r <= 5""",
)

_TEXT_COLUMNS = {
    "part": ["p_name", "p_brand", "p_type"], "customer": ["c_name", "c_mktsegment"],
    "conversations": ["role", "text"], "orders": ["o_orderstatus", "o_orderpriority"],
}
_TEXT = {**raw_corpus(_TEXT_COLUMNS), **MESSY}


def _text_vc(s, d):
    named = {t: load(s, d, t).select(*cols) for t, cols in _TEXT_COLUMNS.items()}
    return cells.value_counts({**named, **tables(s, d, MESSY)})


def _extreme_sql(order: str) -> str:
    return f"""SELECT dataset, column_name, CAST(r AS INTEGER) AS rank, val, CAST(length(val) AS INTEGER) AS length FROM (
        SELECT *, {_RANKED.format(f'length(val) {order}, val')} AS r FROM ({cells_sql(_TEXT)}) WHERE val <> '') WHERE r <= 5"""


register("text_shortest", lambda s, d: generic.text_extremes(_text_vc(s, d), longest=False), _extreme_sql("ASC"))
register("text_longest", lambda s, d: generic.text_extremes(_text_vc(s, d), longest=True), _extreme_sql("DESC"))
register(
    "text_longest_distinct",
    lambda s, d: generic.text_extremes(_text_vc(s, d), longest=True, distinct=True),
    f"""SELECT dataset, column_name, CAST(r AS INTEGER) AS rank, val, CAST(length(val) AS INTEGER) AS length FROM (
        SELECT *, {_RANKED.format('length(val) DESC, val')} AS r FROM ({vc_sql(_TEXT)}) WHERE val <> '') WHERE r <= 5""",
)
register(
    "text_avg_length",
    lambda s, d: generic.text_average_length(_text_vc(s, d)).withColumn("average_length", F.round("average_length", 4)),
    f"""SELECT dataset, column_name, count(*) AS count, round(avg(length(val)), 4) AS average_length
    FROM ({cells_sql(_TEXT)}) WHERE val <> '' GROUP BY 1, 2""",
)

# --- numbers -----------------------------------------------------------------------------------


def _rounded(df):
    return df.select(
        "dataset", "column_name", "type", "count",
        *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("max_value", "min_value", "mean", "stddev")],
    )


def _numeric_sql(corpus, kinds, zero=False):
    parts = []
    for t, (table, cols) in corpus.items():
        for name, expr in cols.items():
            kind = kinds.get(name)
            if not kind:
                continue
            stats = {"max_value": f"max({expr})", "min_value": f"min({expr})", "mean": f"avg({expr})", "stddev": f"stddev_samp({expr})"}
            shown = ", ".join(
                f"round(CAST({'coalesce(' + e + ', 0)' if zero else e} AS DOUBLE), 4) AS {k}" for k, e in stats.items()
            )
            parts.append(
                f"SELECT '{t}' AS dataset, '{name}' AS column_name, '{kind}' AS type, count({expr}) AS count, {shown} FROM {table} HAVING count({expr}) > 0"
            )
    return " UNION ALL ".join(parts)


_INT, _REAL = "INTEGER (LONG)", "REAL"
_KINDS = {
    **{c: _INT for c in "r_regionkey n_nationkey n_regionkey c_custkey c_nationkey s_suppkey s_nationkey p_partkey p_size o_orderkey o_custkey event_id user_id conv_id turn l_orderkey l_partkey l_suppkey l_linenumber".split()},
    **{c: _REAL for c in "c_acctbal s_acctbal p_retailprice o_totalprice value l_quantity l_extendedprice l_discount l_tax".split()},
}
_SPARSE_KINDS = {"id": _INT, "id_or_null": _INT, "one_null": _INT, "price": _REAL, "never": _INT}
register(
    "numeric_stats",
    lambda s, d: _rounded(generic.numeric_stats({**raw(s, d, (*NAMES, "lineitem")), **tables(s, d, SPARSE)}, interpret=False)),
    _numeric_sql(BOTH, _KINDS) + " UNION ALL " + _numeric_sql(SPARSE, _SPARSE_KINDS),
)


def _one_row_stats(s, d):
    # groups of one row have no spread, which the option turns into 0
    first = {"one": load(s, d, "orders").where("o_orderkey = 7"), "all": load(s, d, "orders")}
    return _rounded(generic.numeric_stats(first, nan_to_zero=True, interpret=False))


register(
    "numeric_stats_nan0",
    _one_row_stats,
    _numeric_sql(
        {
            "one": ("(SELECT * FROM orders WHERE o_orderkey = 7)", {c: c for c in RAW_COLUMNS["orders"]}),
            "all": ("orders", {c: c for c in RAW_COLUMNS["orders"]}),
        },
        _KINDS,
        zero=True,
    ),
)
_DESCRIBED = ("customer", "part", "orders")
register(
    "describe_column",
    lambda s, d: cells_union([generic.describe_columns(load(s, d, n).select(*RAW_COLUMNS[n]), n) for n in _DESCRIBED]).withColumns(
        {c: F.round(c, 4) for c in ("mean", "stddev")}
    ),
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, count({c}) AS count, "
        + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, " if c in _KINDS else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, ")
        + f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM {t}"
        for t in _DESCRIBED
        for c in RAW_COLUMNS[t]
    ),
)


def cells_union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# the SQL below shares no pattern, layout or limit with the library
INT_SQL = "TRY_CAST(CASE WHEN regexp_full_match(trim(val), '[+-]?\\d+') THEN trim(val) END AS BIGINT)"
REAL_SQL = "TRY_CAST(CASE WHEN regexp_full_match(lower(trim(val)), '[+-]?(\\d+\\.\\d*|\\.\\d+)(e[+-]?\\d+)?') THEN trim(val) END AS DOUBLE)"
NUMERIC_SQL = "regexp_full_match(lower(trim(val)), '[+-]?(\\d+|\\d+\\.\\d*|\\.\\d+|\\d+e[+-]?\\d+|\\d+\\.\\d*e[+-]?\\d+|\\.\\d+e[+-]?\\d+|inf|infinity|nan)')"
register(
    "integral_reals",
    lambda s, d: generic.integral_reals(made_vc(s, d, MESSY)),
    f"""SELECT dataset, column_name, val, CAST({REAL_SQL} AS BIGINT) AS as_int, n AS count FROM ({vc_sql(MESSY)})
    WHERE ({REAL_SQL}) % 1 = 0""",
)

# --- interpretation ------------------------------------------------------------------------------


_SHAPES = ("00-00-0000", "0000-00-00", "00-00-00", "00-0000", "0000-00", "00-aaa", "aaa-00")
_MONTHS = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_DAYS = (
    "%m-%d-%y", "%d-%m-%y", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d %b %Y", "%b %d, %Y", "%b %d %Y", "%d %b, %Y", "%B - %d - %Y  ,", "%Y-%m", "%b %Y",
)
_TIMES = ("%H:%M", "%H:%M:%S", "%H:%M:%S.%f", "%I:%M %p", "%I:%M:%S %p", "%I:%M:%S.%f %p")


def interpreted_sql(source: str, level: str = "high") -> str:
    """Rows of `source` with as_int, as_real, as_ts and kind: known formats tried in turn."""
    dashes, colons, slashes = (f"(length(val) - length(replace(val, '{c}', '')))" for c in "-:/")
    seen = " OR ".join(
        f"translate(regexp_replace(lower(val), '[0-9]', '0', 'g'), 'bcdefghijklmnopqrstuvwxyz', 'aaaaaaaaaaaaaaaaaaaaaaaaa') LIKE '%{s.replace('-', sep)}%'"
        for s in _SHAPES
        for sep in "-/ "
    )
    gate = {
        "high": f"({seen} OR val LIKE '%:%')",
        "moderate": f"((regexp_matches(lower(val), '{_MONTHS}') AND {dashes} BETWEEN 1 AND 2) OR {dashes} = 2 OR {colons} BETWEEN 1 AND 2 OR {slashes} = 2)",
        "low": "val <> ''",
    }[level]
    spelled = ("%b %d %H:%M:%S %Y", "%Y%m%d %H%M%S", "%b %d, %Y at %I%p", "%d of %b %Y", "%Y-%m-%d %Hh%Mm")
    formats = [*spelled, *_DAYS, *(f"{d} {t}" for d in _DAYS for t in _TIMES), *(f"{d}  {t}" for d in _DAYS for t in _TIMES)]
    listed = "[" + ", ".join(f"'{f}'" for f in formats) + "]"
    zoned = "[" + ", ".join(f"'%Y-%m-%d {t} %z'" for t in _TIMES) + "]"
    no_year = "['%Y %b-%d', '%Y %d %b', '%Y %b %d', '%Y %H:%M', '%Y %H:%M:%S']"
    # one spelling: no weekday, no T, am/pm without points, six digits of a second, a blank before the offset, no UTC mark
    plain = "lower(trim(val))"
    for pattern, by in (
        (r"^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[.]?,?\s+", ""),
        (r"(\d)t(\d)", r"\1 \2"),
        (r"(\d)(th|rd)\b", r"\1"),
        (r" est$", ""),
        (r"\b([ap])[.]m[.]", r"\1m"),
        (r"([.]\d{6})\d+", r"\1"),
        (r"\s*(z|utc|gmt)$", ""),
        (r"(:\d\d([.]\d+)?( [ap]m)?)([+-]\d\d)$", r"\1 \4:00"),
        (r"(:\d\d([.]\d+)?( [ap]m)?)([+-]\d\d):?(\d\d)$", r"\1 \4:\5"),
    ):
        plain = f"regexp_replace({plain}, '{pattern}', '{by}')"
    return f"""(SELECT * EXCLUDE (plain), CASE WHEN val IS NULL THEN NULL WHEN as_int IS NOT NULL THEN 'int'
        WHEN as_real IS NOT NULL THEN 'real' WHEN as_ts IS NOT NULL THEN 'date' WHEN {NUMERIC_SQL} THEN 'unclassified' ELSE 'text' END AS kind
    FROM (SELECT *, coalesce(try_strptime(plain, {listed}), CAST(try_strptime(plain, {zoned}) AS TIMESTAMP), try_strptime('1970 ' || plain, {no_year})) AS as_ts
    FROM (SELECT *, {INT_SQL} AS as_int, {REAL_SQL} AS as_real, CASE WHEN {gate} AND NOT {NUMERIC_SQL} THEN {plain} END AS plain
    FROM ({source}))))"""


def _interpret(level="high"):
    def run(s, d):
        return I.with_interpretation(made_vc(s, d, MESSY), "val", level)

    return run


_KEEP = ["dataset", "column_name", "val"]
register(
    "interpret_int",
    lambda s, d: made_vc(s, d, MESSY).select(*_KEEP, I.interpret_int(F.col("val")).alias("as_int")),
    f"SELECT dataset, column_name, val, {INT_SQL} AS as_int FROM ({vc_sql(MESSY)})",
)
register(
    "interpret_float",
    lambda s, d: made_vc(s, d, MESSY).select(*_KEEP, I.interpret_real(F.col("val")).alias("as_real")),
    f"SELECT dataset, column_name, val, {REAL_SQL} AS as_real FROM ({vc_sql(MESSY)})",
)
for _name, _level in (("interpret_datetime", "high"), ("interpret_datetime_mod", "moderate"), ("interpret_datetime_low", "low")):
    register(
        _name,
        lambda s, d, level=_level: _interpret(level)(s, d).select(*_KEEP, F.col("as_ts").cast("string").alias("as_ts")),
        f"SELECT dataset, column_name, val, CAST(as_ts AS VARCHAR) AS as_ts FROM {interpreted_sql(vc_sql(MESSY), _level)}",
    )
register(
    "interpret_text",
    lambda s, d: made_vc(s, d, MESSY).select(*_KEEP, I.interpret_text(F.col("val")).alias("as_text")),
    f"SELECT dataset, column_name, val, CASE WHEN kind = 'text' THEN val END AS as_text FROM {interpreted_sql(vc_sql(MESSY))}",
)


def _mixed_vc(s, d):
    named = {t: load(s, d, t).select(*cols) for t, cols in _TEXT_COLUMNS.items()}
    return cells.value_counts({**named, **tables(s, d, MESSY), "events": load(s, d, "events").select("event_type", "props")})


_MIXED = {**_TEXT, **raw_corpus({"events": ["event_type", "props"]})}
register(
    "mixed_type_counts",
    lambda s, d: generic.mixed_type_counts(_mixed_vc(s, d)),
    "SELECT dataset, column_name, "
    + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE kind = '{k}'), 0) AS BIGINT) AS n_{k}" for k in ("int", "real", "date", "text", "unclassified"))
    + f" FROM {interpreted_sql(vc_sql(_MIXED))} GROUP BY 1, 2",
)

# --- dates ---------------------------------------------------------------------------------------

_DATE_COLUMNS = {"orders": ["o_orderdate"], "events": ["ts"], "lineitem": ["l_shipdate"]}
register(
    "date_range",
    lambda s, d: generic.date_range({**raw(s, d, tuple(_DATE_COLUMNS)), **tables(s, d, SPARSE)}),
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{name}' AS column_name, count({expr}) AS count, CAST(max({expr}) AS VARCHAR) AS max_value, CAST(min({expr}) AS VARCHAR) AS min_value FROM {table}"
        for t, table, name, expr in [(t, t, c, c) for t, cs in _DATE_COLUMNS.items() for c in cs]
        + [("sparse", "orders", "placed", SPARSE["sparse"][1]["placed"])]
    ),
)
register(
    "date_range_text",
    lambda s, d: generic.date_stats(made_vc(s, d, MESSY).unionByName(raw_vc(s, d, ("orders",)))),
    f"""SELECT dataset, column_name, CAST(sum(n) AS BIGINT) AS count, max_by(val, (as_ts, val)) AS max_value, min_by(val, (as_ts, val)) AS min_value FROM (
        SELECT dataset, column_name, val, n, as_ts FROM {interpreted_sql(vc_sql(MESSY))} WHERE kind = 'date'
        UNION ALL SELECT 'orders', 'o_orderdate', CAST(o_orderdate AS VARCHAR), count(*), o_orderdate FROM orders GROUP BY o_orderdate)
    GROUP BY 1, 2""",
)

# --- conventions of a column ----------------------------------------------------------------------
# month and day as each column means them; the values are distinct but for `mostly_day_first`

_SAID = {
    "day_first": "strptime(val, '%d/%m/%Y')", "month_first": "strptime(val, '%m/%d/%Y')",
    "old_years": "try_strptime(substr(val, 1, 6) || '19' || right(val, 2), '%d-%m-%Y')", "no_evidence": "strptime(substr(val, 1, 6) || CASE WHEN right(val, 2) < '69' THEN '20' ELSE '19' END || right(val, 2), '%m/%d/%Y')",
    "mostly_day_first": "CASE WHEN val LIKE '%-%' THEN strptime(val, '%Y-%m-%d') WHEN CAST(substr(val, 4, 2) AS INT) > 12 THEN strptime(substr(val, 1, 10), '%m/%d/%Y') ELSE strptime(substr(val, 1, 10), '%d/%m/%Y') END + CASE WHEN val LIKE '%:%' THEN INTERVAL 630 MINUTE ELSE INTERVAL 0 HOUR END",
}
register(
    "dates_by_column",
    lambda s, d: generic.with_kind(made_vc(s, d, AMBIGUOUS), by_column=True).where("val IS NOT NULL").select("column_name", "val", F.col("as_ts").cast("string").alias("as_ts"), "kind"),
    f"""SELECT *, CASE WHEN as_ts IS NULL THEN 'text' ELSE 'date' END AS kind FROM (
        SELECT column_name, val, CAST(CASE column_name {' '.join(f"WHEN '{c}' THEN {e}" for c, e in _SAID.items())} END AS VARCHAR) AS as_ts FROM ({vc_sql(AMBIGUOUS)}) WHERE val IS NOT NULL)""",
)
_PARTS = "CASE WHEN val LIKE '%-%' AND column_name <> 'old_years' THEN 0 ELSE CAST(substr(val, 1, 2) AS INT) END AS p, CASE WHEN val LIKE '%-%' AND column_name <> 'old_years' THEN 0 ELSE CAST(substr(val, 4, 2) AS INT) END AS q"
register(
    "date_conventions",
    lambda s, d: dates.column_conventions(made_vc(s, d, AMBIGUOUS).where("val IS NOT NULL")).select("column_name", "day_votes", "month_votes", "day_first", "middle_year"),
    f"""SELECT column_name, CAST(coalesce(sum(n) FILTER (p > 12), 0) AS BIGINT) AS day_votes, CAST(coalesce(sum(n) FILTER (q > 12), 0) AS BIGINT) AS month_votes,
    coalesce(sum(n) FILTER (p > 12), 0) > coalesce(sum(n) FILTER (q > 12), 0) AS day_first, CAST(round(sum(n * y) / sum(n) FILTER (y IS NOT NULL)) AS INTEGER) AS middle_year
    FROM (SELECT *, CAST(nullif(regexp_extract(val, '[0-9]{{4}}'), '') AS INT) AS y, {_PARTS} FROM ({vc_sql(AMBIGUOUS)}) WHERE val IS NOT NULL) GROUP BY 1""",
)

# --- the whole profile -----------------------------------------------------------------------------


def _profile_sql(corpus, native) -> str:
    """Flat profile of string columns (`corpus`) and native ones (`native`: column -> type)."""
    top = "SELECT dataset, column_name, string_agg(val, '|' ORDER BY r) AS frequent_values FROM (SELECT *, {0} AS r FROM vc WHERE val IS NOT NULL) WHERE r <= 5 GROUP BY 1, 2".format(
        _RANKED.format("n DESC, val")
    )
    native_list = ", ".join(f"'{c}'" for c in native)
    dates = [c for c, k in native.items() if k == "DATE/TIME"]
    numeric = {c: k for c, k in native.items() if k != "DATE/TIME"}
    number_rows = [
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, '{numeric[c]}' AS type, count({e}) AS count, CAST(max({e}) AS VARCHAR) AS max_value, CAST(min({e}) AS VARCHAR) AS min_value, avg({e}) AS mean, stddev_samp({e}) AS stddev FROM {table}"
        for t, (table, cols) in corpus.items()
        for c, e in cols.items()
        if c in numeric
    ]
    for kind, col, sql_type in (("INTEGER (LONG)", "as_int", "BIGINT"), ("REAL", "as_real", "DOUBLE")):
        number_rows.append(
            f"SELECT dataset, column_name, '{kind}' AS type, count({col}) AS count, CAST(max({col}) AS VARCHAR) AS max_value, CAST(min({col}) AS VARCHAR) AS min_value, avg({col}) AS mean, stddev_samp({col}) AS stddev FROM cells GROUP BY 1, 2 HAVING count({col}) > 0"
        )
    date_native = " UNION ALL ".join(
        f"SELECT '{t}', '{c}', 'DATE/TIME', count({e}), CAST(max({e}) AS VARCHAR), CAST(min({e}) AS VARCHAR) FROM {table}"
        for t, (table, cols) in corpus.items()
        for c, e in cols.items()
        if c in dates
    )
    ranked = lambda order: f"SELECT dataset, column_name, string_agg(val, '|' ORDER BY r) AS v FROM (SELECT *, {_RANKED.format(order)} AS r FROM cells WHERE kind = 'text' AND val <> '') WHERE r <= 5 GROUP BY 1, 2"
    return f"""WITH raw_cells AS MATERIALIZED ({cells_sql(corpus)}),
    vc AS MATERIALIZED (SELECT dataset, column_name, val, count(*) AS n FROM raw_cells GROUP BY 1, 2, 3),
    iv AS MATERIALIZED (SELECT * FROM {interpreted_sql(f"SELECT * FROM vc WHERE column_name NOT IN ({native_list})")}),
    cells AS MATERIALIZED (SELECT r.dataset, r.column_name, r.val, as_int, as_real, as_ts, kind FROM raw_cells r JOIN iv ON r.dataset = iv.dataset AND r.column_name = iv.column_name AND r.val = iv.val),
    counts AS (SELECT dataset, column_name, count(val) AS number_non_empty_cells, count(*) - count(val) AS number_empty_cells, count(DISTINCT val) AS number_distinct_values FROM raw_cells GROUP BY 1, 2),
    frequent AS ({top}),
    numbers AS ({' UNION ALL '.join(number_rows)}),
    dates AS (SELECT dataset, column_name, 'DATE/TIME' AS type, count(*) AS count, max_by(val, (as_ts, val)) AS max_value, min_by(val, (as_ts, val)) AS min_value FROM cells WHERE kind = 'date' GROUP BY 1, 2 {'UNION ALL ' + date_native if date_native else ''}),
    texts AS (SELECT t.dataset, t.column_name, 'TEXT' AS type, count, s.v AS shortest_values, l.v AS longest_values, average_length FROM
        (SELECT dataset, column_name, count(*) AS count, avg(length(val)) FILTER (WHERE val <> '') AS average_length FROM cells WHERE kind = 'text' GROUP BY 1, 2) t
        LEFT JOIN ({ranked('length(val), val')}) s ON t.dataset = s.dataset AND t.column_name = s.column_name
        LEFT JOIN ({ranked('length(val) DESC, val')}) l ON t.dataset = l.dataset AND t.column_name = l.column_name),
    types AS (
        SELECT dataset, column_name, type, count, max_value, min_value, round(mean, 4) AS mean, round(stddev, 4) AS stddev, NULL AS shortest_values, NULL AS longest_values, CAST(NULL AS DOUBLE) AS average_length FROM numbers WHERE count > 0
        UNION ALL SELECT dataset, column_name, type, count, max_value, min_value, NULL, NULL, NULL, NULL, NULL FROM dates WHERE count > 0
        UNION ALL SELECT dataset, column_name, type, count, NULL, NULL, NULL, NULL, shortest_values, longest_values, round(average_length, 4) FROM texts)
    SELECT c.dataset, c.column_name, number_non_empty_cells, number_empty_cells, number_distinct_values,
        number_non_empty_cells = number_distinct_values AS is_key, coalesce(frequent_values, '') AS frequent_values,
        type, count, max_value, min_value, mean, stddev, shortest_values, longest_values, average_length
    FROM counts c LEFT JOIN frequent f ON c.dataset = f.dataset AND c.column_name = f.column_name
    LEFT JOIN types t ON c.dataset = t.dataset AND c.column_name = t.column_name"""


_PROFILED = ("customer", "part", "orders")
_NATIVE = {c: k for c, k in {**_KINDS, "o_orderdate": "DATE/TIME"}.items()}
register(
    "profile_table",
    lambda s, d: P.flatten(P.profile_columns(raw(s, d, _PROFILED))),
    _profile_sql({t: RAW[t] for t in _PROFILED}, _NATIVE),
)
register(
    "mixed_profile",
    lambda s, d: P.flatten(P.profile_columns(tables(s, d, MESSY))),
    _profile_sql(MESSY, {"none": "REAL"}),
)

# --- corpus roll-ups ---------------------------------------------------------------------------------


def _corpus(s, d):
    return P.profile_columns({**raw(s, d, _PROFILED), **tables(s, d, MESSY)})


_CORPUS_SQL = _profile_sql({**{t: RAW[t] for t in _PROFILED}, **MESSY}, _NATIVE)
register(
    "corpus_columns_by_type",
    lambda s, d: evaluate.columns_by_type(_corpus(s, d)),
    f"SELECT type, count(*) AS columns FROM ({_CORPUS_SQL}) GROUP BY type",
)
register(
    "corpus_cells_by_type",
    lambda s, d: evaluate.cells_by_type(_corpus(s, d)),
    f"SELECT type, CAST(sum(count) AS BIGINT) AS cells FROM ({_CORPUS_SQL}) GROUP BY type",
)
register(
    "corpus_completeness",
    lambda s, d: evaluate.completeness(raw_vc(s, d, (*NAMES, "lineitem")).unionByName(made_vc(s, d, SPARSE))),
    f"""SELECT count(*) AS columns, round(avg(a), 4) AS mean_non_empty, round(avg(b), 4) AS mean_empty, round(avg(c), 4) AS mean_distinct
    FROM (SELECT count(val) AS a, count(*) - count(val) AS b, count(DISTINCT val) AS c
    FROM ({cells_sql(BOTH)} UNION ALL {cells_sql(SPARSE)}) GROUP BY dataset, column_name)""",
)
