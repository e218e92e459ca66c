"""Columns the queries work on, derived from the test tables.

The tables hold no phone numbers, colours or boroughs, so such columns are computed from
their keys, one value per row of a whole table. The expressions are written in the SQL
both engines share and are used as they stand on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colsight.operators import cells
from colsight.sources.readers import read_table


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def pick(key: str, values: list[str]) -> str:
    """One of `values` by key; a value listed twice comes twice as often."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {key} % {len(values)} {whens} ELSE '{values[-1]}' END"


def digits(key: str, n: int) -> str:
    return f"lpad(CAST({key} AS STRING), {n}, '0')"


def text(key: str) -> str:
    return f"CAST({key} AS STRING)"


# dataset -> (table, {column: expression})
SEMANTIC: dict[str, tuple[str, dict[str, str]]] = {
    "people": (
        "customer",
        {
            "zip": f"CASE WHEN c_custkey % 20 = 0 THEN 'unknown' WHEN c_custkey % 20 = 1 THEN {digits('c_custkey % 90000', 5)} || '-' || {digits('c_custkey % 900', 3)} ELSE {digits('c_custkey % 90000', 5)} END",
            "zip_half": f"CASE WHEN c_custkey % 2 = 0 THEN 'n/a' ELSE {digits('c_custkey % 90000', 5)} END",
            "phone": f"CASE c_custkey % 3 WHEN 0 THEN '212555' || {digits('c_custkey % 10000', 4)} WHEN 1 THEN '(212)555' || {digits('c_custkey % 10000', 4)} ELSE '212-555-' || {digits('c_custkey % 10000', 4)} END",
            "phone_spaced": f"'212 555 ' || {digits('c_custkey % 10000', 4)}",
            "location": f"'(40.' || {text('c_custkey % 1000')} || ', -73.' || {text('c_nationkey')} || ')'",
            "address": f"{text('c_custkey')} || ' NORTH MAIN STREET'",
            "street": pick("c_custkey", ["OAK ST", "ELM AVE", "HIGH ROAD", "MAIN ST", "PARK PLACE", "BROADWAY"]),
            "MI": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE chr(CAST(65 + c_custkey % 26 AS INT)) END",
            "few_letters": "chr(CAST(65 + c_custkey % 20 AS INT))",
            "borough": pick("c_custkey", ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "BRONX", "OTHER"]),
            "borough_code": pick("c_custkey", ["K", "M", "Q", "R", "X"]),
            "boroughs_four": pick("c_custkey", ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "ALBANY"]),
            "segment": "c_mktsegment",
        },
    ),
    "vehicles": (
        "lineitem",
        {
            "Vehicle_Color": pick("l_orderkey", ["WHITE", "WHTE", "BLACK", "BK", "GREY", "GRAY", "BLUE", "RED", "SILVER", "GREEN", "TAN", "GOLD", "BLK", "7", ""]),
            "rare_color": pick("l_orderkey", ["RED", "TABLE", "CHAIR", "LAMP", "DOOR", "DESK", "WALL", "ROOF"]),
            "Vehicle_Make": pick("l_partkey", ["FORD", "TOYOT", "HONDA", "NISSA", "CHEVR", "DODGE", "BMW", "VOLVO", "KIA"]),
            "maker": pick("l_partkey", ["FORD", "TOYOT", "HONDA", "NISSA", "CHEVR", "DODGE", "BMW", "VOLVO", "KIA"]),
            "Vehicle_Model": pick("l_partkey", ["FORD EXPLORER", "TOYOTA CAMRY", "HONDA ACCORD", "NISSAN ALTIMA", "CHEVROLET IMPALA", "DODGE CHARGER"]),
        },
    ),
    "schools": (
        "part",
        {
            "building_class": "chr(CAST(65 + p_partkey % 26 AS INT)) || CAST(p_partkey % 10 AS STRING) || '-X'",
            "school": f"'P.S ' || {text('p_partkey % 300')} || ' ' || upper(p_name)",
            "academy": f"CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ACADEMY' ELSE upper(p_name) END",
            "subject": pick("p_partkey", ["ENGLISH", "MATH A", "US GOVERNMENT", "US HISTORY", "CHEMISTRY", "GLOBAL HISTORY 2", "LUNCH", "STUDY HALL"]),
            "level": pick("p_partkey", ["K-8", "HIGH SCHOOL", "MIDDLE SCHOOL", "K-12", "YABC", "ELEMENTARY", "K-5"]),
            "interest3": pick("p_partkey", ["ANIMAL", "LAW", "HEALTH", "Zoned", "Trades", "Music", "ENGINEERING", "Dance"]),
            "subject_words": pick("p_partkey", ["GEOMETRY", "EARTH", "Reading", "Writing", "TEACHING"]),
        },
    ),
    "places": (
        "orders",
        {
            "house_number": "CAST(10 + o_orderkey % 9900 AS STRING)",
            "agency": pick("o_orderkey", ["DOB", "DOI", "NYPL", "Mayor", "Council", "HEALTH", "Clerk", "Press"]),
            "neighborhood": pick("o_orderkey", ["ASTORIA", "HARLEM", "Albany", "Utica", "FLUSHING", "Troy", "Ithaca", "Rome", "Elmira", "Olean", "MIDWOOD"]),
            "premise": pick("o_orderkey", ["HOUSE", "STREET", "BUS", "ship", "RESTAURANT/DINER", "plane", "van", "cab", "bike", "car", "tram"]),
            "park": pick("o_orderkey", ["PARK", "POOL", "lake", "river", "hill", "sea", "bay", "cove", "inlet", "pond", "creek"]),
            "business": pick("o_orderkey", ["DELI", "PIZZA", "shop", "kiosk", "stand", "cart", "truck", "van", "bank", "inn", "pub"]),
            "ten_percent": pick("o_orderkey", ["DELI", "b", "c", "d", "e", "f", "g", "h", "i", "j"]),
            "priority": "o_orderpriority",
        },
    ),
    "names": (
        "supplier",
        {
            "hometown city ": "CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE 'NATION_' || CAST(s_nationkey AS STRING) END",
            "town": "CASE WHEN s_suppkey % 5 = 0 THEN 'Customer#' || lpad(CAST(s_suppkey AS STRING), 9, '0') ELSE 'NATION_' || CAST(s_nationkey AS STRING) END",
            "last_name": "CASE WHEN s_suppkey % 5 = 0 THEN 'NATION_' || CAST(s_nationkey AS STRING) ELSE 'Customer#' || lpad(CAST(s_suppkey AS STRING), 9, '0') END",
            "contact": "CASE s_suppkey % 5 WHEN 0 THEN 'NATION_' || CAST(s_nationkey AS STRING) WHEN 1 THEN s_name ELSE 'Customer#' || lpad(CAST(s_suppkey AS STRING), 9, '0') END",
            "only_people": "'Customer#' || lpad(CAST(s_suppkey AS STRING), 9, '0')",
            "first_city name ": "CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN 'Customer#' || lpad(CAST(s_suppkey AS STRING), 9, '0') ELSE 'NATION_' || CAST(s_nationkey AS STRING) END",
        },
    ),
    "web": ("pages", {"url": "url", "URL_UPPER": "upper(url)"}),
}

# messy string columns for the per-value interpretation
_DAY = "substr(CAST(o_orderdate AS STRING), 1, 10)"
MESSY: dict[str, tuple[str, dict[str, str]]] = {
    "messy": (
        "orders",
        {
            "mixed": "CASE o_orderkey % 13 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' WHEN 2 THEN CAST(o_custkey % 100 AS STRING) || '.5' WHEN 3 THEN '+' || CAST(o_custkey AS STRING) WHEN 4 THEN '1e5' WHEN 5 THEN 'nan' WHEN 6 THEN '1_000' WHEN 7 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 8 THEN '12 MAIN ST' WHEN 9 THEN 'a:b' WHEN 10 THEN '' WHEN 11 THEN NULL ELSE '-' || CAST(o_custkey % 7 AS STRING) || '.25' END",
            "when": "CASE o_orderkey % 12 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 6, 2) || '/' || substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4) WHEN 2 THEN substr(CAST(o_orderdate AS STRING), 9, 2) || ' Feb ' || substr(CAST(o_orderdate AS STRING), 1, 4) WHEN 3 THEN 'Mar ' || substr(CAST(o_orderdate AS STRING), 9, 2) || ', ' || substr(CAST(o_orderdate AS STRING), 1, 4) || ' 10:30 PM' WHEN 4 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T12:15:01Z' WHEN 5 THEN 'Feb-15' WHEN 6 THEN substr(CAST(o_orderdate AS STRING), 1, 7) WHEN 7 THEN substr(CAST(o_orderdate AS STRING), 6, 2) || '-' || substr(CAST(o_orderdate AS STRING), 9, 2) || '-' || substr(CAST(o_orderdate AS STRING), 3, 2) WHEN 8 THEN '2015-02-30' WHEN 9 THEN '12:0' || CAST(o_orderkey % 10 AS STRING) WHEN 10 THEN 'no date' ELSE substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 6, 2) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4) END",
            "zoned": f"CASE o_orderkey % 6 WHEN 0 THEN {_DAY} || 'T12:15:01+00:00' WHEN 1 THEN {_DAY} || 'T12:15:01.1234567Z' WHEN 2 THEN {_DAY} || ' 12:15:01.123456789' WHEN 3 THEN {_DAY} || 'T01:15:01-0530' WHEN 4 THEN 'Wednesday.,  September - 12th - ' || substr({_DAY}, 1, 4) || '  ,  12:34:56.123456 a.m. utc' ELSE {_DAY} || ' 11:59 pm+01' END",
            "spelled": f"CASE o_orderkey % 6 WHEN 0 THEN 'Thu Sep ' || substr({_DAY}, 9, 2) || ' 10:36:28 ' || substr({_DAY}, 1, 4) WHEN 1 THEN {_DAY} || ' 12:15:01 EST' WHEN 2 THEN replace({_DAY}, '-', '') || 'T121501' WHEN 3 THEN 'May 5th, ' || substr({_DAY}, 1, 4) || ' at 5pm' WHEN 4 THEN '3rd of May ' || substr({_DAY}, 1, 4) ELSE {_DAY} || ' 12h15m' END",
            "plain": "o_orderpriority",
            "odd.name `x`": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
            "whole": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING) || '.0' ELSE CAST(o_totalprice AS STRING) END",
        },
    ),
}

# empty cells and odd names on native types
SPARSE: dict[str, tuple[str, dict[str, str]]] = {
    "sparse": (
        "orders",
        {
            "id": "o_orderkey",
            "id_or_null": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END",
            "one_null": "CASE WHEN o_orderkey = 7 THEN NULL ELSE o_orderkey END",
            "status.code": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderstatus END",
            "is big": "o_totalprice > 250000",
            "price": "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_totalprice END",
            "placed": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_orderdate END",
            "never": "CASE WHEN o_orderkey < 0 THEN o_orderkey END",
        },
    ),
}

# dates whose order and century only their column tells: D, M, Y of the order date
_D, _M, _Y = f"substr({_DAY}, 9, 2)", f"substr({_DAY}, 6, 2)", f"substr({_DAY}, 1, 4)"
_OLD = f"CAST(CAST({_Y} AS INT) - 50 AS STRING)"
AMBIGUOUS: dict[str, tuple[str, dict[str, str]]] = {
    "dated": (
        "orders",
        {
            "day_first": f"{_D} || '/' || {_M} || '/' || {_Y}",
            "month_first": f"{_M} || '/' || {_D} || '/' || {_Y}",
            "old_years": f"{_D} || '-' || {_M} || '-' || CASE WHEN o_orderkey % 4 = 0 THEN {_OLD} ELSE substr({_OLD}, 3, 2) END",
            "no_evidence": f"CASE WHEN CAST({_D} AS INT) <= 12 THEN {_D} || '/' || {_M} || '/' || substr({_Y}, 3, 2) END",
            "mostly_day_first": f"CASE o_orderkey % 5 WHEN 0 THEN {_M} || '/' || {_D} || '/' || {_Y} WHEN 1 THEN {_DAY} ELSE {_D} || '/' || {_M} || '/' || {_Y} || ' 10:30' END",
        },
    ),
}

Corpus = dict[str, tuple[str, dict[str, str]]]


def tables(spark: SparkSession, sf_dir: str, corpus: Corpus, only: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    return {
        dataset: load(spark, sf_dir, table).selectExpr(*[f"{expr} AS `{name.replace('`', '``')}`" for name, expr in columns.items()])
        for dataset, (table, columns) in corpus.items()
        if only is None or dataset in only
    }


def raw(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def semantic_values(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None) -> DataFrame:
    return cells.column_values(cells.value_counts(tables(spark, sf_dir, SEMANTIC, only)))


# --- the same in DuckDB -------------------------------------------------------------------


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def cells_sql(corpus: Corpus, only: tuple[str, ...] | None = None) -> str:
    """SELECT dataset, column_name, val for every cell."""
    return " UNION ALL ".join(
        f"SELECT {lit(dataset)} AS dataset, {lit(name)} AS column_name, CAST({expr} AS VARCHAR) AS val FROM {table}"
        for dataset, (table, columns) in corpus.items()
        if only is None or dataset in only
        for name, expr in columns.items()
    )


def raw_corpus(columns: dict[str, list[str]]) -> Corpus:
    """Tables as they are, in the same layout."""
    return {table: (table, {c: c for c in names}) for table, names in columns.items()}


def vc_sql(corpus: Corpus, only: tuple[str, ...] | None = None) -> str:
    """CTE body: dataset, column_name, val, n."""
    return f"SELECT dataset, column_name, val, count(*) AS n FROM ({cells_sql(corpus, only)}) GROUP BY 1, 2, 3"


def values_sql(corpus: Corpus = SEMANTIC, only: tuple[str, ...] | None = None) -> str:
    """CTE body: column_id, val, n."""
    return f"SELECT dataset || '.' || column_name AS column_id, val, n FROM ({vc_sql(corpus, only)})"


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = query
    if oracle is not None:
        ORACLES[name] = oracle
