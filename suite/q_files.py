"""Files written and read back: value counts, hand labels, term lists, and every sink.

Names and terms hold what file names and CSV stumble over: plus, percent, blanks, quotes, commas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from colsight import rules as R
from colsight.operators import components as K, evaluate, mining as M
from colsight.plans import classify as C
from colsight.plans.staging import scratch_folder
from colsight.sources import readers, writers
from suite.corpus import load, register, semantic_values
from suite.q_semantic import _HIT_ROWS, _TYPES, CASCADE, SHARE_NAMES, VC, report
from suite.q_text import _CLUSTER_SQL, _NAME_BAG, _clusters, _feeds, _mine_sql, _name_edges, _pairs_sql


def folder(spark: SparkSession) -> str:
    return scratch_folder(spark, "files")


def named_files(lines: DataFrame, names: list[str]) -> str:
    """A folder with one text file per name from `lines(file, place, value)`, in order of `place`."""
    spark, root = lines.sparkSession, folder(lines.sparkSession)
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("file")).alias("n")
    rows = lines.select(number, "place", "value").repartition("n").sortWithinPartitions("n", "place")
    rows.select("n", "value").write.partitionBy("n").text(f"{root}/parts")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{root}/named"))
    for i, name in enumerate(names, 1):
        for part in fs.globStatus(path(f"{root}/parts/n={i}/part-*")):
            fs.rename(part.getPath(), path(path(f"{root}/named"), name))
    return f"{root}/named"


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def table_folders(lines: DataFrame, names: list[str]) -> str:
    """A folder with a folder per name from `lines(file, place, value)`: the line of place 0 is its first part, the
    others are written where they lie, by a writer for each name, so that no task holds or sorts a table."""
    spark, root = lines.sparkSession, folder(lines.sparkSession)
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("file")).alias("n")
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(len(names)))
    try:
        lines.where("place <> '0'").select(number, "value").write.partitionBy("n").text(f"{root}/parts")
        lines.where("place = '0'").select(number, "value").write.partitionBy("n").text(f"{root}/heads")
    finally:
        spark.conf.set(WRITERS, before)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, name in enumerate(names, 1):
        table = path(path(f"{root}/named"), name)
        fs.mkdirs(table)
        for part in fs.globStatus(path(f"{root}/parts/n={i}/part-*")):
            fs.rename(part.getPath(), path(table, part.getPath().getName()))
        for head in fs.globStatus(path(f"{root}/heads/n={i}/part-*")):
            fs.rename(head.getPath(), path(table, "part-0"))
    return f"{root}/named"


# --- value counts ----------------------------------------------------------------------------------

_COUNTED = {"ab.a+b": ("customer", "c_mktsegment"), "ab.a b": ("orders", "o_orderpriority"), "ab.100% rate": ("part", "p_brand"), "ab.it's, \"x\"": ("part", "p_type")}


def _value_count_files(s, d):
    lines = None
    for name, (table, column) in _COUNTED.items():
        counts = load(s, d, table).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        part = counts.select(F.lit(f"{name}.txt").alias("file"), F.col("v").alias("place"), F.concat_ws("\t", "v", F.col("n").cast("string")).alias("value"))
        lines = part if lines is None else lines.unionByName(part)
    return readers.read_value_counts(s, named_files(lines, [f"{n}.txt" for n in _COUNTED]))


register(
    "value_count_files",
    _value_count_files,
    " UNION ALL ".join(
        "SELECT '{}' AS column_id, {} AS val, count(*) AS count FROM {} GROUP BY 2".format(name.replace("'", "''"), column, table) for name, (table, column) in _COUNTED.items()
    ),
)

# --- hand labels -------------------------------------------------------------------------------------

# two names that agree up to their second point, a first row without a count, several labels
_LABELLED = {"ab.Vehicle.Make": ("car_make", "c_mktsegment", "customer"), "ab.Vehicle.Model": ("car_model", "o_orderpriority", "orders"), "ab.a+b": ("city, borough,neighborhood", "p_type", "part")}


def _labelled(s, d):
    lines = None
    for name, (label, column, table) in _LABELLED.items():
        counts = load(s, d, table).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        rows = counts.select(F.col("v").alias("place"), F.concat_ws("\t", "v", F.col("n").cast("string")).alias("value"))
        extra = s.sql(f"SELECT * FROM VALUES ('', '{label}'), ('~1', 'AAA no count'), ('~2', 'NULL\\t7') AS t(place, value)")
        part = rows.unionByName(extra).withColumn("file", F.lit(f"{name}.txt"))
        lines = part if lines is None else lines.unionByName(part)
    return readers.read_labelled_column(s, named_files(lines, [f"{n}.txt" for n in _LABELLED]))


_LABELLED_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS column_id, unnest({[x.strip() for x in label.split(',')]}) AS label, val, count FROM (
        SELECT {column} AS val, count(*) AS count FROM {table} GROUP BY 1 UNION ALL SELECT 'AAA no count', 0 UNION ALL SELECT 'NULL', 7)"""
    for name, (label, column, table) in _LABELLED.items()
)
register(
    "labelled_column",
    lambda s, d: _labelled(s, d).select("column_id", F.explode("labels").alias("label"), "val", "count"),
    f"SELECT column_id, label, val, CAST(count AS BIGINT) AS count FROM ({_LABELLED_SQL})",
)
_WEIGHT_SQL = f"SELECT column_id, label, CAST(sum(count) FILTER (WHERE val <> 'NULL') AS BIGINT) AS weight FROM ({_LABELLED_SQL}) GROUP BY 1, 2"
register("labelled_weight", lambda s, d: evaluate.labelled_weight(_labelled(s, d)), _WEIGHT_SQL)


def _score_labelled(s, d):
    """Labels read from files, scored against a guess that is right for one of the three."""
    labels = _labelled(s, d).select("column_id", "labels").distinct()
    return evaluate.precision_recall(labels.select("column_id", F.array(F.lit("car_make")).alias("types")), labels)


register(
    "labelled_score",
    _score_labelled,
    """SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST("precision" AS DOUBLE) AS "precision", CAST(recall AS DOUBLE) AS recall
    FROM (VALUES ('car_make', 1, 2, 0, 0.3333, 1.0), ('car_model', 0, 0, 1, NULL, 0.0), ('city', 0, 0, 1, NULL, 0.0), ('borough', 0, 0, 1, NULL, 0.0),
    ('neighborhood', 0, 0, 1, NULL, 0.0)) t(label, tp, fp, fn, "precision", recall) WHERE EXISTS (SELECT 1 FROM customer)""",
)


def _label_json(s, d):
    path = folder(s)
    writers.write_label_json(evaluate.labelled_weight(_labelled(s, d)).where("label <> 'city'"), path)
    back = s.read.schema("column_name string, semantic_type array<struct<semantic_type: string, label: string, count: bigint>>").json(path)
    return back.select("column_name", F.inline("semantic_type"))


register("label_json", _label_json, f"SELECT column_id AS column_name, label AS semantic_type, '' AS label, weight AS count FROM ({_WEIGHT_SQL}) WHERE label <> 'city'")

# --- term lists ----------------------------------------------------------------------------------------

_TERM = "CASE p_partkey % 4 WHEN 0 THEN p_name || '''S' WHEN 1 THEN upper(p_name) || ', ' || p_brand WHEN 2 THEN CAST(p_size AS STRING) || '\" PIPE ' || p_name ELSE '[' || p_brand || ']' END"
_PART_TERMS = f"SELECT DISTINCT p_mfgr AS semantic_type, {_TERM} AS term FROM part".replace("p_mfgr", "substr(p_brand, 1, 7)")


def _terms(s, d):
    return load(s, d, "part").selectExpr("substr(p_brand, 1, 7) AS semantic_type", f"{_TERM} AS term".replace("'''S'", "'\\'S'")).distinct()


def _term_files(s, d):
    path = folder(s)
    writers.write_terms(_terms(s, d), path, by="semantic_type")
    lines = s.read.option("basePath", path).text(path)
    return readers.parse_terms(lines)


register("term_files", _term_files, f"SELECT term FROM ({_PART_TERMS})")


def _term_line(s, d):
    """Mined keywords are bounded, so each list may be one line."""
    path = folder(s)
    writers.write_term_line(M.mine_keywords(semantic_values(s, d), _feeds(s)), path, by="semantic_type")
    return readers.parse_terms(s.read.text(path).select("value"))


register("term_line", _term_line, f"SELECT term FROM ({_mine_sql(False)})")


def _regex_file(s, d):
    path = folder(s)
    writers.write_regex(M.keyword_regex(M.mine_keywords(semantic_values(s, d), _feeds(s))), path)
    return s.read.option("basePath", path).text(path).select("semantic_type", F.col("value").alias("pattern"))


_REGEX_SQL = f"""SELECT semantic_type, string_agg('\\s' || regexp_replace(term, '([.\\\\+*?\\[\\](){{}}^$|/\\-])', '\\\\\\1', 'g'), '|' ORDER BY term) AS pattern
    FROM ({_mine_sql(False)}) GROUP BY 1"""
register("regex_file", _regex_file, _REGEX_SQL)
register("keyword_regex", lambda s, d: M.keyword_regex(M.mine_keywords(semantic_values(s, d), _feeds(s))), _REGEX_SQL)

# --- reports -------------------------------------------------------------------------------------------


def _semantic_document(s, d):
    path = folder(s)
    writers.write_semantic_document(C.semantic_json(report(s, d)), path, documents=4)
    found = "struct<semantic_type: string, label: string, count: bigint>"
    back = s.read.schema(f"predicted_types array<struct<column_name: string, semantic_type: array<{found}>, count: bigint>>").json(path)
    return back.select(F.inline("predicted_types")).select(F.col("column_name").alias("column_id"), F.inline("semantic_type"))


register("semantic_document", _semantic_document, f"WITH {CASCADE} {_HIT_ROWS}")


def _semantic_rows(s, d):
    path = folder(s)
    writers.write_semantic_json(C.semantic_json(report(s, d)), path)
    back = s.read.schema("column_name string, semantic_type array<struct<semantic_type: string, label: string, count: bigint>>, count bigint").json(path)
    return back.select(F.col("column_name").alias("column_id"), F.inline("semantic_type"))


register("semantic_rows", _semantic_rows, f"WITH {CASCADE} {_HIT_ROWS}")


def _predictions_csv(s, d):
    path = folder(s)
    writers.write_predictions(C.predictions(report(s, d)), path)
    return s.read.schema("filename string, pred string").csv(path, header=True).na.fill("")


register("predictions_csv", _predictions_csv, f"WITH {CASCADE} SELECT column_id AS filename, coalesce({_TYPES}, '') AS pred FROM rep")


def _report_csv(s, d):
    path, rows = folder(s), C.share_report(report(s, d), semantic_values(s, d))
    writers.write_report(rows, path)
    back = s.read.schema(rows.schema).csv(path, header=True)
    return back.select("column_id", "count_all", "types_count", *[F.round(f"{n}_share", 6).alias(f"{n}_share") for n in SHARE_NAMES])


register(
    "report_csv",
    _report_csv,
    f"WITH {CASCADE} SELECT column_id, count_all, types_count, {', '.join(f'round({n}_share, 6) AS {n}_share' for n in SHARE_NAMES)} FROM rep",
)

# --- similar names ---------------------------------------------------------------------------------------


def _edges_csv(s, d):
    path = folder(s)
    writers.write_edges(_name_edges(s, d), path)
    back = s.read.schema("a string, b string, score double").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return back.select("a", "b", F.round("score", 6).alias("score"))


register("edges_csv", _edges_csv, f"WITH {_pairs_sql(_NAME_BAG, 'cosine', 0.8)} SELECT a, b, round(score, 6) AS score FROM edges")


def _cluster_json(s, d):
    path = folder(s)
    writers.write_clusters(_clusters(s, d), path, parts=3)
    back = s.read.schema("cluster_id string, part bigint, items array<string>").json(path)
    items = F.array_join(F.array_sort(F.flatten(F.collect_list("items"))), "|")
    return back.groupBy("cluster_id").agg(F.count(F.lit(1)).between(1, 3).alias("in_parts"), items.alias("items"))


register("cluster_json", _cluster_json, f"{_CLUSTER_SQL} SELECT cluster_id, true AS in_parts, string_agg(item, '|' ORDER BY item) AS items FROM clusters GROUP BY 1")
