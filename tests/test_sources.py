import gzip
import json

import pytest
from pyspark.sql import functions as F

from colsight import rules as R
from colsight.operators import evaluate, mining as M
from colsight.sources import readers, writers


def _write(path, text):
    data = text.encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(path)


def test_catalog(spark, tmp_path, rows):
    path = _write(tmp_path / "datasets.tsv", "aa-1\tFirst\nbb-2\tSecond\ncc-3\tThird\ndd-4\t\n")
    catalog = readers.read_catalog(spark, path)
    assert rows(catalog) == [("aa-1",), ("bb-2",), ("cc-3",), ("dd-4",)]
    skip = spark.createDataFrame([("bb-2",)], "dataset string")
    assert rows(readers.select_datasets(catalog, skip)) == [("aa-1",), ("cc-3",), ("dd-4",)]
    assert rows(readers.select_datasets(catalog, skip, offset=1, limit=1)) == [("cc-3",)]


def test_table(spark, tmp_path):
    path = _write(tmp_path / "t.tsv.gz", "id\tname.x\twhen\n1\ta\t2020-01-01 00:00:00\n2\t\t2020-01-02 00:00:00\n")
    df = readers.read_table(spark, path)
    assert [t for _, t in df.dtypes] == ["int", "string", "timestamp"]
    assert df.count() == 2


def test_value_counts(spark, tmp_path, rows):
    _write(tmp_path / "ab-1.City Name.txt.gz", "NEW YORK\t5\nROME\tx\n\"quoted\t2\n")
    _write(tmp_path / "ab-1.zip.txt", "10001\t7\n\t3\nshort\n")
    got = rows(readers.read_value_counts(spark, str(tmp_path)))
    assert got == sorted(
        [("ab-1.City Name", "NEW YORK", 5), ("ab-1.City Name", "ROME", 0), ("ab-1.City Name", '"quoted', 2),
         ("ab-1.zip", "10001", 7), ("ab-1.zip", None, 3), ("ab-1.zip", "short", 0)],
        key=repr,
    )


def test_labelled_column(spark, tmp_path, rows):
    _write(tmp_path / "ab-1.Boro.txt", "borough\nBRONX\t4\nNULL\t2\nQUEENS\t1\n")
    _write(tmp_path / "ab-1.Multi.part.txt", "city,borough\nROME\t3\n")
    labelled = readers.read_labelled_column(spark, str(tmp_path))
    assert rows(evaluate.labelled_weight(labelled)) == [
        ("ab-1.Boro", "borough", 5), ("ab-1.Multi.part", "borough", 3), ("ab-1.Multi.part", "city", 3),
    ]


def test_keywords_and_names(spark, tmp_path, rows):
    path = _write(tmp_path / "k", '"NEW YORK","DOB","A, ""B""", OLLIE\'S ,plain\n')
    assert set(rows(readers.read_keywords(spark, path, "a"))) == {("a", t) for t in ('A, "B"', "DOB", "NEW YORK", "OLLIE'S", "plain")}
    old = _write(tmp_path / "old", '"NEW YORK","DOB","[\'X\']"\n')
    assert rows(readers.read_keywords(spark, old, "a", strict=False)) == [("a", "DOB"), ("a", "NEWYORK"), ("a", "X")]
    names = _write(tmp_path / "n", "['aa-1.X.txt.gz', 'bb-2.Y.txt.gz']")
    assert rows(readers.read_name_list(spark, names)) == [("aa-1.X.txt.gz",), ("bb-2.Y.txt.gz",)]


def test_labels(spark, tmp_path, rows):
    path = _write(tmp_path / "l.tsv", "aa-1.X.txt.gz\t['city', 'borough']\nbb-2.Y.txt.gz\t['zip']\n")
    assert rows(readers.read_labels(spark, path)) == [("aa-1.X", ["city", "borough"]), ("bb-2.Y", ["zip"])]


def test_link_acronyms(spark, rows):
    html = '<a href="x">Parks, Department of (DPR)</a><a>None here</a><A class=k><b>City  Clerk</b> (CC)</A><abbr>No (NO)</abbr>'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(readers.link_acronyms(pages)) == [(1, "City Clerk", "CC"), (1, "Parks, Department of", "DPR")]


FOUND = "array<struct<semantic_type: string, label: string, count: bigint>>"


def test_json_and_csv_sinks(spark, tmp_path, rows):
    one = spark.sql(
        f"SELECT 'a.b' AS column_name, CAST(array(struct('city', '', 5L)) AS {FOUND}) AS semantic_type, 5L AS count"
    )
    writers.write_semantic_json(one, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["semantic_type"][0]["semantic_type"] == "city"
    writers.write_semantic_document(one, str(tmp_path / "d"), documents=1)
    text = [r["value"] for r in spark.read.text(str(tmp_path / "d")).collect()]
    assert [e["column_name"] for e in json.loads(text[0])["predicted_types"]] == ["a.b"]
    predictions = spark.sql("SELECT 'a.b' AS column_id, array('x', 'y') AS types")
    writers.write_predictions(predictions, str(tmp_path / "p"))
    assert rows(spark.read.csv(str(tmp_path / "p"), header=True)) == [("a.b", "x|y")]
    report = spark.sql("SELECT 'a.b' AS column_id, 0.5D AS x_share")
    writers.write_report(report, str(tmp_path / "r"))
    assert rows(spark.read.csv(str(tmp_path / "r"), header=True, inferSchema=True)) == [("a.b", 0.5)]
    edges = spark.sql("SELECT 'a' AS a, 'b' AS b, 0.5D AS score")
    writers.write_edges(edges, str(tmp_path / "e"))
    assert rows(spark.read.csv(str(tmp_path / "e"), header=True, inferSchema=True)) == [("a", "b", 0.5)]


def test_list_and_cluster_sinks(spark, tmp_path, rows):
    terms = spark.createDataFrame([("a", "NEW YORK"), ("a", "DOB"), ("b", "X")], "semantic_type string, term string")
    writers.write_terms(terms, str(tmp_path / "t"), by="semantic_type")
    assert rows(readers.read_keywords(spark, str(tmp_path / "t" / "semantic_type=a"), "a")) == [("a", "DOB"), ("a", "NEW YORK")]
    writers.write_term_line(terms.select("term"), str(tmp_path / "all"))
    assert spark.read.text(str(tmp_path / "all")).first()["value"] == '"DOB","NEW YORK","X"'
    clusters = spark.createDataFrame([("x", "k"), ("y", "k")], "item string, cluster_id string")
    writers.write_clusters(clusters, str(tmp_path / "c"), parts=1)
    assert spark.read.json(str(tmp_path / "c")).first()["items"] == ["x", "y"]
    large = spark.range(500).selectExpr("CAST(id AS STRING) AS item", "'k' AS cluster_id")
    writers.write_clusters(large, str(tmp_path / "large"), parts=5)
    parts = [r["items"] for r in spark.read.json(str(tmp_path / "large")).collect()]
    assert 1 < len(parts) <= 5 and sorted(i for p in parts for i in p) == sorted(str(i) for i in range(500))
    weights = spark.createDataFrame([("a.b", "house_number", 3), ("a.c", "city", 4)], "column_id string, label string, weight bigint")
    writers.write_label_json(weights, str(tmp_path / "l"))
    back = {r["column_name"]: r["semantic_type"][0] for r in spark.read.json(str(tmp_path / "l")).collect()}
    assert (back["a.b"]["label"], back["a.b"]["semantic_type"], back["a.c"]["semantic_type"]) == ("house_number", "", "city")


def test_cluster_rows(spark, tmp_path, rows):
    clusters = spark.range(500, numPartitions=4).selectExpr("CAST(id AS STRING) AS item", "'k' AS cluster_id")
    writers.write_cluster_rows(clusters, str(tmp_path / "c"))
    back = spark.read.json(str(tmp_path / "c"))
    assert rows(back.select("cluster_id", "item")) == rows(clusters.select("cluster_id", "item"))
    assert len(back.inputFiles()) == 4  # as the clusters lay: one cluster, four tasks


def test_regex_round_trip(spark, tmp_path):
    terms = spark.createDataFrame([("a", "C/S"), ("a", "P.E."), ("a", "(X)"), ("a", "")], "semantic_type string, term string")
    patterns = M.keyword_regex(terms)
    writers.write_regex(patterns, str(tmp_path / "r"))
    pattern = readers.read_regex(spark, str(tmp_path / "r" / "semantic_type=a"))
    values = spark.createDataFrame([("A C/S",), ("A PXE.",), ("B (X)",), ("none",)], "v string")
    assert {r["v"] for r in values.where(F.col("v").rlike(pattern)).collect()} == {"A C/S", "B (X)"}


def test_mined_words(spark, rows):
    vc = spark.createDataFrame(
        [("p.a", "Hill Park", 9), ("p.a", "Park of the School", 1), ("p.b", "POOL-SIDE, pool", 1), ("n.a", "St James", 4)],
        "column_id string, val string, count bigint",
    )
    types = spark.createDataFrame(
        [("p.a", "park_playground"), ("p.b", "park_playground"), ("n.a", "neighborhood"), ("q.a", "other")],
        "column_id string, semantic_type string",
    )
    got = rows(M.mine_keywords(vc, types))
    assert got == [
        ("neighborhood", "JAMES"), ("park_playground", "HILL"), ("park_playground", "PARK"),
        ("park_playground", "POOL"), ("park_playground", "POOL-SIDE"),
    ]
    top = [(r["word"], r["count"]) for r in M.top_words(vc.where("column_id = 'p.a'"), 1).collect()]
    assert top == [("park", 2)]
    assert M.top_words(vc.where("column_id = 'p.a'"), 1, weighted=True).first()["count"] == 10


def test_itemsets(spark):
    baskets = M.word_baskets(spark.createDataFrame([("a b",), ("b  a",), ("a",), ("c a b",), ("",)], "val string"))
    sets = {tuple(r["items"]): r["freq"] for r in M.frequent_itemsets(baskets, 0.5).collect()}
    assert sets == {("a",): 4, ("b",): 3, ("a", "b"): 3}
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"] for r in M.association_rules(baskets, 0.5, 0.8).collect()}
    assert rules == {(("b",), ("a",)): 1.0}


def test_precision_and_recall(spark):
    labels = spark.createDataFrame(
        [("a", ["zip"]), ("b", ["city", "borough"]), ("c", ["color"]), ("d", ["city"])], "column_id string, labels array<string>"
    )
    found = spark.createDataFrame(
        [("a", ["zip_code"]), ("b", ["city"]), ("c", ["city"]), ("d", []), ("unlabelled", ["city"])],
        "column_id string, types array<string>",
    )
    scores = evaluate.precision_recall(found, labels, R.LABEL_ALIASES)
    got = {r["label"]: (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in scores.collect()}
    assert got == {"zip_code": (1, 0, 0, 1.0, 1.0), "city": (1, 1, 1, 0.5, 0.5), "borough": (0, 0, 1, None, 0.0), "color": (0, 0, 1, None, 0.0)}
    summary = evaluate.eval_summary(found, scores).first()
    assert (summary["columns"], summary["typed"], summary["precision"]) == (5, 4, round(2 / 3, 4))


def test_shared_folder_comes_from_the_session(spark):
    from colsight.session import shared_folder

    named = spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir')}/_colsight"
    assert shared_folder(spark) == named


def test_staged_copies_are_removed_by_their_owner(spark, monkeypatch):
    from colsight.plans import staging

    monkeypatch.setattr(staging, "_MADE", [])
    copy = staging.stage(spark.range(5).toDF("item"))
    (_, path), = staging._MADE
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert copy.count() == 5 and files.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    staging.release()
    assert not files.exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def test_dropped_copies_go_at_once(spark, monkeypatch):
    from colsight.plans import staging

    monkeypatch.setattr(staging, "_MADE", [])
    before = spark.conf.get(staging.CLEANUP)
    kept, gone = staging.stage(spark.range(3)), staging.stage(spark.range(2))
    (_, there), (_, away) = staging._MADE
    staging.drop(gone)
    files = spark._jvm.org.apache.hadoop.fs.Path(away).getFileSystem(spark._jsc.hadoopConfiguration())
    assert [path for _, path in staging._MADE] == [there]
    assert kept.count() == 3 and not files.exists(spark._jvm.org.apache.hadoop.fs.Path(away))
    assert spark.conf.get(staging.CLEANUP) == before
    staging.release()
