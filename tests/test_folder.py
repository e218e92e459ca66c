"""Folders of tables with different headers."""

import random

import pytest

from colsight.functions.text import ascii_escaped
from colsight.plans import profile as P
from colsight.plans.staging import release
from colsight.sources import corpus as C, readers
from pyspark.sql import functions as F


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def made_folder(folder, n, rows=12):
    """n files: 2 to 6 columns each, names of their own, one column of each type somewhere."""
    rnd = random.Random(3)
    kinds = [
        lambda i: str(rnd.randint(-5, 50)), lambda i: f"{rnd.random():.3f}", lambda i: f"2015-02-{rnd.randint(1, 28):02d}",
        lambda i: f"2015-02-03 1{rnd.randint(0, 9)}:00:00", lambda i: rnd.choice(["true", "FALSE"]), lambda i: rnd.choice(["a b", "12", "x"]), lambda i: "",
        lambda i: rnd.choice(["3", "4.5"]), lambda i: rnd.choice(["2015-02-03", "2015-02-03 10:00:00"]), lambda i: rnd.choice(["", "7"]),
    ]
    for t in range(n):
        makers = [rnd.choice(kinds) for _ in range(rnd.randint(2, 6))]
        head = "\t".join(f"c{t}_{i}" for i in range(len(makers)))
        write(folder, f"t{t:04d}.tsv", [head] + ["k" + "\t".join(["", *(m(i) for m in makers[1:])]) for i in range(rows)])
    return str(folder)


def test_same_as_table_by_table(spark, rows, tmp_path):
    path = made_folder(tmp_path / "some", 8)
    tables = {f"t{t:04d}": readers.read_table(spark, f"{path}/t{t:04d}.tsv") for t in range(8)}
    both = [P.flatten(x.select("dataset", F.inline("columns"))) for x in (P.profile_folder(spark, path), P.profile(tables))]
    assert rows(both[0]) == rows(both[1])
    release()


def test_jobs_and_plan_do_not_grow_with_the_files(spark, tmp_path):
    seen = []
    for n in (40, 1000):
        path = made_folder(tmp_path / f"n{n}", n, rows=2)
        spark.sparkContext.setJobGroup(f"folder{n}", "")
        out = P.profile_folder(spark, path)
        count = out.count()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folder{n}"))
        seen.append((jobs, out._jdf.queryExecution().optimizedPlan().toString().count("\n")))
        assert count == n
    spark.sparkContext.setJobGroup("", "")
    assert seen[0] == seen[1]
    release()


def test_fields_headers_and_misfits(spark, rows, tmp_path):
    folder = tmp_path / "odd"
    write(folder, "q.tsv", ["", "  ", 'a\t"b ""c"\tA\t\ta.b `c`', '1\t"x\ty"\t"\\"in\\""\t""\tz', "2", "3\t4\t5\t6\t7\t8\t9", '"open\t1\t2\t3\t4', '"\\\\"\t"é"\t\t\t'])
    write(folder, "empty.tsv", [""])
    write(folder, "head.tsv", ["only"])
    corpus = C.Corpus(spark, str(folder))
    assert rows(corpus.columns().where("dataset = 'q'").select("place", "column_name")) == [(0, "a0"), (1, 'b "c'), (2, "A2"), (3, "_c3"), (4, "a.b `c`")]
    cells = corpus.cells().where("dataset = 'q'").groupBy("place").agg(F.sort_array(F.collect_list("val")).alias("v"))
    assert dict(rows(cells)) == {0: ['"open', "1", "2", "3", "\\"], 1: ["1", "4", "x\ty", "é"], 2: ['"in"', "2", "5"], 3: ["", "3", "6"], 4: ["4", "7", "z"]}
    assert rows(corpus.misfits().select("dataset", "problem", "value")) == [("q", "long", "3\t4\t5\t6\t7\t8\t9"), ("q", "open quote", '"open\t1\t2\t3\t4'), ("q", "short", "2")]
    assert rows(C.misfit_counts(corpus)) == [("head", 0, 0, 0, 0), ("q", 5, 1, 1, 1)]
    release()


def test_table_in_parts(spark, rows, tmp_path):
    """A folder named as a table's file is one table, its header in the first part; other files of such names are not."""
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder / "a+b.tsv", "part-0", ["x\ty"])
    write(folder / "a+b.tsv", "part-00000-z", ["1\tone", "2\ttwo"])
    write(folder / "a+b.tsv", "part-00001-z", ["3\tthree"])
    write(folder, "whole.tsv", ["x\ty", "4\tfour"])
    write(folder / "plain.tsv", "other.tsv", ["x", "5"])
    cells = C.Corpus(spark, f"{folder}/*").cells().groupBy("dataset", "place").agg(F.sort_array(F.collect_list("val")).alias("vals"))
    assert rows(cells) == sorted(
        [("a+b", 0, ["1", "2", "3"]), ("a+b", 1, ["one", "three", "two"]), ("other", 0, ["5"]), ("whole", 0, ["4"]), ("whole", 1, ["four"])], key=repr
    )
    release()


def test_written_tables_are_not_sorted_in_one_task(spark, tmp_path):
    from suite.q_files import table_folders

    lines = spark.range(4000).repartition(8).selectExpr("'t.tsv' AS file", "'1' AS place", "concat(id, '\t', id % 7) AS value")
    head = spark.sql("SELECT 't.tsv' AS file, '0' AS place, 'id\trest' AS value")
    corpus = C.Corpus(spark, table_folders(lines.unionByName(head), ["t.tsv"]) + "/*")
    assert corpus.lines.select("part").distinct().count() == 9
    assert corpus.records().count() == 4000 and corpus.headers.first()["names"] == ["id", "rest"]
    release()


def test_catalog_and_skip_list(spark, rows, tmp_path):
    path = made_folder(tmp_path / "chosen", 6)
    catalog = spark.createDataFrame([("t0001",), ("t0002",), ("t0003",), ("none",)], "dataset string")
    skip = spark.createDataFrame([("t0002",)], "dataset string")
    assert [r.dataset for r in P.profile_folder(spark, path, catalog, skip).orderBy("dataset").collect()] == ["t0001", "t0003"]
    release()


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "+007", "", None], "integer"), (["1", "99999999999999999999"], "integer"), (["1", "2.5", "1e5"], "real"), (["1", "NaN"], "real"), (["1.5d"], "text"),
        (["2015-02-03", "2015-2"], "date"), (["2015-02-03", "2015-02-03 10:00"], "timestamp"), (["2015-02-30"], "text"), (["12:30"], "text"),
        (["true", "False"], "boolean"), (["true", "1"], "text"), (["", None], "text"), ([None], "text"), (["2015", "2015-02-03"], "text"),
    ],
)
def test_lattice(spark, values, kind):
    counts = spark.createDataFrame([("d", 0, v, 1) for v in values], "dataset string, place int, val string, count bigint")
    assert [r.type for r in C.column_types(counts).collect()] == [kind]


def test_ascii(spark):
    texts = ["plain", "é", "tab\t\n\r\\", "it's", 'say "it\'s"', 'say "x"', "\x00\x7f😀", "", None, "~ "]
    df = spark.createDataFrame([(t,) for t in texts], "val string").select("val", ascii_escaped(F.col("val")).alias("e"))
    assert {r.val: r.e for r in df.collect()} == {t: None if t is None else repr(t.encode())[2:-1] for t in texts}


def test_lines_are_made_once(spark, rows):
    """A table's lines aren't made a second time to see whether they are empty; only those of one column can be."""
    from suite.q_folder import lines_of

    two = spark.createDataFrame([("a", None), (None, None), ('say "x"', "t\tb"), ("", "é")], "x string, y string")
    plan = lines_of("two", two)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "concat_ws" in line for line in plan.split("\n"))
    assert [r[2] for r in rows(lines_of("two", two).where("place = '1'"))] == sorted(["a\t", "\t", '"say \\"x\\""\t"t\tb"', '""\té'], key=repr)
    one = spark.createDataFrame([("a",), (None,), ("",)], "x string")
    assert [r[2] for r in rows(lines_of("one", one).where("place = '1'"))] == ['""', "a"]


def test_header_lines_are_found_without_shuffling_lines(spark):
    """Whatever size Spark takes the numbers of first lines for."""
    lines = spark.range(100).selectExpr("concat('t', id % 4) AS dataset", "'' AS part", "0L AS block", "id AS line", "concat('h', id, '\tx') AS value")
    found = C.headers(lines)
    assert {(r.dataset, r.first, tuple(r.names)) for r in found.collect()} == {(f"t{i}", i, (f"h{i}", "x")) for i in range(4)}
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = C.headers(lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
