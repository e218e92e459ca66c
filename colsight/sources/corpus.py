"""A folder of delimited tables with headers of their own, read as one long table of cells.

Every file is a table; its first line that isn't blank names its columns. All files are one scan:
each line's fields are paired with its own file's header, so neither the plan nor the number of jobs
depends on how many files there are or how they differ. Types come from the distinct values: each value
says which types it rules out, and a column has the first type that none of its values rules out. That
is one small aggregation over value counts in place of another pass over the files.

A table too large for one file may be a folder that is named as its file would be and holds files `part-<number>...`
in the order of their names, the header in the first.

A line is a record. Fields may be quoted; inside quotes a backslash or a second quote escapes a
quote. An empty field is an empty cell, a quoted empty one an empty text. Missing fields at a
line's end are empty cells and surplus ones are left out; `misfits` has these lines, and those
whose quote doesn't close. Columns without a name are `_c` and their place; names that occur twice
in a header, in whatever case, get their place appended. Numbers are plain numbers (no `1.5d`), and
a time without a date is no timestamp, so no type depends on the day of the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight.functions.text import file_name
from colsight.operators.cells import DATETIME, INTEGER, REAL, TEXT
from colsight.plans.staging import stage

ENDING = r"\.(tsv|txt|csv|tab)(\.(gz|bz2|zst))?$"

# --- the lattice: what a value rules out, weakest first ------------------------------------------------
# name, profile type, cast, condition under which a filled value can be read so
TYPES = (
    ("integer", INTEGER, "DECIMAL(38,0)", r"val RLIKE r'^[+-]?[0-9]{1,38}$'"),
    ("real", REAL, "DOUBLE", r"val RLIKE r'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' OR val IN ('NaN', 'Inf', '-Inf', 'Infinity', '-Infinity')"),
    ("date", DATETIME, "DATE", r"val RLIKE r'^[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?$' AND try_cast(val AS DATE) IS NOT NULL"),
    ("timestamp", DATETIME, "TIMESTAMP", r"val RLIKE r'^[0-9]{4}-[0-9]{1,2}' AND try_cast(val AS TIMESTAMP) IS NOT NULL"),
    ("boolean", TEXT, "BOOLEAN", r"lower(val) IN ('true', 'false')"),
)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(dataset, part, block, line, value): lines that aren't blank, numbered in the order of their file. `part` is
    the file's name if its folder is the table, else empty."""
    place = F.split(F.col("_metadata.file_path"), "/")
    folder = F.url_decode(F.replace(F.get(place, F.size(place) - 2), F.lit("+"), F.lit("%2B")))
    is_part = file_name().rlike("^part-[0-9]") & folder.rlike(ENDING)
    return spark.read.text(path).select(
        F.regexp_replace(F.when(is_part, folder).otherwise(file_name()), ENDING, "").alias("dataset"),
        F.when(is_part, file_name()).otherwise("").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    ).where(r"value RLIKE r'[^\x00-\x20]'")


def chosen(lines: DataFrame, catalog: DataFrame | None = None, skip: DataFrame | None = None) -> DataFrame:
    """Lines of the datasets in `catalog(dataset)` that aren't in `skip(dataset)`."""
    if catalog is not None:
        lines = lines.join(catalog.select("dataset").distinct(), "dataset", "left_semi")
    return lines if skip is None else lines.join(skip.select("dataset").distinct(), "dataset", "left_anti")


def _fields(value: Column, sep: str) -> Column:
    """The line's fields as they stand, quotes included."""
    quoted = rf'"(?s:.*?)(?<!\\)(?:\\\\)*+"(?={sep}|\z)'
    raw = F.regexp_extract_all(value, F.lit(rf"(?:^|{sep})({quoted}|[^{sep}]*)"), F.lit(1))
    return F.when(value.contains('"'), raw).otherwise(F.split(value, sep, -1))


def _content(field: Column) -> Column:
    """A field's text: null if empty; quotes and escapes of a quoted one taken off."""
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    plain = F.regexp_replace(inner, r'\\(["\\])|"(")', "$1$2")
    is_quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
    return F.when(is_quoted, plain).when(field != "", field)


def _is_open(field: Column) -> Column:
    return field.startswith('"') & ~(field.endswith('"') & (F.length(field) > 1))


def _names(fields: Column) -> Column:
    """Column names of a header."""
    texts = F.transform(fields, lambda f: F.coalesce(_content(f), F.lit("")))
    low = F.transform(texts, F.lower)

    def name(text: Column, i: Column) -> Column:
        twice = F.size(F.filter(low, lambda x: x == F.lower(text))) > 1
        place = i.cast("string")
        return F.when(text == "", F.concat(F.lit("_c"), place)).when(twice, F.concat(text, place)).otherwise(text)

    return F.transform(texts, name)


def headers(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """(dataset, first, names): the number of each file's first line and the names in it.

    Found by minima of numbers, combined on the map side; only the lines themselves are then looked up.
    """
    per_block = lines.groupBy("dataset", "part", "block").agg(F.min("line").alias("line"))
    first = per_block.groupBy("dataset").agg(F.min_by("line", F.struct("part", "block")).alias("line"))
    # one number a table, so that no line is shuffled
    return lines.join(F.broadcast(first), ["dataset", "line"], "left_semi").select("dataset", F.col("line").alias("first"), _names(_fields(F.col("value"), sep)).alias("names"))


class Corpus:
    """The lines of a folder and, staged, the headers of its files."""

    def __init__(self, spark: SparkSession, path: str | list[str], catalog: DataFrame | None = None, skip: DataFrame | None = None, sep: str = "\t"):
        self.sep = sep
        self.lines = chosen(read_lines(spark, path), catalog, skip)
        self.headers = stage(headers(self.lines, sep))

    def records(self) -> DataFrame:
        """(dataset, line, names, fields, value) of every line but the headers."""
        joined = self.lines.join(self.headers, "dataset").where("line <> first")
        return joined.select("dataset", "line", "names", _fields(F.col("value"), self.sep).alias("fields"), "value")

    def cells(self) -> DataFrame:
        """(dataset, place, val): every cell as text, null if empty."""
        cut = F.transform("fields", _content)
        return self.records().select("dataset", "names", cut.alias("texts")).select("dataset", F.posexplode("names").alias("place", "name"), "texts").select(
            "dataset", "place", F.get("texts", F.col("place")).alias("val")
        )

    def misfits(self) -> DataFrame:
        """(dataset, line, problem, value): lines that don't fit their header; `short`, `long` or `open quote`."""
        width, wanted = F.size("fields"), F.size("names")
        problem = (
            F.when(F.exists("fields", _is_open), "open quote").when(width < wanted, "short").when(width > wanted, "long")
        )
        return self.records().withColumn("problem", problem).where("problem IS NOT NULL").select("dataset", "line", "problem", "value")

    def columns(self) -> DataFrame:
        """(dataset, place, column_name) as the headers say."""
        return self.headers.select("dataset", F.posexplode("names").alias("place", "column_name"))

    def value_counts(self) -> DataFrame:
        """(dataset, column_name, bucket, val, count): the profile's input, values as their type writes them."""
        counts = stage(self.cells().groupBy("dataset", "place", "val").agg(F.count(F.lit(1)).alias("count")))
        typed = column_types(counts).join(self.columns(), ["dataset", "place"])
        read = counts.join(typed, ["dataset", "place"]).select("dataset", "column_name", "bucket", as_type(F.col("type")).alias("val"), "count")
        return read.groupBy("dataset", "column_name", "bucket", "val").agg(F.sum("count").alias("count"))


def ruled_out() -> Column:
    """A bit for each type that `val` can't be read as; empty values rule nothing out."""
    bits = " + ".join(f"CASE WHEN {can} THEN 0 ELSE {1 << i} END" for i, (_, _, _, can) in enumerate(TYPES))
    return F.expr(f"CASE WHEN val IS NULL OR val = '' THEN 0 ELSE {bits} END")


def column_types(counts: DataFrame) -> DataFrame:
    """(dataset, place, type, bucket): the first type that no value of the column rules out, else text."""
    out = counts.groupBy("dataset", "place").agg(F.bit_or(ruled_out()).alias("ruled"), F.max(F.expr("val <> ''")).alias("filled"))
    free = [F.col("filled") & (F.col("ruled").bitwiseAND(1 << i) == 0) for i in range(len(TYPES))]
    kind, bucket = F.lit("text"), F.lit(TEXT)
    for can, (name, profile_type, _, _) in reversed(list(zip(free, TYPES))):
        kind, bucket = F.when(can, name).otherwise(kind), F.when(can, profile_type).otherwise(bucket)
    return out.select("dataset", "place", kind.alias("type"), bucket.alias("bucket"))


def as_type(kind: Column) -> Column:
    """`val` as its column's type writes it."""
    out = F.col("val")
    for name, _, cast, _ in TYPES:
        out = F.when(kind == name, F.expr(f"CAST(try_cast(val AS {cast}) AS STRING)")).otherwise(out)
    return out


def misfit_counts(corpus: Corpus) -> DataFrame:
    """(dataset, rows, short, long, open_quote) of every file, those without misfits too."""
    bad = corpus.misfits().groupBy("dataset").pivot("problem", ["short", "long", "open quote"]).count().withColumnRenamed("open quote", "open_quote")
    rows = corpus.records().groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    zero = F.lit(0).cast("bigint")
    out = corpus.headers.select("dataset").join(rows, "dataset", "left").join(bad, "dataset", "left")
    return out.select("dataset", *[F.coalesce(c, zero).alias(c) for c in ("rows", "short", "long", "open_quote")])
