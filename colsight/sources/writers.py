"""Sinks. All write in parallel from the executors; nothing is serialised on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from colsight import rules as R

# a CSV writer trims fields unless told not to
AS_IS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_profiles(profile: DataFrame, path: str) -> None:
    """One JSON folder per dataset; `dataset` is also kept inside the rows."""
    profile.withColumn("name", F.col("dataset")).write.partitionBy("name").json(path)


def write_semantic_json(rows: DataFrame, path: str) -> None:
    """One JSON object per column: column_name, semantic_type[...], count."""
    rows.write.json(path)


def write_semantic_document(rows: DataFrame, path: str, documents: int) -> None:
    """`{"predicted_types": [...]}` documents, the columns dealt over `documents` of them. One
    document passes through one task, so ask for one only if its columns fit there; rows without
    that limit are written by `write_semantic_json`."""
    shard = F.pmod(F.xxhash64("column_name"), F.lit(documents)).alias("document")
    packed = rows.groupBy(shard).agg(F.sort_array(F.collect_list(F.struct(*rows.columns))).alias("predicted_types"))
    packed.drop("document").write.json(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """CSV of (filename, pred), types joined with `|`."""
    predictions.select(F.col("column_id").alias("filename"), F.array_join("types", "|").alias("pred")).write.csv(
        path, **AS_IS
    )


def write_report(report: DataFrame, path: str) -> None:
    """CSV with one field per report column."""
    report.write.csv(path, **AS_IS)


def quoted_term(column: str = "term"):
    """A term in quotes, with quotes inside doubled."""
    return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))


def write_terms(terms: DataFrame, path: str, column: str = "term", by: str | None = None) -> None:
    """One quoted term a line; one folder per value of `by` if given."""
    rows = terms.select(*([by] if by else []), quoted_term(column).alias("value"))
    (rows.write.partitionBy(by) if by else rows.write).text(path)


def write_term_line(terms: DataFrame, path: str, column: str = "term", by: str | None = None) -> None:
    """All terms in one line, as keyword lists are usually kept; one folder per value of `by`.
    The line passes through one task: for lists of bounded length, such as mined keywords."""
    line = F.array_join(F.array_sort(F.collect_list(quoted_term(column))), ",").alias("value")
    if by is None:
        terms.agg(line).write.text(path)
    else:
        terms.groupBy(by).agg(line).write.partitionBy(by).text(path)


def write_cluster_rows(clusters: DataFrame, path: str) -> None:
    """JSON rows (cluster_id, item), written where they lie: no cluster meets in a task."""
    clusters.select("cluster_id", "item").write.json(path)


def write_clusters(clusters: DataFrame, path: str, parts: int) -> None:
    """JSON rows (cluster_id, part, items): every cluster in `parts` rows, whatever its size, and
    fewer only if it has fewer items. A part has to fit in a task's memory; `write_cluster_rows`
    writes rows, which always do."""
    numbered = clusters.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    numbered.groupBy("cluster_id", "part").agg(F.array_sort(F.collect_list("item")).alias("items")).write.json(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """The similarity matrix as CSV of its non-zero cells (a, b, score)."""
    edges.select("a", "b", "score").write.csv(path, **AS_IS)


def label_rows(weights: DataFrame) -> DataFrame:
    """(column_name, semantic_type[...]) from `(column_id, label, weight)`; types that are
    only labels go to `label`."""
    as_label = F.col("label").isin(list(R.LABEL_TYPES))
    return weights.select(
        F.col("column_id").alias("column_name"),
        F.array(
            F.struct(
                F.when(~as_label, F.col("label")).otherwise("").alias("semantic_type"),
                F.when(as_label, F.col("label")).otherwise("").alias("label"),
                F.col("weight").alias("count"),
            )
        ).alias("semantic_type"),
    )


def write_label_json(weights: DataFrame, path: str) -> None:
    """One JSON folder per hand-labelled column."""
    label_rows(weights).withColumn("name", F.col("column_name")).write.partitionBy("name").json(path)


def write_regex(patterns: DataFrame, path: str) -> None:
    """One folder per type, each with its pattern as the only line."""
    patterns.select("semantic_type", F.col("pattern").alias("value")).write.partitionBy("semantic_type").text(path)
