"""Sinks: partitioned Parquet (and one JSON report) for features, matrices,
predictions, split membership, models and scores.  Writes are idempotent
(``overwrite`` of the touched partitions only) so a re-run after a lost
executor or a failed job replaces rather than duplicates output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_START = "\x1e"          # the record separator: begins a file in a bundle of text files


def _writer(df: DataFrame, partition_by: Sequence[str]):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return w.partitionBy(*partition_by) if partition_by else w


def _own(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def write_features(features: DataFrame, path: str, batch: str) -> None:
    """SNK1: long features (subject, session, kind, name, value) by kind, session and batch.

    ``batch`` names the set of subjects written: a repeated run of a batch
    replaces it and leaves the subjects of other batches alone.  The rebalanced
    exchange splits a large kind or session over several tasks."""
    rows = features.withColumn("batch", F.lit(batch)).hint("rebalance", "kind", "session")
    _writer(rows, ["kind", "session", "batch"]).parquet(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """SNK2: per-run matrices as edge tables."""
    _writer(edges, ["subject"]).parquet(path)


def _file_start(file) -> Column:
    return F.concat(F.lit(FILE_START), F.coalesce(file, F.lit("")))


def _file_line(line) -> Column:
    return F.when(F.contains(line, F.lit(FILE_START)), F.raise_error(F.lit("a line holds the mark of a file"))).otherwise(line)


def write_bundled_files(files: DataFrame, path: str) -> None:
    """Text files (file, lines array), many in one part file: the mark ``FILE_START`` and the
    name, then the lines.  A tree of a folder per subject costs several file operations each,
    most of them on the driver; ``sources.files`` reads both forms."""
    body = F.array_join("lines", "\n")
    files.select(F.concat(_file_start(F.col("file")), F.lit("\n"), _file_line(body))).write.mode("overwrite").text(path)


def write_bundled_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """``write_bundled_files`` from rows (file, o, line): each file's lines by ``o``, never held together."""
    rows = lines.select(F.coalesce("file", F.lit("")).alias("file"), F.col("o").cast("long").alias("o"), _file_line(F.col("line")).alias("line"))
    start = _file_start(F.col("file"))
    heads = rows.select("file").distinct().select("file", F.lit(None).cast("long").alias("o"), (
        F.concat(start, F.lit("\n" + header)) if header is not None else start).alias("line"))
    (rows.unionByName(heads).repartition("file").sortWithinPartitions("file", F.asc_nulls_first("o")).select("line")
     .write.mode("overwrite").text(path))


def write_excluded_rois(excluded: DataFrame, path: str) -> None:
    """SNK3: {run: {roi: [x, y, z]}} per (subject, session) as JSON lines."""
    per_run = excluded.groupBy("subject", "session", "run").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("roi").cast("string"),
                                                   F.array("x", "y", "z")))).alias("rois"))
    nested = per_run.groupBy("subject", "session").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("run").cast("string"), "rois"))).alias("excluded_rois"))
    nested.write.mode("overwrite").json(path)


def marked_predictions(results: dict[str, DataFrame]) -> DataFrame:
    """SNK4: the predictions of a learning run in one table; ``kind`` is test, train or permuted."""
    kinds = {"predictions": "test", "predictions_training": "train", "predictions_permuted": "permuted"}
    marked = [results[name].withColumn("kind", F.lit(kind)) for name, kind in kinds.items() if name in results]
    out = marked[0]
    for df in marked[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def write_predictions(pred: DataFrame, path: str) -> None:
    """SNK4: predictions by model and modality, and by kind (test, train, permuted) if they have it."""
    _writer(pred, ["model", "modality", *_own(pred, ["kind"])]).parquet(path)


def write_split_members(members: DataFrame, path: str) -> None:
    """SNK5: split membership (split, subject, role); with model and modality
    columns only the written ones are replaced."""
    _writer(members, _own(members, ("model", "modality"))).parquet(path)


def write_coefficients(coef: DataFrame, path: str) -> None:
    """SNK6 (linear models): one coefficient row per (model, modality, split, feature)."""
    _writer(coef, ["model", "modality"]).parquet(path)


def save_model(model, path: str) -> None:
    """SNK6 (Spark ML models): the model's own writer."""
    model.write().overwrite().save(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """SNK7: learning-curve scores / permutation importances; with model and
    modality columns only the written ones are replaced."""
    _writer(scores, _own(scores, ("model", "modality"))).parquet(path)
