"""Incremental structural features: new statistics files -> feature store.

``readStream.text`` over the statistics tree (the checkpoint remembers which
files were done); ``foreachBatch`` parses the new lines into a store of
statistics, one partition per batch.  A retried batch replaces its own partition
and no other, so nothing is lost or doubled.  Features are a query over the
store: a subject whose files come in several batches or sessions is scaled with
its own session's total volume, and a file that is seen again in a newer version
replaces its older values.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import structural as ST
from cohortlens.session import scratch_path
from cohortlens.sources import files as SRC
from cohortlens.sources.sinks import FILE_START

STORE_SCHEMA = ("subject string, session string, modified timestamp, path string, hemi string, kind string, "
                "struct string, measure string, value double, batch string")


def run_incremental_features(spark: SparkSession, stats_glob: str, out_path: str, checkpoint: str | None = None,
                             kind: str | None = None, max_files_per_trigger: int = 1000, bundled: bool = False) -> int:
    """Parse every statistics file not seen before into the store; returns the number of batches.
    ``bundled``: each text file holds many statistics files, which are picked up with it."""
    checkpoint = checkpoint or scratch_path(spark, "incremental-features-ckpt")
    texts = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    texts = (texts.option("lineSep", FILE_START) if bundled else texts).load(stats_glob).select(
        "value", SRC.path_col().alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    if bundled:
        files = SRC.bundled_files(texts)
        lines = files.select("path", F.concat_ws("!/", "file", "path").alias("file"), "modified",
                             F.explode(F.split("value", "\n")).alias("line"))
    else:
        lines = texts.select(F.col("file").alias("path"), "file", "modified", F.col("value").alias("line"))
    session = F.nullif(F.regexp_extract("path", SRC.ENTITY_PATTERNS["session"], 1), F.lit(""))
    lines = lines.withColumn("session", F.coalesce(session, F.lit("s1")))
    batches = []

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = SRC.parse_stats_lines(batch, kind).withColumnRenamed("file", "path")
        # batch numbers start again under another checkpoint, so its name is part of the key
        (rows.withColumn("batch", F.lit(f"{zlib.crc32(checkpoint.encode()):08x}-{batch_id}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_path))
        batches.append(batch_id)

    q = (lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def stored_statistics(spark: SparkSession, out_path: str) -> DataFrame:
    """The store with one row per (subject, session, kind, hemi, struct, measure): the newest file's."""
    keys = ["subject", "session", "kind", "hemi", "struct", "measure"]
    rows = spark.read.schema(STORE_SCHEMA).parquet(out_path)
    return rows.groupBy(*keys).agg(F.max_by("value", F.struct("modified", "path")).alias("value"))


def incremental_features(spark: SparkSession, out_path: str) -> DataFrame:
    """(subject, session, kind, name, value): every aseg volume / total volume of the
    subject's session, and the parcels' thickness and scaled volume."""
    stats = stored_statistics(spark, out_path)
    keys = ["subject", "session"]
    etiv = (stats.filter((F.col("measure") == "measure") & (F.col("struct") == ST.ETIV))
            .groupBy(*keys).agg(F.first("value").alias("etiv")))
    vol = stats.filter("measure = 'Volume_mm3'").select(*keys, "struct", "value")
    norm = ST.etiv_normalise(vol, keys, etiv=etiv).select(
        *keys, F.concat(F.lit("fs__vol__"), "struct").alias("name"), "value")
    parcels = ST.collect_tables(stats, keys).filter(F.col("table").startswith("cort")).select(*keys, "name", "value")
    return norm.unionByName(parcels).select(*keys, F.lit("fs").alias("kind"), "name", "value")
