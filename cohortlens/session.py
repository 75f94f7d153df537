"""Session helpers.

The library never overrides cluster settings that are already present; it only
fills in defaults that make a local session behave (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens",
                  driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system path and is used as
    is; without it a cluster session is an error.  Only a local session (tests,
    bench) gets a private folder under the system temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def stored(df: DataFrame) -> DataFrame:
    """``df`` written below the checkpoint folder and read back: for a table that several
    later jobs read.  It survives lost executors and leaves nothing in the cache."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read back with its schema.  For loops:
    a checkpoint keeps the size estimate of its plan, which joins multiply from step to step."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
