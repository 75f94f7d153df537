"""Ranks and lags within groups of any size.

``row_number`` / ``lag`` over ``Window.partitionBy(group)`` sort a whole group
in one task, which a group with a third of all rows does not survive.  So:

1. range-partition on (group, order) — a big group is spread over many
   contiguous partitions — and checkpoint, so partition ids are fixed even if
   a stage is recomputed after an executor loss;
2. rank / lag inside each (partition, group) slice (bounded by partition size);
3. a small table (partition, group, count, last value) gives each slice its
   offset (sum of earlier slices of the group) and its predecessor value.  Only
   the first slice of a partition continues a group, so at most one row per
   partition differs from the default: these few rows are broadcast and the
   rows themselves are not shuffled for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def range_slices(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n_parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned on (group, order), with the partition as ``__pid``, checkpointed."""
    from cohortlens.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    r = df.repartitionByRange(n, *_cols(group), *_cols(order)).withColumn("__pid", F.spark_partition_id())
    return r.checkpoint()


def join_slices(rows: DataFrame, per_slice: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """Join the table of slices to the rows; a NULL in a group column equals NULL."""
    names = {g: f"__g{i}" for i, g in enumerate(group)}
    other = per_slice.withColumnsRenamed({"__pid": "__p", **names})
    same = F.col("__pid") == F.col("__p")
    for g, name in names.items():
        same = same & F.col(g).eqNullSafe(F.col(name))
    return rows.join(other, same, how).drop("__p", *names.values())


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str = "rn",
                n_parts: int | None = None) -> DataFrame:
    """1-based row_number over (group ordered by order); ``order`` must be a
    total order within the group (add a unique tiebreak)."""
    group = list(group)
    r = range_slices(df, group, order, n_parts)
    r = r.withColumn("__lr", F.row_number().over(Window.partitionBy("__pid", *group).orderBy(*_cols(order))))
    cnt = r.groupBy("__pid", *group).agg(F.max("__lr").alias("__c"))
    prev = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.withColumn("__off", F.sum("__c").over(prev)).drop("__c").filter("__off is not null")
    return (join_slices(r, F.broadcast(off), group, "left").withColumn(name, F.coalesce("__off", F.lit(0)) + F.col("__lr"))
            .drop("__pid", "__lr", "__off"))


def lag_within(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], values: Sequence[str],
               suffix: str = "__lag", n_parts: int | None = None) -> DataFrame:
    """Previous value of each column in ``values`` in the group's order, as
    ``{value}{suffix}`` (NULL for the first row of a group)."""
    group, values = list(group), list(values)
    r = range_slices(df, group, order, n_parts)
    w = Window.partitionBy("__pid", *group).orderBy(*_cols(order))
    r = r.select("*", F.row_number().over(w).alias("__lr"), *[F.lag(v).over(w).alias(v + suffix) for v in values])
    last = (r.withColumn("__mx", F.max("__lr").over(Window.partitionBy("__pid", *group)))
            .filter(F.col("__lr") == F.col("__mx")).select("__pid", *group, *[F.col(v).alias(f"__last_{v}")
                                                                             for v in values]))
    prev = Window.partitionBy(*group).orderBy("__pid")
    carry = last.select("__pid", *group, *[F.lag(f"__last_{v}").over(prev).alias(f"__carry_{v}") for v in values],
                        F.row_number().over(prev).alias("__k")).filter("__k > 1").drop("__k")
    out = join_slices(r, F.broadcast(carry), group, "left")
    for v in values:
        out = out.withColumn(v + suffix, F.when(F.col("__lr") == 1, F.col(f"__carry_{v}")).otherwise(
            F.col(v + suffix)))
    return out.drop("__pid", "__lr", *[f"__carry_{v}" for v in values])
