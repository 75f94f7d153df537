"""ML4 for blocks with more columns than rows: PCA from inner products of rows.

The k x k form of ``linear.pca_fit`` holds k² numbers per split (16 GB at 44,850
columns).  Here the columns are dealt into blocks; every (split, block of
columns) standardises its columns on the train rows and gives its share of the
n x n matrix of inner products.  The shares are summed row by row, one task per
split solves n x n, and each block then turns the solution into its loadings and
its share of every row's scores.  No row of all columns leaves the JVM and no
task holds more than one block of columns or the n x n matrix.

Edge cases: a gap in the block is an error; a constant column counts as zero; a
component beyond the rank of the train rows is zero; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.pieces import _arrow, _reduced

COLUMN_BLOCK = 2048
RANK_TOLERANCE = 1e-12       # share of the largest eigenvalue that counts as rounding


def _standardised(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows in the order of the key, train rows first; their columns standardised on the train rows; which are train."""
    rows = rows.sort_by([("__test", "ascending"), ("__id", "ascending")]).combine_chunks()
    ids = rows.column("__id")
    train = ~rows.column("__test").to_numpy(zero_copy_only=False)
    column = rows.column("__x").combine_chunks() if rows.num_rows else None
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    x = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes != sizes[0]).any() or np.isnan(x).any():
        raise ValueError("a block of columns needs a value of every column in every row")
    x = x.reshape(len(sizes), -1)
    if len(set(ids.to_pylist())) != len(ids):
        raise ValueError("a row is in a split twice")
    if not train.any():
        raise ValueError("a split needs train rows")
    x = x - x[train].mean(axis=0)
    ss = (x[train] * x[train]).sum(axis=0)
    sd = np.sqrt(ss / train.sum())
    return rows, x / np.where(sd > 0, sd, 1.0), train


def pca_scores(rows: DataFrame, n_components: int, x_col: str = "x", out_col: str = "pc", id_col: str = "subject",
               column_block: int = COLUMN_BLOCK) -> DataFrame:
    """``rows`` (split, id, role, x, ...) with the scores ``out_col`` (array) on the first principal
    components of the standardised train rows of each split; the loading of largest magnitude
    is positive, of several the first, as in ``linear.pca_fit``."""
    spark, kind, c = rows.sparkSession, dict(rows.dtypes)[id_col], n_components
    share_ddl = f"split int, __id {kind}, block int, dots array<double>"
    axis_ddl = f"split int, __id {kind}, u array<double>"
    score_ddl = f"split int, __id {kind}, block int, scores array<double>, size array<double>, top array<double>"
    share_schema, axis_schema, score_schema = (_arrow(spark, d) for d in (share_ddl, axis_ddl, score_ddl))
    n_blocks = F.ceil(F.size(x_col) / F.lit(column_block)).cast("int")
    cut = rows.select(F.col("split").cast("int").alias("split"), F.col(id_col).alias("__id"),
                      (F.col("role") != "train").alias("__test"), F.col(x_col).cast("array<double>").alias("__all"),
                      F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
    cut = cut.select("split", "block", "__id", "__test",
                     F.slice("__all", F.col("block") * column_block + 1, column_block).alias("__x"))

    def shares(key, table):
        split, block = (k.as_py() for k in key)
        table, z, train = _standardised(table)
        z = z[train]
        ids = table.column("__id").slice(0, len(z)).combine_chunks()
        return pa.table([pa.array([split] * len(z), pa.int32()), ids, pa.array([block] * len(z), pa.int32()),
                         pa.array(list(z @ z.T), pa.list_(pa.float64()))], schema=share_schema)

    def summed(batches):
        def part(key, found):
            wide = found.column("dots").flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, -1)
            return wide.sum(axis=0)

        for (split, row), _, dots in _reduced(batches, ["split", "__id"], part, lambda a, b: a + b, "block"):
            yield pa.RecordBatch.from_arrays([pa.array([split], pa.int32()), pa.array([row], share_schema.field("__id").type),
                                              pa.array([0], pa.int32()), pa.array([dots], pa.list_(pa.float64()))],
                                             schema=share_schema)

    def axes(key, table):
        table = table.sort_by("__id").combine_chunks()
        n = table.num_rows
        gram = np.concatenate([x.values.to_numpy() for x in table.column("dots")]).reshape(n, n)
        lam, u = np.linalg.eigh((gram + gram.T) / 2.0)
        lam, u = lam[::-1][:c], u[:, ::-1][:, :c]
        good = lam > RANK_TOLERANCE * max(lam[0], 0.0)
        u = np.where(good, u / np.sqrt(np.where(good, lam, 1.0)), 0.0)
        u = np.pad(u, ((0, 0), (0, c - u.shape[1])))
        return pa.table([pa.array([key[0].as_py()] * n, pa.int32()), table.column("__id").combine_chunks(),
                         pa.array(list(u), pa.list_(pa.float64()))], schema=axis_schema)

    def scores(key, table, axis):
        if not table.num_rows:
            return score_schema.empty_table()
        split, block = (k.as_py() for k in key)
        table, z, train = _standardised(table)
        axis = axis.sort_by("__id").combine_chunks()
        u = np.concatenate([x.values.to_numpy() for x in axis.column("u")]).reshape(-1, c)
        w = z[train].T @ u                                   # loadings of the block's columns
        at = np.argmax(np.abs(w), axis=0)
        top = w[at, np.arange(c)]
        n = len(z)
        lists = pa.list_(pa.float64())
        return pa.table([pa.array([split] * n, pa.int32()), table.column("__id").combine_chunks(),
                         pa.array([block] * n, pa.int32()), pa.array(list(z @ w), lists),
                         pa.array([np.abs(top)] * n, lists), pa.array([top] * n, lists)], schema=score_schema)

    def added(batches):
        def part(key, found):
            values = [found.column(f).flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, c)
                      for f in ("scores", "size", "top")]
            state = None
            for row in zip(*values):
                state = row if state is None else merge(state, row)
            return state

        def merge(a, b):                                     # blocks in order: of equal loadings the first stays
            later = b[1] > a[1] * (1.0 + 1e-12)
            return a[0] + b[0], np.where(later, b[1], a[1]), np.where(later, b[2], a[2])

        for (split, row), _, (total, size, top) in _reduced(batches, ["split", "__id"], part, merge, "block"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([split], pa.int32()), pa.array([row], score_schema.field("__id").type), pa.array([0], pa.int32()),
                 pa.array([np.where(top < 0, -total, total)], pa.list_(pa.float64())),
                 *(pa.array([v], pa.list_(pa.float64())) for v in (size, top))], schema=score_schema)

    parts = cut.groupBy("split", "block").applyInArrow(shares, share_ddl)
    gram = parts.repartition("split", "__id").sortWithinPartitions("split", "__id", "block").mapInArrow(summed, share_ddl)
    axis = gram.groupBy("split").applyInArrow(axes, axis_ddl)
    blocks = cut.select("split", "block").distinct()
    per_block = axis.join(blocks, "split").select(F.col("split").alias("__s"), F.col("block").alias("__b"), "__id", "u")
    found = cut.groupBy("split", "block").cogroup(per_block.groupBy("__s", "__b")).applyInArrow(scores, score_ddl)
    found = found.repartition("split", "__id").sortWithinPartitions("split", "__id", "block").mapInArrow(added, score_ddl)
    found = found.select(F.col("split").alias("__s"), F.col("__id").alias("__i"), F.col("scores").alias(out_col))
    return rows.join(found, (F.col("split") == F.col("__s")) & (F.col(id_col) == F.col("__i"))).drop("__s", "__i")
