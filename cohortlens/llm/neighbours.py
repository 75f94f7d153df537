"""Approximate nearest neighbours by collision counting.

Each row is projected on ``projections`` random directions, and every direction alone
is a sorted array.  A query opens a window around its own projection in every
array.  With radius R the window is ``width * R`` wide; rehashing is virtual: a
larger radius widens the same windows, and only what is new in them is counted.  A row
within R of the query collides in each array with the same known probability,
so the count of collisions is binomial: a row is verified (its cosine computed
from the whole vectors) once its count reaches the threshold that a row within R
misses with probability ``miss`` at most.  The radius doubles until k verified rows
of the shard lie within it or the query's last radius is reached.  There is no cap
on the rows that are verified.

On unit vectors the Euclidean distance orders as the cosine does.  A query's last
radius is its distance to the k-th nearest of a bounded sample (``sample_rows`` rows
with the smallest hash, compared exactly): the k nearest of all rows are not farther.
Those k rows are candidates too, so no query ends with fewer than k.  Where the
sample has fewer than k rows for a query, the last radius is 2, which holds everything,
and what is then still missing in a shard is verified row by row.

Every row is indexed.  Rows are dealt by a hash into shards and queries into blocks; each task
builds the arrays of one shard and searches them for one block of queries, both of
bounded expected size.  Only the k best of each (query, shard) leave it.  Copies,
however many, spread over all shards.  Nothing but the sample is collected.

Edge cases: vectors that are NULL, empty, all zero, or hold a NULL or a number that is not
finite take no part.  Vectors of another length than the query's are no candidates.
A row is no candidate of itself, but rows that repeat its id or vector are.  Repeated queries are
answered each.  Candidates with NULL ids rank last among equal cosines; NULL ids are no
queries.  Ties go to the smaller id.  With fewer than k candidates all are returned.  Further
columns are not read; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, stored

#: Cosines from a matrix product differ from exact ones by less.
_SLACK = 1e-9


def threshold(projections: int, width: float, miss: float) -> int:
    """The largest count that a row at distance R reaches with probability 1 - miss at least."""
    p = math.erf(width / (2 * math.sqrt(2)))        # the window holds |N(0, R)| <= width R / 2
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if below > miss:
            return max(1, count)
    return projections


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish; changes no cosine."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors ** 2).sum(axis=1))[:, None]


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in the same order of additions, so that equal rows have equal cosines."""
    dot, own, other = (vectors * query).sum(axis=1), (vectors * vectors).sum(axis=1), (query * query).sum()
    return dot / (np.sqrt(own) * np.sqrt(other))


def best_of(scores: np.ndarray, vectors: np.ndarray, query: np.ndarray, ids: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and cosines of the k best rows; ``scores``: their cosines up to rounding, -inf for other rows."""
    found = np.flatnonzero(scores > -np.inf)
    if len(found) > k:
        found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k] - _SLACK]
    score, names = cosines(vectors[found], query), ids.take(pa.array(found))
    best = np.lexsort((names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False), -score))[:k]
    return found[best], score[best]


class CollisionIndex:
    """The sorted projections of one shard."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, vectors: np.ndarray, projections: int, width: float, miss: float,
                 doublings: int, seed: int):
        self.rows, self.ids, self.vectors = rows, ids, scaled(vectors)
        self.unit = unit(self.vectors)
        self.axes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], projections))
        points = np.ascontiguousarray((self.unit @ self.axes).T)
        self.order = np.argsort(points, axis=1)
        self.points = np.take_along_axis(points, self.order, axis=1)
        self.least, self.half, self.doublings = threshold(projections, width, miss), width / 2, doublings
        self.verified = 0

    def search(self, own: np.ndarray, vectors: np.ndarray, last: np.ndarray, k: int, block: int = 256):
        """Per query (its row, vector and last radius) the places and cosines of its k best verified rows."""
        for start in range(0, len(own), block):
            raw = scaled(vectors[start:start + block])
            units = unit(raw)
            radii = last[start:start + block, None] / 2.0 ** np.arange(self.doublings, -1, -1)
            at, reach = (units @ self.axes).T, self.half * radii
            low, high = (np.empty((len(raw), radii.shape[1], len(self.points)), np.int64) for _ in range(2))
            for i, points in enumerate(self.points):
                low[:, :, i] = np.searchsorted(points, at[i][:, None] - reach)
                high[:, :, i] = np.searchsorted(points, at[i][:, None] + reach, side="right")
            for q in range(len(raw)):
                scores = self._one(units[q], self.rows == own[start + q], radii[q], low[q], high[q], k)
                yield best_of(scores, self.vectors, raw[q], self.ids, k)

    def _one(self, query: np.ndarray, seen: np.ndarray, radii: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
        counts, scores = np.zeros(len(self.rows), np.int64), np.full(len(self.rows), -np.inf)

        def verify(places: np.ndarray) -> None:
            scores[places] = self.unit[places] @ query
            seen[places] = True
            self.verified += len(places)
        begin = end = low[0].tolist()                       # empty windows
        for radius, lo, hi in zip(radii, low.tolist(), high.tolist()):
            new = [order[a:b] for order, a, b in zip(self.order, lo, begin)] + [order[a:b] for order, a, b in zip(self.order, end, hi)]
            counts += np.bincount(np.concatenate(new), minlength=len(counts))
            begin, end = lo, hi
            verify(np.flatnonzero((counts >= self.least) & ~seen))
            if (scores >= 1 - radius * radius / 2).sum() >= k:          # the cosine at this distance
                return scores
        if radii[-1] >= 2 and (scores > -np.inf).sum() < k:
            verify(np.flatnonzero(~seen))
        return scores


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


_FOUND = "query_row long, query_id long, row long, id long, score double"


def _found(queries: pa.Table | pa.RecordBatch, rows: pa.Array, ids: pa.Array, best: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    of = pa.array(np.repeat(np.arange(len(best)), [len(places) for places, _ in best]), pa.int64())
    places = pa.array(np.concatenate([places for places, _ in best] or [np.zeros(0, np.int64)]), pa.int64())
    return [queries.column("row").take(of), queries.column("id").take(of), rows.take(places), ids.take(places),
            pa.array(np.concatenate([score for _, score in best] or [np.zeros(0)]), pa.float64())]


def _sampled(sample: dict[int, pa.Table], k: int):
    """The k best rows of the sample for each query."""
    names = ["query_row", "query_id", "row", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {size: unit(scaled(_matrix(rows.column("vector")))) for size, rows in sample.items()}
        for batch in batches:
            for size in pc.unique(batch.column("size")).to_pylist():
                if size not in sample:
                    continue
                queries = batch.filter(pc.equal(batch.column("size"), size))
                rows, ids = (sample[size].column(c).combine_chunks() for c in ("row", "id"))
                vectors, best = scaled(_matrix(sample[size].column("vector"))), []
                for own, raw in zip(queries.column("row").to_pylist(), scaled(_matrix(queries.column("vector")))):
                    scores = units[size] @ unit(raw[None])[0]
                    scores[rows.to_numpy() == own] = -np.inf
                    best.append(best_of(scores, vectors, raw, ids, k))
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                                                  for c in _found(queries, rows, ids, best)], names)
    return run


def _search(k: int, options: dict):
    names = ["query_row", "query_id", "row", "id", "score"]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names], names)
        row, ids = (rows.column(c).combine_chunks() for c in ("row", "id"))
        index = CollisionIndex(row.to_numpy(), ids, _matrix(rows.column("vector")), **options)
        best = list(index.search(queries.column("row").to_numpy(), _matrix(queries.column("vector")),
                                 queries.column("last").to_numpy(), k))
        return pa.table(_found(queries, row, ids, best), names)
    return run


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            projections: int = 64, width: float = 2.72, miss: float = 0.05, doublings: int = 3, sample_rows: int = 2048,
            seed: int = 7, shard_bytes: int = 128 << 20, block_queries: int = 1 << 15) -> DataFrame:
    """query_id, rank, id, score: per row for which ``is_query`` holds its k nearest other rows found.

    ``miss``: the probability, at most, that a neighbour is passed over.  The number of shards
    follows from ``shard_bytes`` (of a shard's vectors and arrays) and, while shards stay
    above a thousand rows, from the number of shuffle partitions."""
    spark = df.sparkSession
    vector = F.col(vector_col)
    usable = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        vector, lambda x: x != 0)
    rows = df.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), vector.alias("vector"),
        F.size(vector).alias("size"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stored(rows, "neighbours-rows")
    n, asking, numbers = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)),
                                  F.coalesce(F.sum(F.col("size").cast("long")), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts_for(16 * numbers + 16 * projections * n, shard_bytes), min(parts_for(n, 1000), 2 * partitions))
    blocks = parts_for(asking, block_queries)

    drawn = rows.orderBy(F.xxhash64("row"), "row").limit(sample_rows).select("row", "id", "vector", "size").toArrow()
    sample = {size: drawn.filter(pc.equal(drawn.column("size"), size)) for size in pc.unique(drawn.column("size")).to_pylist()}
    queries = rows.where("asks").select("row", "id", "vector", "size")
    of_sample = stored(queries.mapInArrow(_sampled(sample, k), _FOUND), "neighbours-sample")
    kth = of_sample.groupBy(F.col("query_row").alias("row")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).where(
        F.col("n") >= k).select("row", (F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))) + 1e-6).alias("last"))
    queries = stored(queries.join(kth, "row", "left").withColumn("last", F.coalesce("last", F.lit(2.0))), "neighbours-queries")

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    keys = ["size", "shard", "block"]
    held = rows.select("size", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), all_of(blocks).alias("block"),
                       "row", "id", "vector")
    asked = queries.select("size", all_of(shards).alias("shard"),
                           F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "row", "id", "vector", "last")
    options = {"projections": projections, "width": width, "miss": miss, "doublings": doublings, "seed": seed}
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search(k, options), _FOUND)
    found = found.unionByName(of_sample).dropDuplicates(["query_row", "row"])
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
