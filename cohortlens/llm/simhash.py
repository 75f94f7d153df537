"""SimHash near-deduplication with BK-trees.

The distinct fingerprints are dealt into shards.  Two that differ in at most r
bits agree in one of r + 1 blocks of bits, so each block is a table, sorted by
the block's value and cut into ranges of some ten thousand rows that never part
equal values.  Every range is one BK-tree: a node is a fingerprint, its
children are keyed by their Hamming distance to it.  A query at distance d of a
node follows only the edges from d - radius to d + radius, so it meets a small
part of its tree; the tree of its own range in each table holds all that can be
within the radius.  Trees and queries meet in the task of their range instead
of being broadcast, as no bound on all trees together holds at any scale.  A
block value with more rows than a tree should have is dealt again by the
blocks of its other bits.  Trees are built and searched level by level in
numpy; the links found are reduced at once to spanning stars, so a group of
many near copies never becomes all its pairs.  Components come from alternating
large-star and small-star steps on Spark; neither links nor fingerprints go to
the driver.

Edge cases: NULL text is empty; a text without words has fingerprint zero and
is linked like any other; exact copies and repeated rows share a fingerprint;
NULL ids never name a component while another id is in it; empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, small_batches, stored, unused

_SEED = 42
#: For each byte value eight one-byte lanes with its bits, the lowest bit in the lowest lane.
_LANES = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], np.uint64)


def _hashes(text: bytes, width: int) -> list[int]:
    words = text.lower().split()        # on bytes: A-Z only, and exactly the white space of the contract
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, _SEED)]
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0] + [e + 1 for e in ends[:-width]]
    return [digest(joined[a:b], _SEED) for a, b in zip(starts, ends[width - 1:])]


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """The SimHash of each text as a signed 64-bit number."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = _hashes(text, width)
        hashes.extend(own)
        counts[i] = len(own)
    out = np.zeros(len(texts), np.uint64)
    if hashes:
        lanes = _LANES[np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)]
        has = np.flatnonzero(counts)
        pieces = -(-counts[has] // 255)                     # a one-byte lane counts 255 rows at most
        begin = (np.cumsum(counts[has]) - counts[has]).repeat(pieces) + 255 * expand(np.zeros(len(has)), pieces)
        sums = np.add.reduceat(lanes, begin, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
        sums = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0)
        bits = np.packbits(2 * sums > counts[has][:, None], axis=1, bitorder="little")
        out[has] = bits.view(np.uint64).ravel()
    return out.view(np.int64)


def _fingerprint(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches([whole], "bytes", 4 << 20):
                found = fingerprints(batch.column("bytes").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("content"), pa.array(found)],
                                                 ["id", "content", "fp"])
    return run


class BKForest:
    """BK-trees over distinct values, one for each group; node i is value i."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        """``group`` is sorted and numbered from 0; ``visited`` counts the nodes that queries meet."""
        self.visited = 0
        self.values = values = np.ascontiguousarray(values).view(np.uint64)      # bits of a signed number count by its absolute value
        parent, edge = np.full(len(values), -1, np.int64), np.zeros(len(values), np.int64)
        items, cell = np.arange(len(values)), group
        self.roots = np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0))
        while len(items):
            new = np.ones(len(items), bool)
            new[1:] = cell[1:] != cell[:-1]
            node = items[np.flatnonzero(new)][np.cumsum(new) - 1]
            items, node = items[~new], node[~new]
            parent[items] = node
            edge[items] = np.bitwise_count(values[items] ^ values[node])
            by = np.lexsort((items, edge[items], node))
            items = items[by]
            cell = node[by] * 65 + edge[items]
        children = np.flatnonzero(parent >= 0)
        key = parent[children] * 65 + edge[children]
        by = np.argsort(key, kind="stable")
        self.children, self.key = children[by], key[by]

    def links(self, group: np.ndarray, radius: int, block: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of nodes of one tree within the radius, in blocks; each value queries its tree."""
        for a in range(0, len(self.values), block):
            queries = np.arange(a, min(a + block, len(self.values)))
            waiting = [(queries, self.roots[group[queries]])]
            while waiting:
                query, node = waiting.pop()
                if len(query) > block:
                    waiting.append((query[block:], node[block:]))
                    query, node = query[:block], node[:block]
                self.visited += len(query)
                d = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
                near = (d <= radius) & (query != node)
                if near.any():
                    yield query[near], node[near]
                low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
                high = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right")
                more = high - low
                if more.any():
                    waiting.append((query.repeat(more), self.children[expand(low, more)]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of a and b; a label is the smallest node of its class."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _shard_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column("fp").to_numpy(zero_copy_only=False) for b in batches if b.num_rows]
        if not found:
            return
        fp = np.unique(np.concatenate(found))
        one = np.zeros(len(fp), np.int64)
        forest, label = BKForest(fp, one), np.arange(len(fp))
        for a, b in forest.links(one, radius):
            label = _merge(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["u", "v"])
    return run


def _masks(bits: list[int], parts: int) -> list[int]:
    """``bits`` dealt into neighbouring blocks, as signed 64-bit masks."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    masks = [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def fingerprint_links(distinct: DataFrame, radius: int, part_rows: int = 32_768) -> DataFrame:
    """Spanning links (u, v) between the distinct values of column ``fp`` within the radius."""
    parts = radius + 1
    first = _masks(list(range(64)), parts)
    second = [_masks([b for b in range(64) if not (m >> b) & 1], parts) for m in first]

    def values(masks):
        return F.array(*(F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for n, m in enumerate(masks)))

    rows = distinct.select("fp", F.explode(values(first)).alias("x")).select("fp", F.col("x.n").alias("t"), F.col("x.v").alias("k"))
    hot = rows.groupBy(F.col("t").alias("ht"), F.col("k").alias("hk")).count().where(F.col("count") > part_rows)
    rows = rows.join(hot, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left")
    again = F.coalesce(*(F.when(F.col("t") == t, values(masks)) for t, masks in enumerate(second)))
    whole = F.array(F.struct(F.lit(-1).alias("n"), F.lit(0).cast("long").alias("v")))
    keyed = rows.select("fp", "t", "k", F.explode(F.when(F.col("count").isNull(), whole).otherwise(again)).alias("x"))
    n = max(1, -(-distinct.count() * parts // part_rows))
    n = max(n, min(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), 64))
    ranges = keyed.select("fp", "t", F.col("x.n").alias("n"), "k", F.col("x.v").alias("v")).repartitionByRange(n, "t", "n", "k", "v")
    return ranges.select("fp").mapInArrow(_shard_links(radius), "u long, v long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (u, v): the smallest node of its component.

    Alternates large-star and small-star steps; both are a grouped minimum and a
    join, so a node with very many links is combined before the exchange and
    split by the adaptive join."""
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), name)
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        after = stored(small, name)
        sign = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        if after.agg(*sign).first() == edges.agg(*sign).first():
            roots = after.select("v").distinct()
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
        edges = after


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                   radius: int = 2) -> DataFrame:
    """One row per row of ``df``: id, content (hash of the text), fp and component_id (the
    smallest id reachable over links of at most ``radius`` differing bits)."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("content"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    rows = stored(rows.mapInArrow(_fingerprint(width), "id long, content long, fp long"), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    found = components(fingerprint_links(distinct.select("fp"), radius), "simhash-components")
    classes = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    classes = stored(classes, "simhash-classes")
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "content", "fp", "component_id")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    return simhash_groups(df, id_col, text_col, width, radius).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_distinct_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                            radius: int = 2) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are: of each component one row with the smallest id.

    Rows are told apart by id and text; several such rows with the smallest id of
    one component are reduced to one."""
    groups = stored(simhash_groups(df, id_col, text_col, width, radius), "simhash-groups")
    keeps = groups.where(F.col("id").eqNullSafe(F.col("component_id")))
    one = keeps.groupBy(F.col("component_id").alias("c")).agg(F.min("content").alias("least"))
    keeps = keeps.join(one, F.col("component_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("least")))
    kid, kcontent, n, content = (unused(df, x) for x in ("kept_id", "kept_content", "n", "content"))
    keys = keeps.groupBy(F.col("id").alias(kid), F.col("content").alias(kcontent)).agg(F.count(F.lit(1)).alias(n))
    keyed = df.withColumn(content, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = keyed.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col(kid)) & (F.col(content) == F.col(kcontent)))
    single = rows.where(F.col(n) == 1).select(*df.columns)
    repeated = rows.where(F.col(n) > 1).dropDuplicates([id_col, content]).select(*df.columns)
    return single.unionByName(repeated)
