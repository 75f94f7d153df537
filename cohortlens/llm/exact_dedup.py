"""Exact deduplication by Grace hash partitioning.

1. Each map task keeps its rows' distinct contents in an open-addressing table
   and passes on one row per distinct content with its count and smallest id, so
   a text that a third of all rows share is at most a few rows per task.
2. The exchange deals these rows out by content hash.  A task that gets more
   than ``budget`` bytes writes them to spill files by the next bits of the hash
   and takes up one file after the other, again by further bits where needed,
   until a bucket fits an open-addressing table; entries are equal only when the
   complete contents are.  Spill files go to the task's temporary folder and are
   removed with it; a lost task is simply run again.
3. The classes (digest, id that stays, size) are joined to the rows by digest.

Texts are compared after replacing each run of white space (space, U+0009 to
U+000D) by one space; NULL text is empty.  Of equal texts the row with the
smallest id stays; NULL ids come last.  Rows that repeat an id with an equal
text are one document for ``kept`` (all of them have it); ``distinct_documents``
leaves one of them.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, parts_for, text_bytes, unused

_ROWS = pa.schema([("h", pa.int64()), ("content", pa.large_binary()), ("first", pa.int64()), ("of_first", pa.int64()),
                   ("n", pa.int64())])
_FANOUT_BITS = 4


class OpenTable:
    """Open addressing with linear probing over complete contents: for each distinct
    content the smallest id, how many rows have that id, and how many have the content."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes, self.contents, self.first, self.of_first, self.n, self.bytes = [], [], [], [], [], 0

    def _slot(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (entry := self.slots[at]) >= 0 and not (self.hashes[entry] == h and self.contents[entry] == content):
            at = (at + 1) & mask
        return at

    def add(self, h: int, content: bytes, first: int | None, of_first: int, n: int) -> None:
        at = self._slot(h, content)
        entry = self.slots[at]
        if entry < 0:
            self.slots[at] = len(self.hashes)
            for column, value in zip((self.hashes, self.contents, self.first, self.of_first, self.n),
                                     (h, content, first, of_first, n)):
                column.append(value)
            self.bytes += len(content)
            if 2 * len(self.hashes) > len(self.slots):
                self.slots = [-1] * (2 * len(self.slots))
                for i, (old, text) in enumerate(zip(self.hashes, self.contents)):
                    self.slots[self._slot(old, text)] = i
            return
        self.n[entry] += n
        known = self.first[entry]
        if first == known:
            self.of_first[entry] += of_first
        elif known is None or (first is not None and first < known):
            self.first[entry], self.of_first[entry] = first, of_first

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((self.hashes, self.contents, self.first, self.of_first, self.n), _ROWS.types)],
            schema=_ROWS)


def _partial(budget: int):
    """Map side: one row per distinct content among some rows of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        for batch in batches:
            for i, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_py()
                table.add(xxhash.xxh3_64_intdigest(content) - (1 << 63), content, i, 1, 1)
                if table.bytes > budget:
                    yield table.rows()
                    table = OpenTable()
        if table.hashes:
            yield table.rows()
    return run


def _leaves(batches: Iterator[pa.RecordBatch], budget: int, folder: str, level: int = 0) -> Iterator[OpenTable]:
    """The tables of the recursively partitioned rows."""
    table, spill, fanout = OpenTable(), {}, 1 << _FANOUT_BITS
    for batch in batches:
        if not spill:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                table.add(*row)
            if table.bytes > budget and _FANOUT_BITS * (level + 1) < 60:
                batch, table = table.rows(), None      # the distinct contents so far go to the files too
                for part in range(fanout):
                    path = os.path.join(folder, f"{level}-{part}-{os.urandom(6).hex()}")
                    sink = pa.OSFile(path, "wb")
                    spill[part] = path, sink, pa.ipc.new_stream(sink, _ROWS)
            else:
                continue
        h = batch.column(0).to_numpy().view(np.uint64)
        part = (h >> np.uint64(64 - _FANOUT_BITS * (level + 1))) & np.uint64(fanout - 1)
        for p in np.unique(part).tolist():
            spill[p][2].write_batch(batch.filter(pa.array(part == p)))
    if not spill:
        yield table
        return
    for path, sink, writer in spill.values():
        writer.close()
        sink.close()
    for path, _, _ in spill.values():
        with pa.OSFile(path) as source, pa.ipc.open_stream(source) as reader:
            yield from _leaves(iter(reader), budget, folder, level + 1)
        os.remove(path)


def _grace(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = tempfile.mkdtemp()
        try:
            casted = (pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(b.columns, _ROWS.types)], schema=_ROWS)
                      for b in batches)
            for table in _leaves(casted, budget, folder):
                if table.hashes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([hashlib.sha256(c).hexdigest() for c in table.contents], pa.string()),
                         pa.array(table.first, pa.int64()), pa.array(table.of_first, pa.int64()),
                         pa.array(table.n, pa.int64())], ["text_sha256", "keep_id", "n_keep", "group_size"])
        finally:
            shutil.rmtree(folder, ignore_errors=True)
    return run


def _content(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ").cast("binary")


def equal_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 16 << 20,
                budget: int = 64 << 20) -> DataFrame:
    """One row per distinct text: text_sha256, keep_id, n_keep (rows with that id), group_size."""
    n = parts_for(text_bytes(df, text_col), part_bytes)
    rows = df.select(F.col(id_col).cast("long").alias("id"), _content(text_col).alias("content"))
    partial = rows.mapInArrow(_partial(budget // 2), "h long, content binary, first long, of_first long, n long")
    return partial.repartition(n, "h").mapInArrow(
        _grace(budget), "text_sha256 string, keep_id long, n_keep long, group_size long")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(_content(text_col), 256).alias("text_sha256"))
    return rows.join(equal_texts(df, id_col, text_col, **options), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def distinct_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are: one of each class of equal texts."""
    digest, kept, several = (unused(df, x) for x in ("digest", "kept", "several"))
    classes = equal_texts(df, id_col, text_col, **options).select(
        F.col("text_sha256").alias(digest), F.col("keep_id").alias(kept), (F.col("n_keep") > 1).alias(several))
    rows = df.withColumn(digest, F.sha2(_content(text_col), 256)).join(classes, digest).where(
        F.col(id_col).cast("long").eqNullSafe(F.col(kept)))
    single = rows.where(~F.col(several)).select(*df.columns)
    repeated = rows.where(F.col(several)).dropDuplicates([digest]).select(*df.columns)
    return single.unionByName(repeated)

