"""How filters interact, for every order they can be applied in.

Five filters judge every whole text by themselves; a document's answers are the
five bits of a mask.  Per part (language) the documents are counted by mask, so a
part is a tensor of 2 x 2 x 2 x 2 x 2 counts, one axis for each filter (0 pass,
1 fail).  Every count of the report is a contraction of that tensor: for each step
of each of the 120 orders a vector per axis selects pass, fail or all, and one
einsum gives the steps of all orders.  The whole corpus is read once; what is
left per part are 32 cells, however many documents it has.

One Arrow pass takes the four filters that a text answers by itself and its SHA-256
digest.  The fifth (a copy of a text with a smaller id) is an exact minimum per
digest, combined before the exchange; a document passes if (digest, id) is such a
minimum, a join on both columns, so that a digest with a third of all rows stays
in no single task.

Edge cases: NULL text is empty, NULL part is the empty string.  A row without id is
no copy of another, makes none of another, and has no label.  Rows equal in id and
text are told apart nowhere: none has a smaller id than the other.  A text under two
ids fails at the larger one.  A document with several label rows is good (toxic) if
one of them says so; NULL labels say nothing.  Very long texts are one value in one
task, batches hold about 8 MB of text.  The report has no ties to break.  Further
columns, whatever their names, are not read; an empty table gives an empty report.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored

FILTERS = "ABCDE"
_UPPER = bytes(range(0x41, 0x5B))
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"
_COUNTS = ("documents", "good", "toxic")
_OUTPUT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()                # on bytes: exactly the white space of the contract
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * upper > 10 * points) << 2
            | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "bytes"):
        texts = batch.column("bytes").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("part"), pa.array([text_mask(t) for t in texts], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["id", "part", "mask", "digest"])


def cells(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask (bit i: filter i fails) and the documents, good and toxic ones among them."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    rows = stored(rows.mapInArrow(_masks, "id long, part string, mask int, digest binary"), "audit-rows")
    known = rows.where("id is not null")
    firsts = known.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        *(F.max((F.col(c) == 1).cast("long")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    judged = known.join(firsts, ["digest", "id"], "left").join(said, "id", "left").select(
        "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask"), "good", "toxic")
    judged = judged.unionByName(rows.where("id is null").select(
        "part", "mask", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")))
    return judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def _selectors(n: int) -> dict[str, np.ndarray]:
    """For each step of each order a vector per axis: (steps, axes, 2)."""
    orders = np.array(list(permutations(range(n))))
    place = np.argsort(orders, axis=1)                      # of each filter in each order
    place = place[:, None, :].repeat(n, axis=1)             # (order, step, filter)
    step = np.arange(n)[None, :, None]
    passes, fails, every = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

    def pick(passing: np.ndarray, failing: np.ndarray) -> np.ndarray:
        out = np.where(passing[..., None], passes, np.where(failing[..., None], fails, every))
        return out.reshape(-1, n, 2).astype(np.int64)
    here = place == step
    none = np.zeros_like(here)
    return {"kept": pick(place <= step, none), "removed": pick(place < step, here), "failing": pick(none, here),
            "unique_fails": pick(~here, here)}


def _contract(tensor: np.ndarray, selector: np.ndarray) -> np.ndarray:
    return np.einsum("abcde,sa,sb,sc,sd,se->s", tensor, *(selector[:, i] for i in range(5)))


def interactions(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of all steps of all orders of one part; ``tensors``: documents, good and toxic ones."""
    documents, good, toxic = tensors
    select = _selectors(documents.ndim)
    out = {name: _contract(documents, select[name]) for name in ("kept", "removed", "failing", "unique_fails")}
    out["redundant"] = out.pop("failing") - out["removed"]
    out["good_lost"], out["toxic_lost"] = (_contract(t, select["removed"]) for t in (good, toxic))
    filters = np.array(list(permutations(range(documents.ndim)))).ravel()
    sums = np.zeros(documents.ndim, np.int64)
    np.add.at(sums, filters, out["removed"])
    out["shapley"] = sums[filters]
    return out


def _report(table: pa.Table) -> pa.Table:
    tensors = np.zeros((len(_COUNTS), 1 << len(FILTERS)), np.int64)
    mask = table.column("mask").to_numpy()
    for k, name in enumerate(_COUNTS):
        np.add.at(tensors[k], mask, table.column(name).to_numpy())
    # bit i of the mask is filter i, so the last axis of the reshaped counts is the first filter
    tensors = tensors.reshape(len(_COUNTS), *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
    found = interactions(tensors)
    orders = ["".join(p) for p in permutations(FILTERS)]
    n = len(orders) * len(FILTERS)
    return pa.table({
        "part": pa.array([table.column("part")[0].as_py()] * n, pa.string()),
        "filter_order": pa.array([o for o in orders for _ in FILTERS]),
        "step": pa.array(list(range(1, len(FILTERS) + 1)) * len(orders), pa.int32()),
        **{name: pa.array(found[name], pa.int64()) for name in _OUTPUT}})


def filter_audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of the module's text."""
    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in _OUTPUT)
    return cells(df, labels, id_col, text_col, part_col).groupBy("part").applyInArrow(_report, schema)
