"""Secret scan with corpus-wide ownership frequency.

Every text is searched for assignments, access keys, hexadecimal runs (the base
spans) and for other long mixed tokens.  The value of each find is a candidate;
its hash is counted over the corpus by distinct repositories and owners.  Owners
come first: what one owner alone has is that owner's, however often it is copied there.
What few owners have looks like a live credential only while few repositories have it;
what many have is a copied example.  Without a column of repositories every distinct text
is one, so copies of a document do not count again.  Live candidates add a span of kind
``live`` over the value.

The scan runs once and stores numbers and hashes only.  Counts are combined
before the exchange; what is joined back is dealt by hash and place of the find, as a
candidate of one owner may be in a third of all rows.

Edge cases: NULL text is empty; a NULL owner or repository counts as one owner
or repository of its own; repeated rows are scanned one by one; empty tables
give empty results.  Very long texts are one value in one task; of spans that start together the
shorter kind number comes first; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Parts that the finds of one candidate are dealt into.
_DEALT = 32
KINDS = ("assign", "access", "hex", "live")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_ASSIGN = re.compile("(" + "|".join(map(_either_case, _KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")                # all of a run or nothing: same as dropping shorter runs
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_STARTS = (b"passw", b"secret", b"token", b"api")
_AS_HEX = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_AS_TOKEN = bytes(120 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/_-") else 32 for i in range(256))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of assignments, access keys and hexadecimal runs, by start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def looks_random(value: str) -> bool:
    """A long token of several kinds of characters, spread as in random strings."""
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit))
    counts = Counter(value).values()
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    return kinds == 3 and entropy >= 3.5


def scan(raw: bytes) -> tuple[list, list]:
    """The base spans and the candidates (start, end, value) of a text."""
    low = raw.lower()
    runs = raw.translate(_AS_TOKEN)
    if not (any(x in low for x in _STARTS) or b"AKIA" in raw or b"x" * 20 in runs or b"x" * 24 in raw.translate(_AS_HEX)):
        return [], []
    text = raw.decode("utf-8", "surrogateescape")
    base = base_spans(text)
    candidates = {}
    for start, kind, end, value in base:
        at = text.rindex(value, start, end) if kind == 0 else start
        candidates[at, at + len(value)] = value
    for m in _TOKEN.finditer(text):
        inside = any(a <= m.start() < b or a < m.end() <= b for a, b in candidates)
        if not inside and looks_random(m[0]):
            candidates[m.start(), m.end()] = m[0]
    return base, [(a, b, v) for (a, b), v in sorted(candidates.items())]


_FOUND = ("doc_id long, owner string, repo string, base array<struct<start:long,kind:int,end:long>>, base_sha256 string, "
          "candidates array<struct<start:long,end:long,hash:long>>, task int, row long")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, row = TaskContext.get().partitionId(), 0
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("hash", pa.int64())]))
    for batch in batches:
        bases, digests, candidates = [], [], []
        for raw in batch.column(3):
            base, found = scan(raw.as_buffer().to_pybytes())
            bases.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in base])
            joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in base)
            digests.append(hashlib.sha256(joined.encode()).hexdigest())
            candidates.append([{"start": a, "end": b, "hash": xxhash.xxh3_64_intdigest(v.encode()) - (1 << 63)} for a, b, v in found])
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(bases, base_type), pa.array(digests, pa.string()),
             pa.array(candidates, found_type), pa.array(np.full(n, task), pa.int32()), pa.array(np.arange(row, row + n))],
            ["doc_id", "owner", "repo", "base", "base_sha256", "candidates", "task", "row"])
        row += n


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_found) from rows (hash, owner, repo)."""
    owner, repo = (F.to_json(F.struct(c)) for c in ("owner", "repo"))     # NULL is a value of its own
    return candidates.groupBy("hash").agg(F.count_distinct(owner).alias("n_owners"), F.count_distinct(repo).alias("n_repos"),
                                          F.count(F.lit(1)).alias("n_found"))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None,
                 max_owners: int = 2, max_repos: int = 8) -> DataFrame:
    """One row per row of ``df``: doc_id, n_assign, n_access, n_hex, base_sha256, n_candidates,
    n_live, found (array of start, kind, end, with the live spans) and spans (the same as text).

    A candidate is live if one owner has it, or at most ``max_owners`` owners and ``max_repos`` repositories
    (distinct texts where ``repo_col`` is None)."""
    repo = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if repo_col is None else F.col(repo_col)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                     repo.cast("string").alias("repo"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    rows = stored(rows.mapInArrow(_scan, _FOUND), "secret-finds")
    each = rows.select("task", "row", "owner", "repo", F.explode("candidates").alias("c")).select("task", "row", "owner", "repo", "c.*")
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    live = ownership(each).where((F.col("n_owners") == 1) | few).select(
        "hash", F.explode(F.sequence(F.lit(0), F.lit(_DEALT - 1))).alias("dealt"))
    each = each.withColumn("dealt", F.pmod(F.xxhash64("task", "row"), F.lit(_DEALT)).cast("int"))
    span = F.struct("start", F.lit(KINDS.index("live")).alias("kind"), "end")
    # however many candidates are live, they are never broadcast
    added = each.join(live.hint("merge"), ["hash", "dealt"]).groupBy("task", "row").agg(F.collect_list(span).alias("live"))
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    out = rows.join(added, ["task", "row"], "left").withColumn("found", F.sort_array(F.concat("base", F.coalesce("live", none))))

    def count(kind: int):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    names = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
    return out.select("doc_id", *map(count, range(3)), "base_sha256", F.size("candidates").cast("long").alias("n_candidates"),
                      count(3), "found", spans.alias("spans"))
