"""Suffix-array, exact and SimHash deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from cohortlens.llm import exact_dedup, simhash, suffix_dedup
from conftest import SF001
from frames import awkward, empty, frame


def brute_suffix(rows, length=50):
    """[(doc_id, n_bytes, n_removed, n_spans, sha)] of rows (doc_id, text)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w, key = b[k:k + length], float("inf") if i is None else i
            first[w] = min(first.get(w, float("inf")), key)
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), float("inf") if i is None else i
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < key:
                cover[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if cover[k] and not (k and cover[k - 1]))
        kept = bytes(c for c, m in zip(b, cover) if not m)
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [2_000, 8 << 20])
def test_suffix_dedup_awkward(spark, bucket):
    got = suffix_dedup.suffix_dedup(frame(spark), bucket_bytes=bucket, shard_bytes=bucket)
    rows = [tuple(r)[:5] for r in got.collect()]
    assert sorted(rows, key=repr) == brute_suffix([(r[0], r[1]) for r in awkward()])
    for r in got.collect():
        assert sum(b - a for a, b in zip(r["starts"], r["ends"])) == r["n_removed"] and len(r["starts"]) == r["n_spans"]


def test_suffix_dedup_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = suffix_dedup.suffix_dedup(docs, bucket_bytes=60_000, shard_bytes=20_000)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute_suffix(
        [(r["doc_id"], r["text"]) for r in docs.collect()])


def hot_rows(n=300):
    """A phrase of 30 bytes in ever different surroundings, some of them twice."""
    rng, phrase = random.Random(8), " all rights reserved, see page "
    side = lambda: "".join(rng.choice("abcdefgh ") for _ in range(70))
    texts = [side() + phrase + side() for _ in range(n)]
    texts += [side() + t[40:130] + side() for t in texts[::10]] + [side() + t[60:115] for t in texts[::15]]
    texts += ["-" * rng.randrange(60, 90) + side() for _ in range(n)]
    return [(i, t, "en", "s", len(t), "c", "f", "n", "i") for i, t in enumerate(texts)]


@pytest.mark.parametrize("bucket,shard", [(8_000, 4_000), (1 << 20, 4_000), (8_000, 400)])
def test_suffix_dedup_hot_anchor(spark, bucket, shard):
    rows = hot_rows() + awkward()
    got = suffix_dedup.suffix_dedup(frame(spark, rows), bucket_bytes=bucket, shard_bytes=shard)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute_suffix([(r[0], r[1]) for r in rows])


def test_suffix_dedup_spreads_a_hot_anchor(spark, monkeypatch, tmp_path):
    original = suffix_dedup._sort_shard

    def watched(length):
        run = original(length)

        def measured(key, group):
            (tmp_path / str(key[0].as_py())).write_text(str(sum(map(len, group.column("bytes").to_pylist()))))
            return run(key, group)
        return measured
    monkeypatch.setattr(suffix_dedup, "_sort_shard", watched)
    rows = [r for r in hot_rows(3000) if "-" not in r[1]]
    suffix_dedup.suffix_dedup(frame(spark, rows), bucket_bytes=100_000, shard_bytes=20_000).collect()
    sizes = sorted(int(f.read_text()) for f in tmp_path.iterdir())
    assert len(sizes) > 8 and sizes[-1] < 4 * sum(sizes) / len(sizes), sizes


def test_suffix_dedup_rows_grow_with_the_corpus(spark):
    """A bucket has a row for each lane and not for each shard, and its texts and segments go compressed."""
    rng, shards = random.Random(5), 9000
    texts = [" ".join(f"word{rng.randrange(300)}" for _ in range(400)).encode() for _ in range(60)]
    batch = pa.record_batch({"bucket": [4] * 120, "id": list(range(120)), "bytes": texts * 2})
    docs = pa.Table.from_batches(list(suffix_dedup._squeeze([batch])))
    keys = suffix_dedup._emit_keys(shards, 50)((pa.scalar(4),), docs)
    answers = []
    for lane in keys.column("lane").unique():
        answers.append(suffix_dedup._repeated_keys(50, 1 << 20)((lane,), keys.filter(pc.equal(keys.column("lane"), lane))))
    sent = suffix_dedup._emit_segments(shards, 50)((pa.scalar(4),), docs, pa.concat_tables(answers))
    assert 500 < len(keys) == len(set(keys.column("lane").to_pylist())) <= 1024 and len(sent) <= 1024
    size = lambda t: sum(map(len, t.column("bytes").to_pylist()))
    raw = sum(len(x) for value in sent.column("bytes").to_pylist() for r in suffix_dedup._unpacked(value) for x in r[1:] if x)
    assert size(docs) < 0.6 * 2 * sum(map(len, texts)) and size(sent) < 0.7 * raw
    rows = [r for r in hot_rows(100) if r[1][0] != "-"] + awkward()
    got = suffix_dedup.suffix_dedup(frame(spark, rows), bucket_bytes=40_000, shard_bytes=80)
    assert sum(len((r[1] or "").encode()) for r in rows) > 1024 * 80
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute_suffix([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("values", [[], [0], [7, 7, 300], [0, 1, 1 << 16, (1 << 32) - 1]])
def test_planes(values):
    x = np.array(values, np.uint32)
    assert suffix_dedup._from_planes(suffix_dedup._planes(x)).tolist() == values


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("block,budget", [(5, 50), (64, 1000), (1 << 15, 4_000_000)])
def test_equal_suffixes(block, budget):
    rng, original = random.Random(block), suffix_dedup.equal_suffixes
    for _ in range(15):
        cap, alphabet = rng.choice([3, 8, 20, 50]), rng.choice(["ab", "abcde"])
        base = "".join(rng.choice(alphabet) for _ in range(800)) + "a" * 90 + "b" * 70
        pieces = {base[i:i + rng.randint(cap, 90)].encode() for i in (rng.randrange(900) for _ in range(60))}
        pieces = [p for p in pieces if len(p) >= cap]
        least, expected = np.arange(len(pieces))[::-1].copy(), {}
        for p, x in zip(pieces, least):
            for i in range(len(p) - cap + 1):
                expected[p[i:i + cap]] = min(expected.get(p[i:i + cap], 10_000), x)
        suffix_dedup.equal_suffixes = lambda t, c: original(t, c, budget=budget, block=block)
        try:
            starts, _, best = suffix_dedup.smaller_windows(pieces, least, cap)
        finally:
            suffix_dedup.equal_suffixes = original
        for p, a in zip(pieces, starts):
            for i in range(len(p) - cap + 1):
                assert best[a + i] == expected[p[i:i + cap]]


def brute_exact(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, s in norm:
        groups.setdefault(s, []).append(i)
    out = []
    for i, s in norm:
        keep = min((x for x in groups[s] if x is not None), default=None)
        out.append((i, keep, len(groups[s]), i == keep, hashlib.sha256(s.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [1_000, 64 << 20])
def test_exact_dedup(spark, budget):
    got = exact_dedup.exact_dedup(frame(spark), part_bytes=20_000, budget=budget)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_exact([(r[0], r[1]) for r in awkward()])
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_distinct_documents(spark):
    df = frame(spark)
    kept = exact_dedup.distinct_documents(df)
    assert kept.columns == df.columns
    expected = {(r[1], r[4]) for r in brute_exact([(r[0], r[1]) for r in awkward()])}
    got = [(r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert exact_dedup.distinct_documents(empty(spark)).count() == 0


def test_open_table_grows_and_compares_contents():
    table = exact_dedup.OpenTable()
    for i in range(3000):
        table.add(i % 1500 % 7, b"%d" % (i % 1500), i, 1, 1)          # few hashes: contents decide
    assert len(table.contents) == 1500 and set(table.n) == {2} and table.first[:3] == [0, 1, 2]


def brute_fingerprint(text, width=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=2):
    """{fp: smallest fp reachable}."""
    left, root = set(fps), {}
    for f in sorted(fps):
        if f in root:
            continue
        stack = [f]
        left.discard(f)
        while stack:
            x = stack.pop()
            root[x] = f
            near = [y for y in left if (x ^ y).bit_count() <= radius]
            left.difference_update(near)
            stack.extend(near)
    return root


def brute_simhash(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root, least = brute_components(set(fps)), {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fps)), key=repr)


def near_rows():
    rng = random.Random(9)
    rows, base = [], [f"w{rng.randrange(300)}" for _ in range(600)]
    for i in range(60):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"x{i}"
        rows.append((100 + i, " ".join(own), "en", "s", 0, "c", "f", "n", "i"))
    return rows


def test_simhash(spark):
    rows = awkward() + near_rows()
    got = simhash.simhash_dedup(frame(spark, rows))
    expected = brute_simhash([(r[0], r[1]) for r in rows])
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert len({r[2] for r in expected if r[0] is not None and r[0] >= 100}) < 40      # there are near copies
    assert simhash.simhash_dedup(empty(spark)).count() == 0
    kept = simhash.near_distinct_documents(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    components = {r[2] for r in expected}
    assert sorted(ids, key=repr) == sorted(components, key=repr)
    assert simhash.near_distinct_documents(empty(spark)).count() == 0


def test_bk_links_and_components(spark):
    rng = random.Random(4)
    values = {0, 2**64 - 1}
    for _ in range(40):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randrange(6)):
            for _ in range(rng.randrange(4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, part_rows=50)
    root = brute_components(values)
    found = {r["node"] % 2**64: r["root"] for r in simhash.components(links).collect()}
    classes = {}
    for v in values:
        classes.setdefault(root[v], set()).add(v)
    for members in classes.values():
        assert len({found.get(m) for m in members}) == 1
        assert (len(members) == 1) == (found.get(next(iter(members))) is None)
    chain = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(900, 901)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(chain).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def _clusters(found):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for u, v in found:
        a, b = top(u), top(v)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(root)}


@pytest.mark.parametrize("part_rows,radius", [(32_768, 2), (40, 2), (40, 1), (40, 3)])
def test_fingerprint_links_with_small_and_large_trees(spark, part_rows, radius):
    """Also block values with more rows than a tree should have: a group that shares most of its bits."""
    from cohortlens.llm.simhash import fingerprint_links
    rng = np.random.default_rng(3)
    far = rng.integers(-2**63, 2**63 - 1, 300)
    middle = rng.integers(-2**63, 2**63 - 1)
    near = [int(middle)]
    for _ in range(250):
        flip = 0
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            flip |= 1 << int(b)
        near.append(int(np.uint64(near[rng.integers(len(near))] & (2**64 - 1)) ^ np.uint64(flip)))
    fp = np.unique(np.array([*far.tolist(), *(v - 2**64 if v >= 2**63 else v for v in near)], np.int64))
    df = spark.createDataFrame([(int(v),) for v in fp], "fp long")
    got = _clusters((r.u, r.v) for r in fingerprint_links(df, radius, part_rows).collect())
    u = fp.view(np.uint64)
    d = np.bitwise_count(u[:, None] ^ u[None, :])
    a, b = np.nonzero(np.triu(d <= radius, 1))
    want = _clusters(zip(fp[a].tolist(), fp[b].tolist()))
    assert got == want and len(want) > 20


def test_a_query_meets_a_small_part_of_its_tree():
    from cohortlens.llm.simhash import BKForest
    fp = np.unique(np.random.default_rng(4).integers(-2**63, 2**63 - 1, 20_000))
    one = np.zeros(len(fp), np.int64)
    forest = BKForest(fp, one)
    list(forest.links(one, 2))
    assert forest.visited < 0.1 * len(fp) ** 2
