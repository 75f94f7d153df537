"""Filter audit, source divergence and nearest neighbours against brute force."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import filter_audit, neighbours, queries, source_audit
from conftest import SF001
from frames import awkward, empty, frame

LABELS = "doc_id long, quality int, toxic int"


def failed(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(k for k, x in (("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
                                  ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
                                  ("D", bool(re.search("[#$%&*|]", text)))) if x)


def brute_audit(rows, labels):
    """Plays every order through, document by document."""
    first, good, toxic = {}, set(), set()
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    for doc_id, q, t in labels:
        if doc_id is not None:
            good |= {doc_id} if q == 1 else set()
            toxic |= {doc_id} if t == 1 else set()
    docs = {}
    for r in rows:
        copy = r[0] is not None and first[r[1] or ""] < r[0]
        docs.setdefault(r[2] or "", []).append((failed(r[1]) + "E" * copy, r[0] in good, r[0] in toxic))
    out = []
    for part, members in docs.items():
        removed_by, own = Counter(), []
        for order in permutations("ABCDE"):
            left, gone = members, []
            for step, f in enumerate(order, 1):
                out_now = [m for m in left if f in m[0]]
                redundant = sum(f in m[0] for m in gone)
                left = [m for m in left if f not in m[0]]
                gone = gone + out_now
                removed_by[f] += len(out_now)
                own.append((f, [part, "".join(order), step, len(left), len(out_now), redundant, sum(m[0] == f for m in members),
                                sum(m[1] for m in out_now), sum(m[2] for m in out_now)]))
        out += [tuple(row + [removed_by[f]]) for f, row in own]
    return sorted(out)


def audit_rows():
    rows = awkward()
    rng = np.random.default_rng(5)
    for i in range(60):         # every mix of failures
        n, vocabulary, upper = int(rng.integers(90, 130)), [40, 4000][i // 4 % 2], [.1, .9][i // 8 % 2]
        words = [f"w{rng.integers(vocabulary)}" for _ in range(n)]
        text = " ".join(w.upper() if rng.random() < upper else w for w in words) + (" #" if rng.random() < .3 else "")
        rows += [(100 + 3 * i + k, text, ["en", "fr"][i % 2], "s", 0, "c", "f", "n", "i") for k in range(1 + i % 3)]
    return rows


AUDIT_LABELS = [(i, i % 2, (i // 2) % 2) for i in range(0, 280, 3)] + [(3, 1, 1), (3, None, 0), (None, 1, 1), (9999, 1, 1)]


def test_filter_audit(spark):
    rows = audit_rows()
    got = filter_audit.filter_audit(frame(spark, rows), spark.createDataFrame(AUDIT_LABELS, LABELS)).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, AUDIT_LABELS)
    assert {len(failed(r[1])) for r in rows} >= {0, 1, 2, 3}


def test_filter_audit_without_rows_or_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(empty(spark), none).count() == 0
    rows = awkward()[:7]
    got = filter_audit.filter_audit(frame(spark, rows), none).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, [])


def test_filter_limits():
    text = " ".join(f"w{i}" for i in range(100))
    assert filter_audit.text_mask(text.encode()) == 0 and filter_audit.text_mask(text[4:].encode()) == 1
    twice = " ".join(["w0"] * 21 + [f"v{i}" for i in range(79)])        # 80 distinct of 100
    assert filter_audit.text_mask(twice.encode()) == 0 and filter_audit.text_mask(b"w0 " + twice.encode()) == 2
    upper = " ".join(["Xßßßßßßßß"] * 50 + [f"y{i}ßßßßßßßß" for i in range(50)])
    assert (filter_audit.text_mask(upper.encode()) & 4 > 0) == (100 * 50 > 10 * len(upper))
    assert filter_audit.text_mask(b"A") & 4 and not filter_audit.text_mask(b"") & 4 and filter_audit.text_mask(b"|") & 8


def test_large_counts_stay_exact():
    tensors = np.zeros((3, 2, 2, 2, 2, 2), np.int64)
    tensors[0, 1, 0, 0, 0, 0], tensors[0, 0, 0, 0, 0, 0] = (1 << 55) + 1, 7
    found = filter_audit.interactions(tensors)
    assert found["removed"][0] == (1 << 55) + 1 and found["shapley"][0] == 120 * ((1 << 55) + 1) and found["kept"][0] == 7


def tokens(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_divergence(rows, least, top):
    counts, documents, sources = {}, {}, {}
    for r in rows:
        lang, source, w = r[2] or "", r[3] or "", tokens(r[1])
        counts.setdefault((lang, source), Counter()).update(w)
        documents.setdefault(lang, Counter()).update(set(w))
        sources.setdefault(lang, set()).add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in documents[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1000000000 * (count[t] + 5) // total for t in kept}
        p = {s: shares(counts[lang, s]) for s in names}
        q = shares(sum((counts[lang, s] for s in names), Counter()))
        for s in names:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in names if o != s]
            more = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", more)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def audit_sources():
    rng = np.random.default_rng(11)
    rows = awkward()
    for i in range(150):
        text = " ".join(f"{'Aé漢' if rng.random() < .1 else 'v'}{chr(97 + rng.integers(26))}" for _ in range(rng.integers(1, 60)))
        rows.append((1000 + i, text, ["en", "fr", None][i % 3], f"s{rng.integers(7)}", 0, "c", "f", "n", "i"))
    return rows + [(2000, None, "xx", "only", 0, "c", "f", "n", "i"), (2001, "...", "yy", "a", 0, "c", "f", "n", "i"),
                   (2002, "one", "yy", "b", 0, "c", "f", "n", "i")]


@pytest.mark.parametrize("options", [{}, {"tile": 3, "block_terms": 8, "held": 20}])
def test_source_divergence(spark, options):
    rows = audit_sources()
    got = source_audit.source_divergence(frame(spark, rows), least_documents=4, top=6, **options).collect()
    expected = brute_divergence(rows, 4, 6)
    assert sorted(tuple(r) for r in got) == expected
    assert {r[0] for r in expected} == {"en", "fr", "", "yy"}        # "xx" has one source and no terms


def test_source_divergence_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    got = queries.op13_source_divergence(spark, SF001).collect()
    assert sorted(tuple(r) for r in got) == brute_divergence(rows, 30, 50)
    assert source_audit.source_divergence(empty(spark)).count() == 0


def test_tokenizer():
    text = "Ab_c9d\tÉté—x\x1cY\x00z\x7fq"
    assert source_audit.terms(text.encode()) == [t.encode() for t in tokens(text)] == [t.encode() for t in ("ab", "c", "d", "Été—x", "y", "z", "q")]


def test_shares_beyond_double(spark):
    big = spark.createDataFrame([(10 ** 15 + 7, 3 * 10 ** 17 + 1, 10 ** 7)], "n long, total long, v long")
    got = big.select(source_audit.share(F.col("n"), F.col("total"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (10 ** 15 + 12) // (3 * 10 ** 17 + 1 + 5 * 10 ** 7)


def brute_nearest(rows, k):
    """(query, rank, id, score) of all rows; a vector's id may be None or repeated."""
    ok = [(i, r[0], np.array(r[1], float)) for i, r in enumerate(rows)
          if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    out = []
    for i, name, v in ok:
        if name is None or name % 50:
            continue
        found = [(-float((v * w).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum()))), other is None, other or 0, other)
                 for j, other, w in ok if j != i and len(w) == len(v)]
        out += [(name, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return out


def near_rows():
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(700)]
    copy = rows[100][1]
    rows += [(700 + i, [x * 2.0 ** (i % 3) for x in copy]) for i in range(40)]              # ties, by the smaller id
    rows += [(100, copy), (None, copy), (800, None), (850, []), (900, [0.0] * 16), (950, [float("nan")] + copy[1:]),
             (1000, [float("inf")] + copy[1:]), (1050, [None] + copy[1:]), (1100, [1e200, -1e200] + copy[2:]), (1150, [1e-300] * 16),
             (1200, [1.0, 2.0]), (1201, [2.0, 1.0]), (1250, [1.0, 2.0, 3.0])]
    return rows


SCHEMA = "vec_id long, embedding array<double>, row string, id string, size string, vector string"


def test_nearest_awkward(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, "r", "i", "s", "v") for r in rows], SCHEMA).repartition(5)
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, miss=1e-9).collect()
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        expected = brute_nearest([r for r in rows if r[0] not in (1100, 1150)], 5)
    got = {(r[0], r[1], r[2]): r[3] for r in got}
    ids = {r[0] for r in expected}
    assert {k for k in got if k[0] in (1200,)} == {(1200, 1, 1201)} and not [k for k in got if k[0] in (800, 850, 900, 950, 1000, 1050, 1250)]
    assert len([k for k in got if k[0] == 1100]) == len([k for k in got if k[0] == 1150]) == 5
    plain = {(r[0], r[1], r[2]): r[3] for r in expected if r[0] != 100}
    large = {1100, 1150}                                    # as candidates they can stand in the results of others
    touched = {k[0] for k in got if k[2] in large}
    assert {k: v for k, v in plain.items() if k[0] not in touched}.items() <= got.items() and len(ids - touched) > 10
    assert sorted(k[2] for k in got if k[0] == 100 and k[1] == 1)[:1] == [100]          # the repeated row of the query's id


def test_nearest_recall(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in sample.collect()]
    expected = {(r[0], r[2]): r[3] for r in brute_nearest(rows, 5)}
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in queries.op12_neighbours(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(expected)
    both = got.keys() & expected.keys()
    assert len(both) >= 0.95 * len(expected) and all(abs(got[k] - expected[k]) < 1e-12 for k in both)


def test_nearest_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_collision_index_finds_most_and_verifies_part():
    rng = np.random.default_rng(9)
    import pyarrow as pa
    vectors = rng.standard_normal((3000, 48))
    ids = np.arange(3000)
    index = neighbours.CollisionIndex(ids, pa.array(ids), vectors, 64, 2.72, 0.05, 3, 7)
    units = neighbours.unit(vectors)
    cos = units[:60] @ units.T
    cos[np.arange(60), np.arange(60)] = -1
    last = np.sqrt(2 - 2 * np.sort(cos, axis=1)[:, -5]) + 1e-6
    hit = sum(len(set(found) & set(np.argsort(-cos[i])[:5])) for i, (found, _) in enumerate(index.search(ids[:60], vectors[:60], last, 5)))
    assert hit >= 0.93 * 300 and index.verified < 0.6 * 60 * 3000
    assert neighbours.threshold(64, 2.72, 0.05) < neighbours.threshold(64, 2.72, 0.5) <= 64
