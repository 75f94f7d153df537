"""Mixing and packing: invariants, brute force and reruns."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import mixing, packing
from conftest import SF001
from frames import awkward, empty, frame


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}: capped sources hand on their excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if level * weight[s] > most * sizes[s]]
        if not over:
            return {**capped, **{s: level * weight[s] for s in rest}}
        capped.update({s: most * sizes[s] for s in over})


def check_mix(rows, got):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    size_of = [(r[0], r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows]
    for _, s, n in size_of:
        sizes[s] += n
        largest[s] = max(largest[s], n)
    targets = brute_targets(sizes)
    assert sorted(map(repr, ((r["id"], r["source"], r["size"]) for r in got))) == sorted(map(repr, size_of))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6 * (1 + r["target"])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s]


def test_mix_awkward(spark):
    got = mixing.mix(frame(spark), chunk_rows=4, fan=2)
    rows = got.collect()
    check_mix(awkward(), rows)
    again = mixing.mix(frame(spark).repartition(5), chunk_rows=4, fan=2).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    assert mixing.mix(empty(spark)).count() == 0


def test_mix_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    check_mix([(r["doc_id"], r["text"], None, r["source"]) for r in docs.collect()], mixing.mix(docs).collect())


def test_mixed_documents(spark):
    df = frame(spark).dropDuplicates(["doc_id", "text"])
    copies = {(r["id"], r["content"]): r["copies"] for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(copies.values())
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_equal_rows_share_all_their_copies(spark):
    rows = [(i, "a " * 50, "en", "A", 0, "c", "f", "n", "i") for i in range(3, 12)]
    rows += [(1, "b " * 11, "en", "B", k, "c", "f", "n", "i") for k in (0, 0, 1, 2, 3)]
    for seed in (1, 2, 3):
        df = frame(spark, rows)
        copies = defaultdict(int)
        for r in mixing.mix(df, seed=seed).collect():
            copies[r["id"], r["content"]] += r["copies"]
        out = mixing.mixed_documents(df, seed=seed)
        got = defaultdict(int)
        for r in out.collect():
            got[r["doc_id"]] += 1
        assert out.columns == df.columns and sum(got.values()) == sum(copies.values())
        assert got[1] == sum(n for (i, _), n in copies.items() if i == 1)


def test_pivotal_is_unbiased_and_keeps_the_sum():
    rng, size = np.random.default_rng(1), [9, 4, 4, 7, 2, 30, 1]
    mean = np.zeros(len(size))
    for _ in range(4000):
        p = [0.3, 0.8, 0.5, 0.25, 0.9, 0.1, 0.6]
        words = sum(a * b for a, b in zip(p, size))
        held = mixing.pivotal(p, size, rng)
        assert abs(sum(a * b for a, b in zip(p, size)) - words) < 1e-9
        assert all(x in (0, 1) for i, x in enumerate(p) if i != held)
        mean += p
    assert np.abs(mean / 4000 - [0.3, 0.8, 0.5, 0.25, 0.9, 0.1, 0.6]).max() < 0.04


def check_pack(rows, got, longest):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    expected = []
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for a in range(0, len(ids), longest):
            part = ids[a:a + longest]
            expected.append((i, a, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got), key=repr) == \
        sorted(expected, key=repr)
    packs = defaultdict(list)
    for r in got:
        packs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(packs) == list(range(len(packs)))
    for pieces in packs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= longest
    total = sum(r["length"] for r in got)
    return total / (longest * len(packs)) if packs else 1.0


@pytest.mark.parametrize("longest", [64, 2048])
def test_pack(spark, longest):
    got = packing.pack(frame(spark), packing.tokenizer_path(), longest=longest).collect()
    check_pack([(r[0], r[1]) for r in awkward()], got, longest)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    assert packing.pack(empty(spark), packing.tokenizer_path()).count() == 0


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = packing.pack(docs, packing.tokenizer_path(), with_ids=False).collect()
    assert check_pack([(r["doc_id"], r["text"]) for r in docs.collect()], got, 2048) > 0.9


def test_patterns_hold_the_histogram():
    rng = random.Random(2)
    for _ in range(50):
        histogram = {rng.randint(1, 40): rng.randint(1, 500) for _ in range(rng.randint(1, 30))}
        patterns = packing.packing_patterns(histogram, 40)
        used = defaultdict(int)
        for count, pack in patterns:
            assert sum(pack) <= 40 and count > 0
            for length in pack:
                used[length] += count
        assert used == histogram


def test_word_tokens_equal_whole_texts():
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["<|ENDOFTEXT|> x<|x|>. <|", "J\u030c T\u0308x h\u0331. (W\u030a)", "\x7f \x1fa", "a" * 70_000, "It's 3.14 o'clock now x", "é ́a\ń", "ÀÉ ΣΑΣ İstanbul ǅ", "<|endoftext|> a<|startoftext|>b", "a\x1cb\x85c　d",
             "I'LL we're 'S 'T", "漢字 かな 12345", "", " ", "\x00 a\x00",
             "Don't 's-it,we'll. A1b22C «Là», (éa) é'a ÉTÉ. -é- a.b,c ...x É\u0301. \u0301x. ª² x'S, x<|endoftext|>y ß."]
    ids, edges = packing.WordTokens(packing.tokenizer_path()).encode(pa.array(texts), 1)
    for i, t in enumerate(texts):
        assert ids[edges[i]:edges[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_word_tokens_where_a_letter_becomes_letter_and_mark():
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    words = ["\u09b9\u09df,", "\u092a\u095d)", "vakt\u0130.", "(\u09df", "\u095dx\u00e9!", "\u1112\u1161\u11ab.", "-\u0130-"]
    letters = [chr(c) for c in range(128, 0x110000) if chr(c).isalpha()]
    words += [f",{c}," for c in letters] + [f"x{c}." for c in letters]
    rng = random.Random(5)
    odd = [c for c in letters if len(tokenizer.normalizer.normalize_str(c)) > 1]
    words += ["(" + "".join(rng.choice(rng.choice([letters, odd])) for _ in range(3)) + ")" for _ in range(20_000)]
    ids, edges = packing.WordTokens(packing.tokenizer_path()).encode(pa.array(words), 1)
    whole = tokenizer.encode_batch(words, add_special_tokens=False)
    wrong = [w for i, w in enumerate(words) if ids[edges[i]:edges[i + 1]].tolist() != whole[i].ids + [1]]
    assert len(odd) > 50 and not wrong, (len(wrong), wrong[:5])


def test_word_tokens_with_few_parts_kept():
    tokenizer, rng = Tokenizer.from_file(packing.tokenizer_path()), random.Random(8)
    tokens = packing.WordTokens(packing.tokenizer_path(), held=50)
    for _ in range(30):
        texts = [" ".join(rng.choice(["hot", "The,", "für.", f"w{rng.randrange(40)}é", f"x-{rng.randrange(400)}"]) for _ in range(40)) for _ in range(3)]
        ids, edges = tokens.encode(pa.array(texts), 1, together=16)
        for i, t in enumerate(texts):
            assert ids[edges[i]:edges[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1]
        assert len(tokens.known) == len(tokens.lengths) < 50 + 60


@pytest.mark.parametrize("hot", [40, 150, 300])
def test_patterns_fill_with_a_hot_length(hot):
    rng, histogram = random.Random(hot), defaultdict(int)
    for _ in range(20_000):
        histogram[min(2048, 1 + int(rng.lognormvariate(5.5, 1)))] += 1
    histogram[hot] += 10_000
    patterns = packing.packing_patterns(histogram)
    assert sum(k * n for k, n in histogram.items()) > 0.99 * 2048 * sum(count for count, _ in patterns)
    assert sum(count for count, _ in packing.packing_patterns({hot: 1000})) == -(-1000 // (2048 // hot))


def test_slots_of_equal_lengths_hold_every_rank_once():
    patterns = packing.packing_patterns({300: 1000, 40: 777, 9: 5})
    places = packing.slots(patterns)
    taken = set()
    for length, n in ((300, 1000), (40, 777), (9, 5)):
        rows, ranks = places[length], np.arange(n)
        row = np.searchsorted(rows[:, 0], ranks, side="right") - 1
        at = zip((rows[row, 1] + ranks - rows[row, 0]).tolist(), rows[row, 2].tolist())
        taken |= {(s, b) for s, a in at for b in range(a, a + length)}
    assert len(taken) == 300 * 1000 + 40 * 777 + 9 * 5 and max(b for _, b in taken) < 2048
