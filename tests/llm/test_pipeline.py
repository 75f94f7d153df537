"""The pipeline against its brute-force version, and the registered queries."""

from collections import Counter

import corpus_pipeline
import __spark_entry__ as E
from conftest import SF001
from frames import awkward, empty, frame
from test_dedup import brute_exact, brute_simhash
from test_mix_pack import check_pack
from test_scans import brute_quality


def test_pipeline_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r in rows if not brute_quality(r[1])[-1]]
    keep = {r[0] for r in brute_exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    keep = {r[0] for r in brute_simhash(rows) if r[0] == r[2]}
    rows = [r for r in rows if r[0] in keep]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SF001)
        assert kept.columns == docs.columns
    # 200 documents have too few labels for a cutoff, so the base rules alone decide
    assert sorted(tuple(r)[:2] for r in kept.collect()) == sorted(rows)
    mixed = corpus_pipeline.mix_sources(spark, kept, SF001)
    assert mixed.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    assert set(texts) <= set(rows) and max(Counter(texts).values()) <= 3
    packed = corpus_pipeline.run(spark, SF001).collect()
    check_pack(texts, packed, 2048)


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (awkward(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF001)
            assert after.columns == docs.columns
            docs = after
        assert (corpus_pipeline.pack_sequences(spark, docs, SF001).count() > 0) == bool(rows)
    assert empty(spark).count() == 0


def test_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
