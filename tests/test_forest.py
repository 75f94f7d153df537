"""Forests over many rows: the same trees however rows are dealt, splits against brute force, as good as pyspark.ml's."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import forest as FO
from cohortlens.operators import models as ML
from cohortlens.session import stored

T = ["a", "b"]


def _rows(spark, n=1500, parts=3):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(n):
        x = [float(rng.random()), float(rng.normal()), float(rng.integers(0, 5)), 7.0, float(rng.random() < 0.05)]
        rows.append((f"s{i:05d}", x, [float(3 * x[0] + x[1] * x[2] + rng.normal() * 0.3), float(100 + np.sin(6 * x[0]))], 0.5 + x[0]))
    rows = [rows[i] for i in rng.permutation(n)]
    schema = "subject string, x array<double>, y array<double>, weight double"
    return stored(spark.createDataFrame(rows, schema).repartition(parts))


def _fit(monkeypatch, df, part_bytes=FO.PART_BYTES, many=0, trees=6, depth=5, **options):
    monkeypatch.setattr(ML, "MANY_ROWS", many)
    monkeypatch.setattr(FO, "PART_BYTES", part_bytes)
    return ML.fit_forests(df, T, "basic", depth, None, 5, trees, **options)


def _predicted(models, df):
    got = ML.predict_forests(models, df, T).orderBy("subject").collect()
    return np.array([[r["a_pred"], r["b_pred"]] for r in got])


@pytest.mark.parametrize("weight", [None, "weight"])
def test_forest_does_not_depend_on_the_partitions(spark, monkeypatch, weight):
    df = _rows(spark)
    one = _predicted(_fit(monkeypatch, df, weight_col=weight), df)
    again = _predicted(_fit(monkeypatch, stored(df.repartition(1)), weight_col=weight), df)
    levels = _predicted(_fit(monkeypatch, df, 20_000, weight_col=weight), df)      # several parts, level by level
    assert np.allclose(one, again, rtol=1e-12) and np.allclose(one, levels, rtol=1e-12)


def test_forest_is_as_good_as_pysparks(spark, monkeypatch):
    df = _rows(spark, 3000)
    train, test = (stored(df.filter(f"substring(subject, 6, 1) {op} '0'")) for op in ("<>", "="))
    truth = np.array([r["y"] for r in test.orderBy("subject").collect()])
    scores, importances = [], []
    for many in (0, 1 << 60):
        models = _fit(monkeypatch, train, many=many, trees=40, depth=7)
        error = _predicted(models, test) - truth
        scores.append(1 - (error ** 2).mean(0) / truth.var(0))
        importances.append([m.featureImportances.toArray() for m in models])
        assert [m.getNumTrees for m in models] == [40, 40] and max(t.depth for t in models[0].trees) == 7
    assert np.abs(scores[0] - scores[1]).max() < 0.03 and scores[0].min() > 0.85
    assert np.abs(np.array(importances[0]) - importances[1]).max() < 0.1
    assert importances[0][0][3] == 0 and np.allclose(np.sum(importances[0], axis=1), 1)


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(3)
    for weighted in (False, True):
        n, k = 300, 4
        x = np.column_stack([rng.integers(0, 6, n), rng.integers(0, 3, n), rng.integers(0, 31, n), np.zeros(n)]).astype(np.uint8)
        y = x[:, 0] * 2.0 + (x[:, 2] > 9) + rng.normal(size=n)
        rows = FO.SimpleNamespace(bins=x.ravel(), y=[y], w=rng.random(n) + 0.1 if weighted else None, k=k,
                                  key=rng.integers(0, 1 << 62, n).astype(np.uint64))
        o = FO.SimpleNamespace(k=k, m=2, depth=4, seed=9)
        drawn = FO._drawn(rows, o.seed, 1)
        tree = FO._grown(rows, drawn, y, o, 1)
        w, own, node, level = drawn.weight, x[drawn.at], np.zeros(len(drawn.at), int), [np.zeros(1, int)]
        sse = lambda m: (w[m] * (y[drawn.at][m] - np.average(y[drawn.at][m], weights=w[m])) ** 2).sum() if m.any() else 0.0
        for depth in range(o.depth):
            subset = FO._subset(k, o.m, len(level[-1]), o.seed, 1, depth)
            for place, at in enumerate(level[-1]):
                here = node == at
                assert np.isclose(tree.stats[at, 1], w[here].sum()) and tree.stats[at, 0] == drawn.count[here].sum()
                best = max((sse(here) - sse(here & (own[:, f] <= b)) - sse(here & (own[:, f] > b)) for f in subset[place] for b in range(31)
                            if 0 < (own[here, f] <= b).sum() < here.sum()), default=0.0)
                assert np.isclose(tree.stats[at, 4] * w[here].sum(), best, atol=1e-9)
                if tree.left[at] >= 0:
                    node[here] = tree.left[at] + (own[here, tree.feature[at]] > tree.last[at])
            level.append(np.array([c for at in level[-1] if tree.left[at] >= 0 for c in (tree.left[at], tree.left[at] + 1)], int))
        assert len(tree.left) == sum(map(len, level)) > 8


def test_bootstrap_counts_are_poisson():
    key = np.arange(200_000, dtype=np.uint64)
    rows = FO.SimpleNamespace(key=key, k=1, w=None)
    drawn = [FO._drawn(rows, 4, t) for t in (0, 1)]
    for d in drawn:
        count = np.bincount(d.count.astype(int), minlength=4)
        assert abs(len(d.at) / len(key) - (1 - np.exp(-1))) < 0.005 and abs(count[1] / len(key) - np.exp(-1)) < 0.005
        assert abs(d.count.sum() / len(key) - 1) < 0.01
    assert not np.array_equal(drawn[0].at, drawn[1].at)


def test_equal_rows_draw_each_for_itself():
    chunk = {"slot": 0, "n": 1, "bins": b"\1", "y": np.zeros(1).tobytes(), "w": None, "key": np.array([5], np.uint64).tobytes()}
    batch = pa.RecordBatch.from_pylist([chunk] * 400, pa.schema([("slot", pa.int32()), ("n", pa.int32()), ("bins", pa.binary()),
                                                                ("y", pa.binary()), ("w", pa.binary()), ("key", pa.binary())]))
    (_, rows), = FO._slots([batch], 1, 1, [0.0])
    assert 0.5 < len(FO._drawn(rows, 4, 0).at) / 400 < 0.75


def test_slots_have_a_partition_each(spark):
    df = spark.range(4000).select((F.col("id") % 12).cast("int").alias("slot"), "id").repartition(5)
    got = FO._dealt(df, 12).groupBy(F.spark_partition_id()).agg(F.countDistinct("slot").alias("slots"), F.count("id").alias("n")).collect()
    assert len(got) == 12 and {r["slots"] for r in got} == {1} and sum(r["n"] for r in got) == 4000


def test_thresholds():
    assert FO.thresholds(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5] and FO.thresholds(np.ones(9)).tolist() == []
    values = np.random.default_rng(1).random(10_000)
    cuts = FO.thresholds(values)
    assert len(cuts) == 31 and np.abs(cuts - np.arange(1, 32) / 32).max() < 0.02
    heavy = FO.thresholds(np.concatenate([np.zeros(9000), values[:1000]]))
    assert 2 <= len(heavy) <= 31 and (np.diff(heavy) > 0).all()


def test_predictions_are_those_of_transform(spark, monkeypatch):
    df = _rows(spark, 700)
    models = _fit(monkeypatch, df, trees=9, depth=6)
    got = ML.predict_forests(models, df.withColumn("role", F.lit("test")), T)
    assert got.columns == ["subject", "weight", "role", "a_pred", "b_pred"]
    one = _predicted(models, df)
    for m in models:
        del m.walks
    assert np.allclose(one, _predicted(models, df), rtol=1e-14, atol=0)


def test_bins_come_from_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(FO, "SAMPLED", 300)
    df = _rows(spark)
    one, again = (_predicted(_fit(monkeypatch, x, trees=2), df) for x in (df, stored(df.repartition(5))))
    assert np.allclose(one, again, rtol=1e-12)


@pytest.mark.parametrize("row", [("z", [1.0, 1.0, 1.0, 1.0, None], [1.0, 1.0], 1.0), ("z", [1.0] * 5, [None, 1.0], 1.0),
                                 ("z", [1.0] * 5, [1.0, 1.0], None), ("z", [1.0] * 5, [1.0, 1.0], -1.0)])
def test_gaps_are_an_error(spark, monkeypatch, row):
    df = _rows(spark, 50)
    bad = stored(df.unionByName(spark.createDataFrame([row], df.schema)))
    with pytest.raises(Exception, match="without gaps|finite|must be|NoneType"):
        _fit(monkeypatch, bad, weight_col="weight")
