"""Learning steps that must not grow faster than their rows: ranks, curve members, permuted copies, ridge parameters, forests."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import linear as L
from cohortlens.operators import models as ML
from cohortlens.operators import ranking as R
from cohortlens.plans import learning as LR
from cohortlens.session import stored


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_join_no_shuffled_rows(spark):
    rows = [(g, v) for g, n in (("a", 300), (None, 50), ("b", 1), ("c", 40)) for v in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v int").repartition(4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked, lagged = R.rank_within(df, ["g"], ["v"], n_parts=7), R.lag_within(df, ["g"], ["v"], ["v"], n_parts=7)
        assert "SortMergeJoin" not in _plan(ranked) and "SortMergeJoin" not in _plan(lagged)
        assert all(r["rn"] == r["v"] + 1 for r in ranked.collect())
        assert all(r["v__lag"] == (r["v"] - 1 if r["v"] else None) for r in lagged.collect())
        assert ranked.count() == lagged.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("n", [1, 3, 23])
def test_learning_curve_members(spark, n):
    names = sorted(f"s{k}" for k in range(n))
    sizes = [n // 5 + (f < n % 5) for f in range(5)]
    fold = {s: next(f for f in range(5) if k < sum(sizes[:f + 1])) for k, s in enumerate(names)}
    want = set()
    for si, frac in enumerate(ML.TRAIN_SIZES):
        for f in range(5):
            train = [s for s in names if fold[s] != f]
            want |= {(si * 5 + f, si, f, s, "train") for s in train[:int(np.floor((n - sizes[0]) * frac))]}
            want |= {(si * 5 + f, si, f, s, "test") for s in names if fold[s] == f}
    got = ML.learning_curve_members(spark.createDataFrame([(s,) for s in names], "subject string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_permuted_copies(spark):
    rows = [(s, f"p{k}", [float(k + s), None if k % 3 else 10.0 * k], [float(k)]) for s in (0, 1) for k in range(9)]
    df = spark.createDataFrame(rows, "split int, subject string, x array<double>, y array<double>")
    want = []
    for s in (0, 1):
        own = {subject: (x, y) for sp, subject, x, y in rows if sp == s}
        for j in range(2):
            for r in range(3):
                shuffled = sorted(own, key=lambda v: hashlib.md5(f"{LR.SEED}:{s}:{j}:{r}:{v}".encode()).hexdigest())
                for subject, other in zip(sorted(own), shuffled):
                    x = list(own[subject][0])
                    x[j] = own[other][0][j]
                    want.append((s, subject, j, r, x, own[subject][1]))
    got = LR.permuted_copies(df, 2, 3).select("split", "subject", "j", "r", "x", "y").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_ridge_parameters_meet_rows_without_a_shuffle(spark):
    rnd = np.random.default_rng(3)
    rows = [(s, f"p{k}", "train", rnd.normal(size=3).tolist(), rnd.normal(size=2).tolist()) for s in (0, 1) for k in range(60)]
    df = stored(spark.createDataFrame(rows, "split int, subject string, role string, x array<double>, y array<double>"))
    coef = L.ridge_cv(df, [0.5, 50.0])
    pred = L.predict_linear(df, coef, 2, ["a", "b"])
    assert "SortMergeJoin" not in _plan(pred) and "hashpartitioning" not in _plan(pred)
    for c in coef.collect():
        X, Y = (np.array([r[i] for r in rows if r[0] == c["split"]]) for i in (3, 4))
        z, e = (X - X.mean(0)) / X.std(0), Y - Y.mean(0)
        sse = {}
        for alpha in (0.5, 50.0):
            hat = z @ np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T)
            sse[alpha] = (((e - hat @ e) / (1 - 1 / len(z) - np.diag(hat))[:, None]) ** 2).sum()
        assert c["alpha"] == min(sse, key=sse.get)
        got = np.array([[r["a_pred"], r["b_pred"]] for r in pred.filter(F.col("split") == c["split"]).orderBy("subject").collect()])
        order = np.argsort([r[1] for r in rows if r[0] == c["split"]])
        w = np.linalg.solve(z.T @ z + c["alpha"] * np.eye(3), z.T @ e)
        assert np.allclose(got, (Y.mean(0) + z @ w)[order])


def test_gap_columns(spark):
    df = spark.createDataFrame([([1.0, None, 2.0],), ([float("nan"), 1.0, 3.0],)], "x array<double>").repartition(3)
    assert L.gap_columns(df) == [0, 1] and L.gap_columns(df.limit(0)) == []


def test_forest_partitions_are_bounded_by_the_cores(spark):
    """Every partition sends the statistics of all open nodes, so 64 of them cost what 64 forests cost."""
    rows = spark.range(400).select(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("x"),
                                   F.array((F.col("id") % 5).cast("double")).alias("y"))
    seen = []
    real = ML._forest

    class Spy:
        def __init__(self, *args):
            self.of = real(*args)

        def fit(self, data):
            seen.append(data.rdd.getNumPartitions())
            return self.of.fit(data)
    ML._forest = Spy
    try:
        model = ML.fit_forests(stored(rows.repartition(64)), ["a"], depth=3, n_trees=4)[0]
    finally:
        ML._forest = real
    assert seen[0] <= spark.sparkContext.defaultParallelism and model.getCacheNodeIds()
