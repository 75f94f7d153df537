"""Stores of learning results: parallel writers, kinds of predictions, loads with checks."""

import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators.checks import CheckFailed
from cohortlens.plans import learning as LR
from cohortlens.sources import files as SRC
from cohortlens.sources import sinks as SNK


def test_parallel_writers_lose_nothing(spark, tmp_path):
    for run in range(4):
        store = LR.SplitStore(spark, str(tmp_path / f"store{run}"))
        assert store.splits() == set()

        def write(split):
            rows = spark.createDataFrame([(split, f"s{i}", float(i)) for i in range(5)], "split int, subject string, p double")
            store.write(split, {"predictions": rows, "importances": rows.limit(1)})
        with ThreadPoolExecutor(8) as ex:
            list(ex.map(write, range(8)))
        assert store.splits() == set(range(8))
        got = store.read("predictions").groupBy("split").count().collect()
        assert sorted(tuple(r) for r in got) == [(k, 5) for k in range(8)] and store.read("importances").count() == 8


def test_rows_without_a_mark_are_not_read(spark, tmp_path):
    store = LR.SplitStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(0, "a", 1.0)], "split int, subject string, p double")
    store.write(0, {"predictions": rows})
    rows.drop("split").write.parquet(os.path.join(store.path, "predictions", "split=1"))        # a run that ended half-way
    assert store.splits() == {0} and [r.split for r in store.read("predictions").collect()] == [0]
    store.write(1, {"predictions": rows.withColumn("split", F.lit(1))})
    assert store.read("predictions").count() == 2


def _study(spark, n=90):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(n, 2))
    x = spark.createDataFrame([(f"s{i:03d}", float(X[i, 0]), None if i % 10 == 0 else float(X[i, 1])) for i in range(n)],
                              "subject string, a double, b double")
    y = spark.createDataFrame([(f"s{i:03d}", float(X[i, 0] * 2 + rng.normal() * 0.1)) for i in range(n)], "subject string, t double")
    return x, y


def test_an_error_of_the_store_is_raised(spark, tmp_path, monkeypatch):
    x, y = _study(spark)
    write = LR.SplitStore.write

    def broken(self, split, *rest):
        if split == 1:
            raise OSError("disk")
        write(self, split, *rest)
    monkeypatch.setattr(LR.SplitStore, "write", broken)
    with pytest.raises(OSError, match="disk"):
        LR.learn(x, ["a"], y, ["t"], "basic", n_splits=2, depth=2, n_trees=2, out_path=str(tmp_path / "study"))
    monkeypatch.undo()
    again = LR.learn(x, ["a"], y, ["t"], "basic", n_splits=2, depth=2, n_trees=2, out_path=str(tmp_path / "study"))
    assert again["skipped_splits"] == [0] and again["predictions"].select("split").distinct().count() == 2


def test_a_failed_split_is_no_result(spark, tmp_path, monkeypatch):
    x, y = _study(spark)
    fit = LR.ML.fit_forests

    def broken(train, *rest):
        if train.select("split").first()[0] == 1:
            raise ValueError("no fit")
        return fit(train, *rest)
    monkeypatch.setattr(LR.ML, "fit_forests", broken)
    options = dict(n_splits=2, depth=2, n_trees=2)
    with pytest.raises(LR.SplitsFailed, match=r"\[1\] of 2.*no fit"):
        LR.learn(x, ["a"], y, ["t"], "basic", **options)
    with pytest.raises(LR.SplitsFailed):
        LR.learn(x, ["a"], y, ["t"], "basic", out_path=str(tmp_path / "a"), report_failures=False, **options)
    with pytest.warns(UserWarning, match="have no results"):
        part = LR.learn(x, ["a"], y, ["t"], "basic", out_path=str(tmp_path / "b"), **options)
    assert [r.split for r in part["failures"].collect()] == [1]
    monkeypatch.undo()
    whole = LR.learn(x, ["a"], y, ["t"], "basic", out_path=str(tmp_path / "a"), **options)
    assert whole["skipped_splits"] == [0] and whole["predictions"].select("split").distinct().count() == 2


def test_ridge_models_share_a_store(spark, tmp_path):
    x, y = _study(spark)
    out = str(tmp_path / "study")
    a = LR.learn(x, ["a", "b"], y, ["t"], n_splits=2, modality="one", permuted=True, out_path=out)
    LR.learn(x, ["a"], y, ["t"], n_splits=2, modality="two", out_path=out)
    base = os.path.join(out, "predictions")
    n = a["predictions"].count()
    for options, rows in (({}, n), ({"permuted": True}, n), ({"kind": "train"}, a["predictions_training"].count())):
        assert SRC.load_predictions(spark, base, "ridgecv", ["one"], **options).count() == rows > 0
    assert SRC.load_predictions(spark, base, "ridgecv", ["two"]).count() == n
    assert SRC.load_predictions(spark, base, "ridgecv", ["two"], permuted=True).count() == 0
    p, q = (SRC.load_predictions(spark, base, "ridgecv", ["one"], permuted=k).select(F.corr("t", "t_pred")).first()[0] for k in (False, True))
    assert p > 0.9 > abs(q)


def test_loads_check_their_subjects(spark, tmp_path):
    rows = [("s1", "t1", "fs", "f", 1.0), ("s2", "t1", "fs", "f", 2.0)]
    schema = "subject string, session string, kind string, name string, value double"
    base, wanted = str(tmp_path / "features"), spark.createDataFrame([("s1",), ("s2",)], "subject string")
    SNK.write_features(spark.createDataFrame(rows, schema), base, "a")
    assert SRC.load_features(spark, base, "fs", wanted, one_per_key=True).count() == 2
    more = wanted.union(spark.createDataFrame([("s3",)], "subject string"))
    assert SRC.load_features(spark, base, "fs", more).count() == 2
    with pytest.raises(CheckFailed, match="s3"):
        SRC.load_features(spark, base, "fs", more, one_per_key=True)
    SNK.write_features(spark.createDataFrame(rows[:1], schema), base, "b")
    with pytest.raises(CheckFailed, match="several"):
        SRC.load_features(spark, base, "fs", wanted, one_per_key=True)
    table = str(tmp_path / "table")
    spark.createDataFrame([("s1", 1)], "subject string, v int").write.parquet(table)
    assert SRC.load_table(spark, table, wanted).count() == 1
    with pytest.raises(CheckFailed, match="s2"):
        SRC.load_table(spark, table, wanted, complete=True)
