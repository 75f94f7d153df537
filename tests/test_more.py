"""Streaming idempotence, Gram vs join paths, smoothing weights, small reshapes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import signal as S
from cohortlens.operators import tidy as TD


def test_gram_path_equals_join_path(spark):
    rng = np.random.default_rng(21)
    rows = [(s, run, t, r, float(v)) for s in ("a", "b") for run in (0, 1) for t in range(25)
            for r, v in enumerate(rng.normal(size=6) + 100.0)]
    sig = spark.createDataFrame(rows, "subject string, run int, t long, roi int, value double")
    for f1, f2 in [(S.correlation_edges, S.correlation_edges_gram),
                   (S.shrunk_correlation_edges, S.shrunk_correlation_edges_gram)]:
        a = {(r.subject, r.run, r.i, r.j): r.r for r in f1(sig, ["subject", "run"]).collect()}
        b = {(r.subject, r.run, r.i, r.j): r.r for r in f2(sig, ["subject", "run"]).collect()}
        assert a.keys() == b.keys()
        assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_smoothing_weights_brute_force(spark):
    # 1 ROI sphere on a small grid; compare smoothing-then-sphere-mean with the folded weights
    n = 15
    rng = np.random.default_rng(2)
    img = rng.normal(size=(n, n, n))
    vox = spark.createDataFrame([(x, y, z, float(img[x, y, z])) for x in range(n) for y in range(n) for z in range(n)],
                                "x int, y int, z int, value double")
    roi = spark.createDataFrame([(1, 7, 7, 7)], "roi long, x int, y int, z int")
    mem = S.sphere_members(roi, vox.select("x", "y", "z"), 2.0)
    w = S.smoothing_weights(mem, fwhm=3.0)
    got = S.weighted_roi_signal(w, vox).first()["value"]
    sigma = 3.0 / S.FWHM_TO_SIGMA
    rad = int(4.0 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-rad, rad + 1) / sigma) ** 2)
    k /= k.sum()
    sm = img.copy()
    for ax in range(3):
        sm = np.apply_along_axis(lambda v: np.convolve(v, k, mode="same"), ax, sm)
    pts = [(x, y, z) for x in range(n) for y in range(n) for z in range(n)
           if (x - 7) ** 2 + (y - 7) ** 2 + (z - 7) ** 2 <= 4]
    want = np.mean([sm[p] for p in pts])
    assert math.isclose(got, want, rel_tol=1e-9)


def test_incremental_features_keep_sessions_and_batches(spark, tmp_path):
    from cohortlens.streaming.incremental import incremental_features, run_incremental_features
    src, out, ck = tmp_path / "stats", tmp_path / "features", tmp_path / "ckpt"
    glob = str(src / "*" / "*" / "*.stats")

    def put(subject, session, name, text):
        d = src / f"sub-{subject}" / f"ses-{session}"
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_text(text)

    def etiv(v):
        return f"# Measure EstimatedTotalIntraCranialVol, eTIV, Estimated Total Intracranial Volume, {v}, mm^3\n"

    def row(v):
        return f"  1 4 100 {v} Left-Hippocampus 0 0 0 0 0\n"

    def run():
        return run_incremental_features(spark, glob, str(out), str(ck))

    def got():
        return {(r.subject, r.session, r.name): r.value for r in incremental_features(spark, str(out)).collect()}

    name = "fs__vol__Left-Hippocampus"
    put("01", "a", "aseg.stats", etiv(1000.0) + row(10.0))
    assert run() == 1 and run() == 0
    assert got() == {("01", "a", name): 0.01}
    # a second session of the same subject, and a second subject
    put("01", "b", "aseg.stats", etiv(500.0) + row(10.0))
    put("02", "a", "aseg.stats", etiv(2000.0) + row(10.0))
    assert run() == 1
    assert got() == {("01", "a", name): 0.01, ("01", "b", name): 0.02, ("02", "a", name): 0.005}
    # parcels of a subject come in a later batch than its total volume
    put("02", "a", "lh.aparc.stats", "G&S_x 1 2 40.0 2.5 0 0 0 0 0\n")
    assert run() == 1
    later = got()
    assert later[("02", "a", "fs__cortVolume__lh_G_S_x_volume")] == 0.02
    assert later[("02", "a", "fs__cortThickness__lh_G_S_x_thickness")] == 2.5
    assert len(later) == 5


def test_small_reshapes(spark):
    df = spark.createDataFrame([("r2_a_x", 1)], "r2_a_x string, b int")
    assert TD.rename_substrings(df, {"r2_": "", "_x": "_y"}).columns == ["a_y", "b"]
    m = spark.createDataFrame([("s", [[1.0, 2.0], [3.0, 4.0]])], "k string, matrix array<array<double>>")
    got = sorted((r.i, r.j, r.value) for r in TD.matrix_to_long(m, keys=["k"]).collect())
    assert got == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]
    f = spark.createDataFrame([([[1, 2], [3]],)], "a array<array<int>>")
    assert f.select(TD.flatten_list("a")).first()[0] == [1, 2, 3]
    gs = spark.createDataFrame([(0, 0.5, 0.4, {"max_depth": "3", "criterion": "mse"})],
                               "split int, tr double, te double, params map<string,string>")
    out = TD.params_to_columns(gs, ["criterion", "max_depth"])
    assert out.columns == ["split", "tr", "te", "criterion", "max_depth"]


def test_forest_learning_resumes_from_store(spark, tmp_path):
    from cohortlens.plans import learning as LR
    sf = "/root/testdata/sf0.001"
    out = str(tmp_path / "store")
    first = LR.learn_customers(spark, sf, "basic", n_splits=2, depth=3, n_trees=8, out_path=out)
    n1 = first["predictions"].count()
    again = LR.learn_customers(spark, sf, "basic", n_splits=2, depth=3, n_trees=8, out_path=out)
    assert again["skipped_splits"] == [0, 1]
    assert again["predictions"].count() == n1 > 0
    # a split without a completion mark (the run ended between two outputs) is fitted again
    spark.range(1).withColumn("split", F.lit(0)).write.mode("overwrite").partitionBy("split").parquet(out + "/done")
    third = LR.learn_customers(spark, sf, "basic", n_splits=2, depth=3, n_trees=8, out_path=out)
    assert third["skipped_splits"] == [0]
    assert third["predictions"].count() == n1


def _study(spark, n=120):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(n, 2))
    x = spark.createDataFrame([(f"s{i:03d}", float(X[i, 0]), None if i % 10 == 0 else float(X[i, 1])) for i in range(n)],
                              "subject string, a double, b double")
    y = spark.createDataFrame([(f"s{i:03d}", float(X[i, 0] * 2 + rng.normal() * 0.1)) for i in range(n)], "subject string, t double")
    return x, y


def test_learn_searches_per_split_and_stores(spark, tmp_path):
    from pyspark.ml.regression import RandomForestRegressionModel

    from cohortlens.plans import learning as LR
    x, y = _study(spark)
    out = str(tmp_path / "study")
    weights = y.select("subject", F.lit(1.0).alias("weight"))
    res = LR.learn(x, ["a", "b"], y, ["t"], "basic", n_splits=2, allowed_missing=["b"], weights=weights, permuted=True,
                   search={"depths": [1, 4], "n_folds": 2}, n_trees=6, out_path=out)
    assert res["failures"].count() == 0
    assert sorted((r.split, r.max_depth) for r in res["search"].collect()) == [(s, d) for s in (0, 1) for d in "14"]
    pred = res["predictions"].toPandas()
    assert len(pred) == 2 * 24 and pred["t_pred"].between(*y.selectExpr("min(t)", "max(t)").first()).all()
    assert len(res["predictions_training"].toPandas()) == 2 * 96 and res["predictions_permuted"].count() == 2 * 24
    imp = res["importances"].groupBy("split", "target").agg(F.sum("fi").alias("s"), F.min("fi").alias("low")).collect()
    assert len(imp) == 2 and all(abs(r.s - 1) < 1e-9 and r.low >= 0 for r in imp)
    info = res["split_info"].collect()
    assert [r.input_features for r in info] == [["a", "b"]] * 2 and info[0].model_features == ["a", "b", "b_missing"]
    assert spark.read.parquet(out + "/members").count() == 240 and spark.read.parquet(out + "/input/x").count() == 120
    assert RandomForestRegressionModel.load(out + "/models/split=1/target=t").getNumTrees == 6


def test_learn_checks_its_input(spark):
    from cohortlens.operators.checks import BASIC_ALLOWED_MISSING, CheckFailed
    from cohortlens.plans import learning as LR
    x, y = _study(spark, 30)
    with pytest.raises(CheckFailed, match="contain missings"):
        LR.prepare_x_y(x, ["a", "b"], y, allowed_missing=[])
    with pytest.raises(CheckFailed, match="different subjects"):
        LR.prepare_x_y(x.filter("subject <> 's003'"), ["a"], y)
    with pytest.raises(CheckFailed, match="more than once"):
        LR.prepare_x_y(x.unionByName(x.limit(1)), ["a"], y)
    clinical = x.select("subject", F.lit("F").alias("clin__risk__demo_sex"), F.lit(None).cast("string").alias("clin__assess__diag"))
    got = LR.prepare_x_y(clinical, clinical.columns[1:], y, "clinical", BASIC_ALLOWED_MISSING)
    assert {tuple(r)[1:] for r in got.collect()} == {(0, None)}


def test_failed_split_is_reported(spark, monkeypatch, tmp_path):
    from cohortlens.plans import learning as LR
    x, y = _study(spark, 60)
    fit = LR.ML.fit_forests

    def broken(train, *rest):
        if train.select("split").first()[0] == 1:
            raise RuntimeError("no fit")
        return fit(train, *rest)
    monkeypatch.setattr(LR.ML, "fit_forests", broken)
    out = str(tmp_path / "study")
    res = LR.learn(x, ["a", "b"], y, ["t"], "basic", n_splits=2, depth=2, n_trees=3, out_path=out)
    assert [(r.split, r.error) for r in res["failures"].collect()] == [(1, "no fit")]
    assert {r.split for r in res["predictions"].select("split").distinct().collect()} == {0}


def test_folds_within_classes(spark):
    from cohortlens.operators import splits as SP
    rows = spark.createDataFrame([(0, i % 3 == 0, f"s{i:02d}") for i in range(31)] + [(0, None, "z1"), (0, None, "z2")],
                                 "split int, c boolean, subject string")
    got = SP.kfold(rows, 5, group=["split", "c"]).groupBy("c", "fold").count().collect()
    assert {r["count"] for r in got if r.c} == {2, 3} and {r["count"] for r in got if r.c is False} == {4}


def test_distributed_rank_and_lag_equal_windows(spark):
    from pyspark.sql import Window
    from cohortlens.operators import ranking as RK
    rng = np.random.default_rng(41)
    rows = [("big" if i % 3 else f"g{i % 7}" if i % 7 else None, int(rng.integers(0, 50)), i, float(rng.normal())) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, ts int, id int, v double")
    w = Window.partitionBy("g").orderBy("ts", "id")
    want = {r.id: (r.rn, r.v_lag) for r in df.select("id", F.row_number().over(w).alias("rn"),
                                                      F.lag("v").over(w).alias("v_lag")).collect()}
    rk = RK.rank_within(df, ["g"], ["ts", "id"], "rn", n_parts=6)
    lg = RK.lag_within(df, ["g"], ["ts", "id"], ["v"], suffix="_lag", n_parts=6)
    got_rk = {r.id: r.rn for r in rk.collect()}
    got_lg = {r.id: r.v_lag for r in lg.collect()}
    assert got_rk == {k: v[0] for k, v in want.items()}
    assert got_lg == {k: v[1] for k, v in want.items()}
