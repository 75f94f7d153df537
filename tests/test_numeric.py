"""Composed operators against brute-force numpy on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import density as D
from cohortlens.operators import linear as L
from cohortlens.operators import metrics as M
from cohortlens.operators import signal as S
from cohortlens.operators import splits as SP


def test_ridge_loo_matches_refits(spark):
    rng = np.random.default_rng(3)
    n, k = 40, 3
    X = rng.normal(size=(n, k)) * [1.0, 10.0, 0.1] + [5.0, -2.0, 100.0]
    Y = np.c_[X @ [0.5, 0.05, 3.0] + rng.normal(size=n), rng.normal(size=n)]
    rows = spark.createDataFrame([(0, f"s{i}", "train", X[i].tolist(), Y[i].tolist()) for i in range(n)],
                                 "split int, subject string, role string, x array<double>, y array<double>")
    alphas = np.logspace(-3, 5, 25)
    coef = L.ridge_cv(rows, alphas)
    got = coef.first()

    def fit(Xt, Yt, a):
        mx, sd = Xt.mean(0), Xt.std(0)
        Z = (Xt - mx) / sd
        my = Yt.mean(0)
        w = np.linalg.solve(Z.T @ Z + a * np.eye(k), Z.T @ (Yt - my))
        return lambda Xn: my + ((Xn - mx) / sd) @ w

    errs = []
    for a in alphas:
        e = 0.0
        for i in range(n):
            m = np.arange(n) != i
            # the scaler is fitted once on all training rows (as in a pipeline
            # scaler -> RidgeCV); only the ridge is refitted leaving row i out
            mx, sd = X.mean(0), X.std(0)
            Z = (X - mx) / sd
            zm, ym = Z[m].mean(0), Y[m].mean(0)
            w = np.linalg.solve((Z[m] - zm).T @ (Z[m] - zm) + a * np.eye(k), (Z[m] - zm).T @ (Y[m] - ym))
            e += (((Y[i] - (ym + (Z[i] - zm) @ w))) ** 2).sum()
        errs.append(e)
    best = alphas[int(np.argmin(errs))]
    assert math.isclose(got["alpha"], best)
    pred = fit(X, Y, best)(X[:1])[0]
    w = np.asarray(got["w"]).reshape(k, 2)
    assert np.allclose(np.asarray(got["b"]) + X[0] @ w, pred, rtol=1e-8, atol=1e-8)


def test_density_weights_brute_force(spark):
    rng = np.random.default_rng(5)
    Y = np.r_[rng.normal(size=(150, 2)), rng.normal(size=(100, 2)) * 0.3 + [4, -3], [[30.0, 30.0]]]
    df = spark.createDataFrame([(f"s{i}", float(a), float(b)) for i, (a, b) in enumerate(Y)],
                               "subject string, a double, b double")
    got = {r.subject: r.weight for r in D.density_weights(df, ["a", "b"]).collect()}
    d2 = ((Y[:, None, :] - Y[None, :, :]) ** 2).sum(-1)
    dens = np.exp(-0.5 * d2).sum(1) / len(Y) / (2 * math.pi)
    for i, w in enumerate(-np.log(dens)):
        assert math.isclose(got[f"s{i}"], w, rel_tol=1e-12, abs_tol=1e-12)
    one = {r.subject: r.weight for r in D.density_weights(df, ["a"], bandwidth=0.5).collect()}
    d1 = (Y[:, None, 0] - Y[None, :, 0]) ** 2
    w1 = -np.log(np.exp(-0.5 * d1 / 0.25).sum(1) / len(Y) / math.sqrt(2 * math.pi) / 0.5)
    assert all(math.isclose(one[f"s{i}"], w1[i], rel_tol=1e-12) for i in range(len(Y)))


@pytest.mark.parametrize("d,scale", [(1, 0.2), (2, 0.3), (2, 500.0), (4, 2.0)])
def test_density_weights_any_spread(spark, d, scale):
    """Dense cells (moments), lone points, four targets, repeated points, gaps."""
    rng = np.random.default_rng(d)
    Y = np.r_[rng.normal(size=(700, d)) * scale, np.tile(rng.normal(size=d) * scale, (40, 1)), -np.ones((1, d)) * 7]
    names = [f"t{k}" for k in range(d)]
    rows = [(f"s{i}", *map(float, v)) for i, v in enumerate(Y)] + [("gap", None, *[1.0] * (d - 1)), ("nan", *[math.nan] * d)]
    df = spark.createDataFrame(rows, "subject string, " + ", ".join(f"{t} double" for t in names))
    got = {r.subject: r.weight for r in D.density_weights(df, names).collect()}
    assert len(got) == len(rows) and got.pop("gap") is None and got.pop("nan") is None
    dens = np.exp(-0.5 * ((Y[:, None, :] - Y[None, :, :]) ** 2).sum(-1)).sum(1) / len(Y) / (2 * math.pi) ** (d / 2)
    assert all(math.isclose(got[f"s{i}"], w, rel_tol=1e-11, abs_tol=1e-11) for i, w in enumerate(-np.log(dens)))


def test_density_weights_empty(spark):
    assert D.density_weights(spark.createDataFrame([], "subject string, a double"), ["a"]).count() == 0


def test_ledoit_wolf_formula(spark):
    rng = np.random.default_rng(7)
    T, p = 30, 6
    X = rng.normal(size=(T, p)) @ rng.normal(size=(p, p)) + 50
    rows = [("s", 0, t, r, float(X[t, r])) for t in range(T) for r in range(p)]
    sig = spark.createDataFrame(rows, "subject string, run int, t long, roi int, value double")
    got = {(r.i, r.j): r.r for r in S.shrunk_correlation_edges(sig, ["subject", "run"]).collect()}
    Xc = X - X.mean(0)
    Sm = Xc.T @ Xc / T
    mu = np.trace(Sm) / p
    beta_ = ((Xc ** 2).T @ (Xc ** 2)).sum()
    delta_ = (Sm ** 2).sum()
    beta = (beta_ / T - delta_) / (p * T)
    delta = (delta_ - 2 * mu * np.trace(Sm) + p * mu ** 2) / p
    s = 0.0 if min(beta, delta) == 0 else min(beta, delta) / delta
    C = (1 - s) * Sm + s * mu * np.eye(p)
    R = C / np.sqrt(np.outer(np.diag(C), np.diag(C)))
    for (i, j), v in got.items():
        assert math.isclose(v, R[i, j], rel_tol=1e-9)
    assert len(got) == p * (p - 1) // 2


def test_exact_percentiles(spark):
    rng = np.random.default_rng(11)
    v = np.r_[rng.normal(size=3000), np.zeros(500), np.ones(200)]
    df = spark.createDataFrame([(float(a),) for a in v], "z double")
    got = SP.exact_percentiles(df, "z", SP.QUANTILE_PROBS)
    assert np.allclose(got, np.percentile(v, np.array(SP.QUANTILE_PROBS) * 100), rtol=0, atol=1e-12)


def test_stratified_splits_sizes(spark):
    rows = [(f"s{i:03d}", i % 7) for i in range(103)]
    df = spark.createDataFrame(rows, "subject string, stratum int")
    m = SP.stratified_shuffle_splits(df, 4, seed=9).collect()
    for s in range(4):
        test = [r.subject for r in m if r.split == s and r.role == "test"]
        train = [r.subject for r in m if r.split == s and r.role == "train"]
        assert len(test) == math.ceil(0.2 * 103) and len(train) == 103 - len(test)
        assert not set(test) & set(train)
    assert len({tuple(sorted(r.subject for r in m if r.split == s and r.role == "test")) for s in range(4)}) == 4


def test_band_pass_projection(spark):
    rng = np.random.default_rng(13)
    n, tr = 64, 2.0
    x = rng.normal(size=n)
    df = spark.createDataFrame([("s", t, float(x[t])) for t in range(n)], "subject string, t long, value double")
    got = dict((r.t, r.value) for r in S.band_pass(df, ["subject"], tr).collect())
    k = np.arange(n)
    B = np.sqrt(2.0 / n) * np.cos(np.pi * np.outer(k, np.arange(n) + 0.5) / n)
    keep = (k / (2 * n * tr) >= 0.01) & (k / (2 * n * tr) <= 0.1) & (k > 0)
    want = B[keep].T @ (B[keep] @ x)
    assert np.allclose([got[t] for t in range(n)], want, atol=1e-12)


def test_weighted_r2_and_f1(spark):
    y = np.array([1.0, 2.0, 3.0, 4.0, 5.0, 2.0])
    p = np.array([1.5, 2.0, 2.0, 4.5, 4.0, 2.5])
    w = np.array([1.0, 2.0, 1.0, 0.5, 1.0, 3.0])
    df = spark.createDataFrame([("m", 0, float(a), float(b), float(c)) for a, b, c in zip(y, p, w)],
                               "modality string, split int, t double, t_pred double, w double")
    r = M.calc_metrics(df, ["t"], ["r2", "mae"], weight_col="w").first()
    ym = (w * y).sum() / w.sum()
    assert math.isclose(r.r2_t, 1 - (w * (y - p) ** 2).sum() / (w * (y - ym) ** 2).sum())
    assert math.isclose(r.mae_t, (w * abs(y - p)).sum() / w.sum())
    c = spark.createDataFrame([("m", 0, a, b, 1.0) for a, b in [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (2.0, 1.0)]],
                              "modality string, split int, t double, t_pred double, w double")
    f1 = M.calc_metrics(c, ["t"], ["f1"]).first().f1_t
    # class 0: tp1 fp1 fn0 -> 2/3; class 1: tp1 fp1 fn1 -> 1/2; class 2: 0
    assert math.isclose(f1, (2 / 3 + 1 / 2 + 0) / 3)


def test_regress_confounds_matches_lstsq(spark):
    rng = np.random.default_rng(17)
    T, R, k = 40, 5, 3
    rows, crow = [], []
    want = {}
    for run in range(2):
        X = rng.normal(size=(T, k)) + np.arange(T)[:, None] * 0.01
        Y = X @ rng.normal(size=(k, R)) + rng.normal(size=(T, R)) + 3.0
        # confounds are detrended and standardised per run before the regression
        A = np.c_[np.ones(T), np.arange(T)]
        Xd = X - A @ np.linalg.lstsq(A, X, rcond=None)[0]
        Xs = (Xd - Xd.mean(0)) / Xd.std(0)
        D = np.c_[np.ones(T), Xs]
        res = Y - D @ np.linalg.lstsq(D, Y, rcond=None)[0]
        for t in range(T):
            crow.append(("s", run, t, *map(float, X[t])))
            for r in range(R):
                rows.append(("s", run, t, r, float(Y[t, r])))
                want[(run, t, r)] = res[t, r]
    sig = spark.createDataFrame(rows, "subject string, run int, t long, roi int, value double")
    conf = spark.createDataFrame(crow, "subject string, run int, t long, c0 double, c1 double, c2 double")
    got = S.regress_confounds(sig, conf, ["subject", "run"], ["c0", "c1", "c2"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert math.isclose(r.value, want[(r.run, r.t, r.roi)], rel_tol=1e-8, abs_tol=1e-9)


def test_exact_percentiles_heavy_tie(spark):
    v = np.r_[np.full(4000, 7.0), np.arange(2000, dtype=float)]
    df = spark.createDataFrame([(float(a),) for a in v], "z double")
    got = SP.exact_percentiles(df, "z", SP.QUANTILE_PROBS)
    assert np.allclose(got, np.percentile(v, np.array(SP.QUANTILE_PROBS) * 100), rtol=0, atol=1e-12)


def _bayes_ridge_svd(X, y, max_iter=300, tol=1e-3, e=1e-6):
    Xc, yc = X - X.mean(0), y - y.mean()
    U, Sv, Vh = np.linalg.svd(Xc, full_matrices=False)
    eig = Sv ** 2
    xty = Xc.T @ yc
    alpha, lam, old = 1.0 / (np.var(yc) + np.finfo(float).eps), 1.0, None
    n = len(y)
    for it in range(max_iter):
        coef = Vh.T @ (Vh @ xty / (eig + lam / alpha))
        rmse = ((yc - Xc @ coef) ** 2).sum()
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2 * e) / (coef @ coef + 2 * e)
        alpha = (n - gamma + 2 * e) / (rmse + 2 * e)
        if it and np.abs(old - coef).sum() < tol:
            break
        old = coef
    return Vh.T @ (Vh @ xty / (eig + lam / alpha))


def test_bayesian_ridge_from_moments():
    rng = np.random.default_rng(23)
    X = rng.normal(size=(80, 4)) * [1, 5, 0.2, 3] + 10
    y = X @ [0.3, -0.1, 2.0, 0.0] + rng.normal(size=80)
    Xc, yc = X - X.mean(0), y - y.mean()
    got = L.bayesian_ridge(80.0, Xc.T @ Xc, Xc.T @ yc, float(yc @ yc))
    assert np.allclose(got, _bayes_ridge_svd(X, y), rtol=1e-8, atol=1e-10)


def test_iterative_impute_matches_numpy(spark):
    rng = np.random.default_rng(29)
    n, k = 60, 4
    X = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + 5
    miss = rng.random(size=(n, k)) < 0.15
    miss[:, 3] = False
    Xm = np.where(miss, np.nan, X)
    role = np.array(["train"] * 45 + ["test"] * 15)
    rows = spark.createDataFrame(
        [(0, f"s{i:02d}", role[i], [None if np.isnan(v) else float(v) for v in Xm[i]], [0.0]) for i in range(n)],
        "split int, subject string, role string, x array<double>, y array<double>")
    got = {r.subject: r.x for r in L.iterative_impute(rows, k, max_iter=10).collect()}
    # numpy version of the same algorithm
    tr = role == "train"
    F_ = np.where(np.isnan(Xm), np.nanmean(Xm[tr], axis=0), Xm)
    gaps = sorted([j for j in range(k) if np.isnan(Xm[tr, j]).any()], key=lambda j: (np.isnan(Xm[tr, j]).sum(), j))
    tol = 1e-3 * np.nanmax(np.abs(Xm[tr]))
    for _ in range(10):
        prev = F_.copy()
        for c in gaps:
            o = [j for j in range(k) if j != c]
            fit = tr & ~np.isnan(Xm[:, c])
            w = _bayes_ridge_svd(F_[fit][:, o], F_[fit][:, c])
            b = F_[fit][:, c].mean() - F_[fit][:, o].mean(0) @ w
            m = np.isnan(Xm[:, c])
            F_[m, c] = b + F_[m][:, o] @ w
        if np.abs(F_[tr] - prev[tr]).sum(1).max() < tol:
            break
    for i in range(n):
        assert np.allclose(got[f"s{i:02d}"], F_[i], rtol=1e-7, atol=1e-7)


def test_fused_detrend_standardize(spark):
    rng = np.random.default_rng(31)
    rows = [(s, t, float(v)) for s in ("a", "b") for t, v in enumerate(rng.normal(size=30) + np.arange(30) * 0.3 + 50)]
    rows += [("c", t, 2.0 + 0.5 * t) for t in range(10)]          # exact line: residual 0 -> 0
    df = spark.createDataFrame(rows, "subject string, t long, value double")
    a = {(r.subject, r.t): r.value for r in S.standardize(S.detrend(df, ["subject"]), ["subject"]).collect()}
    b = {(r.subject, r.t): r.value for r in S.detrend_standardize(df, ["subject"]).collect()}
    for k in a:
        if k[0] == "c":
            assert b[k] == 0.0
        else:
            assert math.isclose(a[k], b[k], rel_tol=1e-9, abs_tol=1e-9)


def test_permutation_importance_of_input_columns(spark):
    from cohortlens.plans import learning as LR
    rng = np.random.default_rng(37)
    n, k = 50, 3
    X = rng.normal(size=(n, k))
    Y = np.c_[X @ [1.0, 0.2, 0.0] + rng.normal(size=n) * 0.1, X @ [0.0, 1.0, 0.5]]
    names = ["f0", "f1", "f2"]
    x = spark.createDataFrame([(f"s{i:02d}", *X[i].tolist()) for i in range(n)] + [("t0", 0.0, 0.0, 0.0), ("t1", 1.0, 1.0, 1.0)],
                              "subject string, f0 double, f1 double, f2 double")
    y = spark.createDataFrame([(f"s{i:02d}", *Y[i].tolist()) for i in range(n)] + [("t0", 0.0, 0.0), ("t1", 1.0, 1.0)],
                              "subject string, ta double, tb double")
    members = x.select(F.lit(0).alias("split"), "subject", F.when(F.col("subject") < "t", "test").otherwise("train").alias("role"))
    coef = spark.createDataFrame([(0, 1.0, [1.0, 0.0, 0.2, 1.0, 0.0, 0.5], [0.0, 0.0])],
                                 "split int, alpha double, w array<double>, b array<double>")
    pred = lambda train, test: L.predict_linear(test, coef, 2, ["ta", "tb"])
    got = {r.feature: r.permutation_importance for r in
           LR.permutation_importance(x, names, y, ["ta", "tb"], members, pred).collect()}
    # brute force with the same md5 pairing
    import hashlib
    subj = [f"s{i:02d}" for i in range(n)]

    def r2(yv, p):
        return 1 - ((yv - p) ** 2).sum() / ((yv - yv.mean()) ** 2).sum()
    W = np.array([[1.0, 0.0], [0.2, 1.0], [0.0, 0.5]])
    base = np.mean([r2(Y[:, t], (X @ W)[:, t]) for t in range(2)])
    for j in range(3):
        sc = []
        for r in range(5):
            order = sorted(range(n), key=lambda i: (hashlib.md5(f"1234:0:{j}:{r}:{subj[i]}".encode()).hexdigest(), subj[i]))
            Xp = X.copy()
            Xp[:, j] = X[order, j]
            sc.append(np.mean([r2(Y[:, t], (Xp @ W)[:, t]) for t in range(2)]))
        assert math.isclose(got[f"f{j}"], base - np.mean(sc), rel_tol=1e-9, abs_tol=1e-12)


def test_gram_correlation_with_gaps_matches_self_join(spark):
    from cohortlens.operators import signal as S
    rng = np.random.default_rng(3)
    rows = []
    for run in range(2):
        for t in range(30):
            for r in range(4):
                if (t + r + run) % 7 == 0:
                    continue                                   # another set of regions at each time point
                rows.append((run, t, r, None if (t + 2 * r) % 11 == 0 else float(rng.normal()) + 0.4 * t * (r < 2)))
    df = spark.createDataFrame(rows, "run int, t int, roi int, value double")
    got = {(x["run"], x["i"], x["j"]): x["r"] for x in S.correlation_edges_gram(df, ["run"]).collect()}
    pdf = df.toPandas()
    for run in range(2):
        wide = pdf[pdf.run == run].pivot(index="t", columns="roi", values="value")
        expected = wide.corr()
        for i in range(4):
            for j in range(i + 1, 4):
                assert abs(got[run, i, j] - expected.loc[i, j]) < 1e-9
    with pytest.raises(Exception, match="every region"):
        S.shrunk_correlation_edges_gram(df, ["run"]).collect()


def test_learning_curve_sizes_follow_the_first_fold(spark):
    from cohortlens.operators import models as ML
    base = spark.createDataFrame([(f"s{i:03d}",) for i in range(62)], "subject string")
    m = ML.learning_curve_members(base).filter("role = 'train'")
    sizes = {(r["size_idx"], r["n"]) for r in m.groupBy("split", "size_idx").count().selectExpr("size_idx", "`count` n").collect()}
    assert len(sizes) == len({s for s, _ in sizes})            # one size for all folds


def test_null_stratum_is_a_stratum(spark):
    from cohortlens.operators import splits as SP
    rows = [(f"s{i:03d}", None if i < 20 else i % 2) for i in range(60)]
    m = SP.stratified_shuffle_splits(spark.createDataFrame(rows, "subject string, stratum int"), 1)
    roles = [r["role"] for r in m.filter("subject < 's020'").collect()]
    assert roles.count("train") == 16 and roles.count("test") == 4


def test_feature_batches_are_kept(spark, tmp_path):
    from cohortlens.sources import sinks as SNK
    out = str(tmp_path / "features")
    for batch, subject in (("a", "s1"), ("b", "s2"), ("b", "s2")):
        rows = [(subject, "t1", "fs", "f", 1.0)]
        SNK.write_features(spark.createDataFrame(rows, "subject string, session string, kind string, name string, value double"), out, batch)
    assert sorted(r["subject"] for r in spark.read.parquet(out).collect()) == ["s1", "s2"]


def test_permuted_predictions_need_their_column(spark, tmp_path):
    from cohortlens.sources import files as SRC
    out = str(tmp_path / "pred")
    spark.createDataFrame([("m", "A", "s1", 1.0)], "model string, modality string, subject string, p double").write.parquet(out)
    assert SRC.load_predictions(spark, out, "m", ["A"]).count() == 1
    with pytest.raises(ValueError, match="permuted"):
        SRC.load_predictions(spark, out, "m", ["A"], permuted=True)
