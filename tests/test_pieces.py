"""Runs in pieces of time against whole runs in numpy."""

import math

import numpy as np
import pytest

from cohortlens.operators import signal as S


def _frame(spark, x, run=0, keep=lambda t, r: True):
    """(run, t, roi, value) of a matrix; None for NaN."""
    return [(run, t, r, None if np.isnan(x[t, r]) else float(x[t, r]))
            for t in range(x.shape[0]) for r in range(x.shape[1]) if keep(t, r)]


SCHEMA = "run int, t long, roi int, value double"


@pytest.mark.parametrize("piece_points", [1, 7, 32, 10_000])
def test_correlation_by_pieces_equals_whole_run(spark, piece_points):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) + [1e6, 0, 3, -50, 0]
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 4] = 2.5                                              # constant: no correlation
    df = spark.createDataFrame(_frame(spark, x), SCHEMA)
    got = {(r.i, r.j): r.r for r in S.correlation_edges_gram(df, ["run"], piece_points=piece_points).collect()}
    assert len(got) == 10
    for (i, j), r in got.items():
        if j == 4:
            assert r is None
        else:
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-8


def test_one_run_over_many_tasks_gives_the_same_edges(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(640, 6)) @ rng.normal(size=(6, 6)) + 100
    df = spark.createDataFrame(_frame(spark, x), SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        plain = {(r.i, r.j): r.r for r in S.correlation_edges_gram(df, ["run"], piece_points=20).collect()}
        shrunk = {(r.i, r.j): r.r for r in S.shrunk_correlation_edges_gram(df, ["run"], piece_points=20).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = {(r.i, r.j): r.r for r in S.shrunk_correlation_edges_gram(df, ["run"]).collect()}
    expected = np.corrcoef(x.T)
    assert len(plain) == len(shrunk) == len(whole) == 15
    for (i, j), r in plain.items():
        assert abs(r - expected[i, j]) < 1e-12
        assert abs(shrunk[i, j] - whole[i, j]) < 1e-12


def _ledoit_wolf(x):
    x = x - x.mean(0)
    n, p = x.shape
    cov = x.T @ x / n
    mu = np.trace(cov) / p
    delta = ((cov - mu * np.eye(p)) ** 2).sum() / p
    beta = sum(((np.outer(a, a) - cov) ** 2).sum() for a in x) / (n * n * p)
    s = min(beta, delta) / delta
    cov = (1 - s) * cov + s * mu * np.eye(p)
    return cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov)))


@pytest.mark.parametrize("piece_points", [1, 9, 1000])
def test_shrunk_correlation_by_pieces(spark, piece_points):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(30, 12)) + 40, rng.normal(size=(50, 3)) + np.linspace(0, 30, 50)[:, None]
    df = spark.createDataFrame(_frame(spark, a, 0) + _frame(spark, b, 1), SCHEMA)
    got = {(r.run, r.i, r.j): r.r
           for r in S.shrunk_correlation_edges_gram(df, ["run"], piece_points=piece_points).collect()}
    assert len(got) == 66 + 3
    for run, x in ((0, a), (1, b)):
        want = _ledoit_wolf(x)
        assert all(abs(r - want[i, j]) < 1e-10 for (k, i, j), r in got.items() if k == run)


def test_region_missing_in_one_piece_is_an_error(spark):
    x = np.random.default_rng(4).normal(size=(40, 4))
    df = spark.createDataFrame(_frame(spark, x, keep=lambda t, r: r < 3 or t < 20), SCHEMA)
    with pytest.raises(Exception, match="every region"):
        S.shrunk_correlation_edges_gram(df, ["run"], piece_points=10).collect()
    assert len(S.correlation_edges_gram(df, ["run"], piece_points=10).collect()) == 6


def test_pairs_without_a_common_time_point_and_double_rows(spark):
    x = np.random.default_rng(5).normal(size=(20, 2))
    apart = spark.createDataFrame(_frame(spark, x, keep=lambda t, r: (t < 10) == (r == 0)), SCHEMA)
    assert S.correlation_edges_gram(apart, ["run"]).count() == 0
    twice = spark.createDataFrame(_frame(spark, x) + [(0, 0, 0, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="two rows"):
        S.correlation_edges_gram(twice, ["run"]).collect()


def test_empty_and_null_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    conf = spark.createDataFrame([], "run int, t long, c double")
    assert S.correlation_edges_gram(empty, ["run"]).count() == 0
    assert S.shrunk_correlation_edges_gram(empty, ["run"]).count() == 0
    assert S.regress_confounds(empty, conf, ["run"], ["c"]).count() == 0
    x = np.random.default_rng(6).normal(size=(12, 3))
    rows = [(None, *r[1:]) for r in _frame(spark, x)]          # NULL run: a run of its own
    df = spark.createDataFrame(rows + [(None, None, 0, 1.0), (None, 0, None, 1.0)], SCHEMA)
    got = S.correlation_edges_gram(df, ["run"]).collect()
    assert len(got) == 3 and all(r.run is None for r in got)
    conf = spark.createDataFrame([(None, t, float(t * t)) for t in range(12)], "run int, t long, c double")
    assert S.regress_confounds(df, conf, ["run"], ["c"]).count() == 36


def _cleaned(y, c):
    a = np.c_[np.ones(len(c)), np.arange(len(c))]
    c = c - a @ np.linalg.lstsq(a, c, rcond=None)[0]
    sd = c.std(0)
    c = np.c_[np.ones(len(c)), c[:, sd > 1e-9] / sd[sd > 1e-9]]
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    u = u[:, s > 1e-8 * s[0]]
    return y - u @ (u.T @ y)


@pytest.mark.parametrize("piece_points", [8, 50, 100_000])
def test_36_confounds_of_deficient_rank_by_pieces(spark, piece_points):
    """Two of the confounds repeat others, one is constant, one a line over time."""
    rng = np.random.default_rng(7)
    n, p, k = 300, 70, 36
    c = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-3, 4, k) + rng.normal(size=k) * 100
    c[:, 5], c[:, 11], c[:, 20], c[:, 30] = c[:, 4] * 3 + 1, c[:, 2] - c[:, 9], 7.0, np.arange(n) * 0.5
    y = rng.normal(size=(n, p)) + rng.normal(size=(n, k)) @ rng.normal(size=(k, p)) + 1000
    y += ((c - c.mean(0)) / c.std(0).clip(1e-3)) @ rng.normal(size=(k, p))
    y[:, 3] = c[:, 0] * 2.0 + 5.0                              # all of it explained up to its line
    want = _cleaned(y, c)
    names = [f"c{m}" for m in range(k)]
    sig = spark.createDataFrame(_frame(spark, y), SCHEMA)
    conf = spark.createDataFrame([(0, t, *map(float, c[t])) for t in range(n)],
                                 "run int, t long, " + ", ".join(f"{m} double" for m in names))
    got = np.full((n, p), np.nan)
    for r in S.regress_confounds(sig, conf, ["run"], names, piece_points=piece_points).collect():
        got[r.t, r.roi] = r.value
    scale = y.std(0)
    assert np.abs((got - want) / scale).max() < 1e-7
    # residuals of the same data in pieces and as a whole are orthogonal to every detrended confound
    det = c - np.polynomial.polynomial.polyval(np.arange(n), np.polynomial.polynomial.polyfit(np.arange(n), c, 1)).T
    used = det.std(0) > 1e-9
    assert np.abs(got[:, 4:].T @ (det[:, used] / np.linalg.norm(det[:, used], axis=0))).max() < 1e-5


def test_gaps_of_confounds_are_errors(spark):
    y = np.random.default_rng(8).normal(size=(20, 2))
    sig = spark.createDataFrame(_frame(spark, y), SCHEMA)
    for rows in ([(0, t, float(t % 3)) for t in range(19)], [(0, t, None if t == 4 else 1.0) for t in range(20)],
                 [(0, t % 20, float(t)) for t in range(21)]):
        conf = spark.createDataFrame(rows, "run int, t long, c double")
        with pytest.raises(Exception, match="run \\(0,\\)"):
            S.regress_confounds(sig, conf, ["run"], ["c"], piece_points=6).collect()


def test_confounds_limited_to_a_band(spark):
    rng = np.random.default_rng(9)
    n = 120
    y, c = rng.normal(size=(n, 3)).cumsum(0), rng.normal(size=(n, 2)).cumsum(0)
    sig = spark.createDataFrame(_frame(spark, y), SCHEMA)
    conf = spark.createDataFrame([(0, t, *map(float, c[t % n])) for t in range(n + 5)], "run int, t long, a double, b double")
    band = (2.0, 0.01, 0.1)
    got = np.zeros((n, 3))
    for r in S.regress_confounds(sig, conf, ["run"], ["a", "b"], band=band, piece_points=25).collect():
        got[r.t, r.roi] = r.value
    a = np.c_[np.ones(n), np.arange(n)]
    d = c - a @ np.linalg.lstsq(a, c, rcond=None)[0]
    k = np.arange(n)
    basis = np.sqrt(2.0 / n) * np.cos(np.pi * np.outer(k, np.arange(n) + 0.5) / n)
    keep = (k / (2 * n * 2.0) >= 0.01) & (k / (2 * n * 2.0) <= 0.1) & (k > 0)
    x = np.c_[np.ones(n), basis[keep].T @ (basis[keep] @ (d / d.std(0)))]
    assert np.abs(got - (y - x @ np.linalg.lstsq(x, y, rcond=None)[0])).max() < 1e-8


def test_band_pass_over_batches_and_many_series(spark):
    """Series longer and shorter than an Arrow batch, gaps as zero, other columns kept."""
    rng = np.random.default_rng(10)
    sizes = [3, 250, 1, 40, 97]
    rows = [(f"s{k}" if k else None, t, None if t % 31 == 5 else float(rng.normal()), f"{k}-{t}")
            for k, n in enumerate(sizes) for t in range(n)]
    df = spark.createDataFrame(rows, "s string, t long, value double, tag string").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "32")
    try:
        got = {r.tag: (r.s, r.t, r.value) for r in S.band_pass(df, ["s"], 2.0).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(rows)
    for k, n in enumerate(sizes):
        x = np.array([0.0 if r[2] is None else r[2] for r in rows if r[3].startswith(f"{k}-")])
        f = np.arange(n)
        basis = np.sqrt(2.0 / n) * np.cos(np.pi * np.outer(f, np.arange(n) + 0.5) / n)
        keep = (f / (4.0 * n) >= 0.01) & (f / (4.0 * n) <= 0.1) & (f > 0)
        want = basis[keep].T @ (basis[keep] @ x)
        for t in range(n):
            s, at, v = got[f"{k}-{t}"]
            assert s == (f"s{k}" if k else None) and at == t and math.isclose(v, want[t], abs_tol=1e-10)
