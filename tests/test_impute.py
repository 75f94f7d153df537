"""Iterative imputation against numpy: many columns, splits, hot gap patterns, both routes."""

import numpy as np
import pytest

from cohortlens.operators import linear as L
from test_numeric import _bayes_ridge_svd

SCHEMA = "split int, subject string, role string, x array<double>, y array<double>"


def numpy_impute(X, train, max_iter=10):
    """The steps on the rows themselves; also the number of rounds."""
    F_ = np.where(np.isnan(X), np.nanmean(X[train], axis=0), X)
    gaps = sorted([j for j in range(X.shape[1]) if np.isnan(X[train, j]).any()], key=lambda j: (np.isnan(X[train, j]).sum(), j))
    tol = 1e-3 * np.nanmax(np.abs(X[train]))
    for r in range(max_iter):
        prev = F_.copy()
        for c in gaps:
            o = [j for j in range(X.shape[1]) if j != c]
            fit, m = train & ~np.isnan(X[:, c]), np.isnan(X[:, c])
            w = _bayes_ridge_svd(F_[fit][:, o], F_[fit][:, c])
            F_[m, c] = F_[fit][:, c].mean() + (F_[m][:, o] - F_[fit][:, o].mean(0)) @ w
        if np.abs(F_[train] - prev[train]).sum(1).max() < tol:
            break
    return F_, r + 1


def as_rows(X, train, split=0):
    return [(split, f"s{i:05d}", "train" if train[i] else "test", [None if np.isnan(v) else float(v) for v in X[i]], [0.0])
            for i in range(len(X))]


def study(n, k, gap_columns, share, seed, patterns=None):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3)) @ rng.normal(size=(3, k)) + 0.3 * rng.normal(size=(n, k)) + rng.normal(size=k) * 4
    miss = np.zeros((n, k), bool)
    miss[:, :gap_columns] = rng.random((n, gap_columns)) < share
    if patterns is not None:
        miss = np.zeros((n, k), bool)
        for i in range(n):
            miss[i, patterns[rng.integers(len(patterns))]] = True
    return np.where(miss, np.nan, X), rng.random(n) < 0.8


def check(got, X, expected, split=0):
    found = {(r.split, r.subject): r.x for r in got}
    for i in range(len(X)):
        assert np.allclose(found[split, f"s{i:05d}"], expected[i], rtol=1e-6, atol=1e-6)


def test_sixty_two_gap_columns(spark):
    X, train = study(260, 70, 62, 0.02, 1)
    df = spark.createDataFrame(as_rows(X, train), SCHEMA)
    got = L.iterative_impute(df, 70).collect()
    assert len(got) == len(X)
    check(got, X, numpy_impute(X, train)[0])


@pytest.mark.parametrize("options", [{}, {"state_bytes": 0}])
def test_splits_stop_by_themselves(spark, options):
    rows, expected, rounds = [], [], set()
    for split, (share, k) in enumerate(((0.02, 4), (0.4, 4), (0.0, 4))):
        X, train = study(80, k, 3, share, 5 + split)
        full, n = numpy_impute(X, train) if np.isnan(X).any() else (X, 0)
        rows += as_rows(X, train, split)
        expected.append((X, full))
        rounds.add(n)
    got = L.iterative_impute(spark.createDataFrame(rows, SCHEMA), 4, **options).collect()
    assert len(got) == len(rows) and len(rounds) == 3
    for split, (X, full) in enumerate(expected):
        check(got, X, full, split)


def test_hot_pattern_is_compressed(spark):
    patterns = [[], [0], [0], [0, 2], [1]]
    X, train = study(4000, 4, 3, 0, 9, patterns)
    df = spark.createDataFrame(as_rows(X, train), SCHEMA).repartition(4)
    parts = df.filter("role = 'train'").select("split", "x").coalesce(2).mapInArrow(
        L._compressed(4), "split int, u double, x array<double>, is_row boolean, amax double").collect()
    assert len(parts) <= 2 * 4 * 21 and not all(r.is_row for r in parts)
    assert abs(sum(r.u ** 2 for r in parts) - train.sum()) < 1e-6
    check(L.iterative_impute(df, 4).collect(), X, numpy_impute(X, train)[0])


def test_columns_without_values_or_with_gaps_in_test_rows_alone(spark):
    X, train = study(60, 4, 2, 0.2, 3)
    X[:, 2] = np.nan                                    # no value at all: zeros
    X[train, 3] = np.arange(train.sum())
    X[np.flatnonzero(~train)[:3], 3] = np.nan           # gaps in test rows alone: the train mean
    for options in ({}, {"state_bytes": 0}):
        got = {r.subject: r.x for r in L.iterative_impute(spark.createDataFrame(as_rows(X, train), SCHEMA), 4, **options).collect()}
        assert len(got) == 60 and all(x[2] == 0.0 for x in got.values())
        mean = X[train, 3].mean()
        assert all(abs(got[f"s{i:05d}"][3] - mean) < 1e-9 for i in np.flatnonzero(~train)[:3])
        assert all(v is not None and np.isfinite(v) for x in got.values() for v in x)


def test_n_nearest_takes_the_most_correlated(spark):
    X, train = study(120, 6, 2, 0.2, 4)
    df = spark.createDataFrame(as_rows(X, train), SCHEMA)
    a = {r.subject: r.x for r in L.iterative_impute(df, 6, max_iter=2, n_nearest=2).collect()}
    b = {r.subject: r.x for r in L.iterative_impute(df, 6, max_iter=2, n_nearest=2, state_bytes=0).collect()}
    assert all(np.allclose(a[s], b[s], rtol=1e-7, atol=1e-7) for s in a)
