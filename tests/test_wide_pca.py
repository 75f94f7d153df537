"""PCA of wide blocks against the k x k form and numpy."""

import numpy as np
import pytest

from cohortlens.operators import linear as L
from cohortlens.operators import models as ML
from cohortlens.operators.wide_pca import pca_scores

SCHEMA = "split int, subject string, role string, x array<double>"


def _rows(x, splits=1, n_train=None):
    n_train = n_train or len(x) - 3
    return [(s, f"s{i:03d}", "train" if (i + s) % len(x) < n_train else "test", x[i].tolist())
            for s in range(splits) for i in range(len(x))]


@pytest.mark.parametrize("column_block", [4, 25, 1000])
def test_scores_equal_the_column_form(spark, column_block):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(17, 40)) * 10.0 ** rng.integers(-2, 3, 40) + 5
    x[:, 7] = 3.0                                              # constant
    rows = spark.createDataFrame(_rows(x, splits=2), SCHEMA)
    fitted = L.pca_fit(rows.filter("role = 'train'"), 4)
    want = {(r.split, r.subject): r.pc for r in L.pca_transform(rows, fitted, "x", "pc").collect()}
    got = {(r.split, r.subject): r.pc for r in pca_scores(rows, 4, column_block=column_block).collect()}
    assert set(got) == set(want) and len(got) == 34
    for key, v in got.items():
        assert np.allclose(v, want[key], rtol=1e-8, atol=1e-8)


def test_components_beyond_the_rank_are_zero(spark):
    x = np.random.default_rng(1).normal(size=(6, 30))
    rows = spark.createDataFrame(_rows(x, n_train=3), SCHEMA)
    for r in pca_scores(rows, 5, column_block=8).collect():
        assert len(r.pc) == 5 and max(abs(v) for v in r.pc[2:]) == 0.0


def test_errors_and_empty(spark):
    x = np.random.default_rng(2).normal(size=(6, 9))
    rows = _rows(x)
    gap = rows[:-1] + [(0, "z", "test", [None] + x[0, 1:].tolist())]
    for bad, text in ((gap, "every column"), (rows + rows[:1], "twice"),
                      ([r[:2] + ("test",) + r[3:] for r in rows], "train rows")):
        with pytest.raises(Exception, match=text):
            pca_scores(spark.createDataFrame(bad, SCHEMA), 2, column_block=4).collect()
    assert pca_scores(spark.createDataFrame([], SCHEMA), 2).count() == 0


def test_prepare_takes_the_wide_form(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 33))
    rows = spark.createDataFrame(_rows(x), SCHEMA)
    names = [f"v{i}" for i in range(33)]
    block = list(range(2, 30)) + [31]

    def run():
        out, found = ML.prepare(rows, pca_block=block, n_components=3, feature_names=names)
        return found, {r.subject: r.x for r in out.collect()}

    narrow = run()
    monkeypatch.setattr(ML, "WIDE_BLOCK", 10)
    wide = run()
    assert narrow[0] == wide[0] == ["fmri__pca_0", "fmri__pca_1", "fmri__pca_2", "v0", "v1", "v30", "v32"]
    for s, v in narrow[1].items():
        assert np.allclose(v, wide[1][s], rtol=1e-8, atol=1e-8)


def test_query_over_all_edges_matches_numpy(spark):
    from cohortlens.plans.registry import QUERIES
    from cohortlens.sources import tables as V
    from conftest import SF001
    pdf = V.signal(spark, SF001).toPandas()
    x = {}
    for (subject, run), g in pdf.groupby(["subject", "run"]):
        r = np.corrcoef(g.pivot(index="t", columns="roi", values="value").to_numpy().T)
        x[f"{subject}_{run}"] = r[np.triu_indices(64, 1)]
    got = {(r.split, r.subject, r.component): r.value for r in QUERIES["ml_pca_wide"](spark, SF001).collect()}
    assert len(got) == 2 * len(x) * 3
    for split in range(2):
        train = np.array([x[s] for s in sorted(x) if s.endswith(f"_{split}")])
        mean, sd = train.mean(0), train.std(0)
        v = np.linalg.svd((train - mean) / sd, full_matrices=False)[2][:3]
        v = v * np.sign(v[np.arange(3), np.abs(v).argmax(axis=1)])[:, None]
        for s in x:
            want = v @ ((x[s] - mean) / sd)
            assert np.allclose([got[split, s, c] for c in range(3)], want, atol=2e-6)
