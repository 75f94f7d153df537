"""Band-pass of long series in blocks against the projection written out."""

import math

import numpy as np
import pytest

from cohortlens.operators import long_series as LS
from cohortlens.operators import signal as S


def projected(x, tr, low, high):
    n, k = len(x), np.arange(len(x))
    basis = np.sqrt(2.0 / n) * np.cos(np.pi * np.outer(k, np.arange(n) + 0.5) / n)
    keep = (k / (2.0 * n * tr) >= low) & (k / (2.0 * n * tr) <= high) & (k > 0)
    return basis[keep].T @ (basis[keep] @ x)


def table(spark, sizes, gaps=True):
    rng = np.random.default_rng(4)
    rows = [(f"s{k}" if k else None, 3 * t, None if gaps and t % 13 == 5 else float(rng.normal()), f"{k}-{t}")
            for k, n in enumerate(sizes) for t in range(n)]
    return rows, spark.createDataFrame(rows, "s string, t long, value double, tag string").repartition(5)


def holds(rows, got, sizes, tr, low, high):
    assert len(got) == len(rows)
    for k, n in enumerate(sizes):
        want = projected(np.array([r[2] or 0.0 for r in rows if r[3].startswith(f"{k}-")]), tr, low, high)
        for i in range(n):
            s, t, v = got[f"{k}-{i}"]
            assert s == (f"s{k}" if k else None) and t == 3 * i and math.isclose(v, want[i], abs_tol=1e-10)


@pytest.mark.parametrize("block", [8, 60, 1 << 20])
def test_blocks_of_any_size_give_the_projection(spark, block):
    """Lengths 1, 2, primes, powers; a NULL key; gaps as zero; the block never changes the result."""
    sizes = [97, 1, 2, 3, 64, 250]
    rows, df = table(spark, sizes)
    got = {r.tag: (r.s, r.t, r.value) for r in LS.band_pass_long(df, ["s"], 2.0, block_points=block).collect()}
    holds(rows, got, sizes, 2.0, 0.01, 0.1)


def test_band_pass_sends_long_series_to_blocks(spark):
    """Series above the limit are cut, the others stay whole, columns and types stay."""
    sizes = [300, 7, 40, 41]
    rows, df = table(spark, sizes)
    out = S.band_pass(df, ["s"], 2.0, whole_points=40)
    assert out.schema.simpleString() == df.schema.simpleString()
    holds(rows, {r.tag: (r.s, r.t, r.value) for r in out.collect()}, sizes, 2.0, 0.01, 0.1)
    whole = {r.tag: r.value for r in S.band_pass(df, ["s"], 2.0).collect()}
    assert max(abs(whole[r.tag] - r.value) for r in out.collect()) < 1e-10


def test_no_block_above_its_size(spark):
    """A series of 10^9 points takes blocks of the asked size in every step."""
    n1, n2, cols, rows = LS.layout(10**9, LS.BLOCK_POINTS)
    assert n1 * n2 >= 3 * 10**9 and n1 * cols <= LS.BLOCK_POINTS and n2 * rows <= LS.BLOCK_POINTS
    for n in (1, 2, 3, 10, 12345):
        n1, n2, _, _ = LS.layout(n, 100)
        assert n1 * n2 >= 3 * n and n2 <= 2 * n


def test_kernel_of_long_series_keeps_its_digits():
    """Angles far beyond one turn: the closed form against the sum, by exact angles."""
    n, a, b = 10**9, 3, 40
    m = np.array([0, 1, 12345, 10**9, 2 * 10**9 - 1, -(10**9) + 1], np.int64)
    want = sum(np.cos(np.pi * ((k * m) % (2 * n)) / n) for k in range(a, b + 1)) / n
    assert np.allclose(LS.kernel(m, n, a, b), want, rtol=1e-12, atol=1e-22)


def test_empty_tables_and_empty_bands(spark):
    rows, df = table(spark, [30])
    assert LS.band_pass_long(df.limit(0), ["s"], 2.0).count() == 0
    assert S.band_pass(df.limit(0), ["s"], 2.0).count() == 0
    assert all(r.value == 0.0 for r in LS.band_pass_long(df, ["s"], 2.0, 0.2499, 0.24995, block_points=20).collect())
