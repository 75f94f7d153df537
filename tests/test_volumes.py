"""Smoothed volumes to region series against numpy."""

import numpy as np
import pytest

from cohortlens.operators import signal as S

SHAPE = (6, 9, 5)
BOX = ((0, 5), (-4, 4), (10, 14))
VOXELS = "run string, t long, x int, y int, z int, value double"


def _smooth(img, fwhm):
    """Gaussian along each axis, the image mirrored at its border."""
    kernel = np.array([k for _, k in S.smoothing_kernel(fwhm)])
    rad = len(kernel) // 2
    for axis in range(3):
        wide = np.pad(img, [(rad, rad) if a == axis else (0, 0) for a in range(3)], mode="symmetric")
        img = np.apply_along_axis(lambda v: np.convolve(v, kernel, mode="valid"), axis, wide)
    return img


def _frame(spark, img, mask=None):
    rows = [(run, t, BOX[0][0] + x, BOX[1][0] + y, BOX[2][0] + z, float(v[x, y, z])) for (run, t), v in img.items()
            for x, y, z in np.ndindex(SHAPE) if mask is None or mask[x, y, z]]
    return spark.createDataFrame(rows, VOXELS)


def _roi(spark, at):
    return spark.createDataFrame([(i, *map(int, p)) for i, p in enumerate(at)], "roi long, x int, y int, z int")


@pytest.mark.parametrize("fwhm", [1.0, 3.0, 8.0])
def test_region_series_matches_smoothed_volumes(spark, fwhm):
    """Also with a kernel wider than the grid (several reflections) and regions at its corners."""
    rng = np.random.default_rng(0)
    img = {(run, t): rng.normal(size=SHAPE) + 10 for run in ("a", None) for t in range(3)}
    mask = rng.random(SHAPE) < 0.7
    at = [(0, -4, 10), (5, 4, 14), (3, 0, 12), (40, 0, 12)]
    grid = np.array(list(np.ndindex(SHAPE))) + [b[0] for b in BOX]
    inside = spark.createDataFrame([(int(x), int(y), int(z)) for (x, y, z), m in zip(grid, mask.ravel()) if m],
                                   "x int, y int, z int")
    got = {(r.run, r.t, r.roi): (r.value, r.empty)
           for r in S.region_series(_roi(spark, at), _frame(spark, img), 2.0, fwhm, ["run"], BOX, mask=inside).collect()}
    assert len(got) == 6 * len(at)
    for (run, t), v in img.items():
        smooth = _smooth(v, fwhm).ravel()
        for i, p in enumerate(at):
            near = (((grid - p) ** 2).sum(1) <= 4.0) & mask.ravel()
            value, empty = got[run, t, i]
            assert empty == (not near.any())
            assert abs(value - (smooth[near].mean() if near.any() else 0.0)) < 1e-9


def test_absent_voxels_count_as_zero(spark):
    rng = np.random.default_rng(1)
    img, mask = {("a", 0): rng.normal(size=SHAPE)}, rng.random(SHAPE) < 0.3
    at = [(2, 0, 12)]
    got = S.region_series(_roi(spark, at), _frame(spark, img, mask), 2.0, 2.0, ["run"], BOX).first()
    grid = np.array(list(np.ndindex(SHAPE))) + [b[0] for b in BOX]
    near = (((grid - at[0]) ** 2).sum(1) <= 4.0) & mask.ravel()
    assert abs(got.value - _smooth(np.where(mask, img["a", 0], 0.0), 2.0).ravel()[near].mean()) < 1e-9


def test_more_empty_regions_than_allowed_stop_the_job(spark):
    img = {("a", t): np.ones(SHAPE) for t in range(2)}
    voxels = _frame(spark, img)
    at = [(2, 0, 12)] + [(50 + k, 0, 12) for k in range(11)]
    with pytest.raises(Exception, match="11 regions hold no voxel; at most 10"):
        S.region_series(_roi(spark, at), voxels, 2.0, 2.0, ["run"], BOX).collect()
    rows = S.region_series(_roi(spark, at[:-1]), voxels, 2.0, 2.0, ["run"], BOX).collect()
    assert len(rows) == 22 and sum(r.empty for r in rows) == 20
    assert all(abs(r.value - (0.0 if r.empty else 1.0)) < 1e-9 for r in rows)


def test_no_volumes(spark):
    voxels = spark.createDataFrame([], VOXELS)
    assert S.region_series(_roi(spark, [(2, 0, 12)]), voxels, 2.0, 2.0, ["run"], BOX).count() == 0
