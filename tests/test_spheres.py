"""Sphere joins: the side that is broadcast, both join paths, regions of any id."""

import itertools
import random

from cohortlens.operators import signal as S


def _tables(spark):
    rnd = random.Random(5)
    points = [(x, y, z) for x, y, z in itertools.product(range(6), range(-4, 4), range(5)) if rnd.random() < 0.6]
    rois = [(k, rnd.randint(-3, 9), rnd.randint(-8, 8), rnd.randint(0, 6)) for k in range(40)] + [(40, None, 0, 0), (3, 90, 0, 0)]
    return points, rois, spark.createDataFrame(points, "x int, y int, z int"), spark.createDataFrame(rois, "roi int, x int, y int, z int")


def _near(points, rois, radius):
    return sorted((r, *p) for r, *c in rois if None not in c for p in points
                  if sum((a - b) ** 2 for a, b in zip(p, c)) <= radius * radius)


def test_members_by_broadcast_points_and_by_shuffle(spark, monkeypatch):
    points, rois, pts, roi = _tables(spark)
    want = _near(points, rois, 2.5)
    assert sorted(map(tuple, S.sphere_members(roi, pts, 2.5).collect())) == want
    monkeypatch.setattr(S, "POINTS_HELD", 3)
    assert sorted(map(tuple, S.sphere_members(roi, pts, 2.5).collect())) == want


def test_centres_are_not_broadcast(spark, monkeypatch):
    """The 27 copies of every centre do not count in the planner's estimate."""
    _, _, pts, roi = _tables(spark)
    for held in (S.POINTS_HELD, 3):
        monkeypatch.setattr(S, "POINTS_HELD", held)
        for df in (S.sphere_members(roi, pts, 2.5), S.roi_means(roi, pts.selectExpr("*", "1.0D AS value"), 2.5)):
            plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
            at = [k for k, line in enumerate(plan) if "BroadcastExchange" in line]
            assert len(at) == (1 if held > 3 else 0)
            for k in at:
                depth = plan[k].index("BroadcastExchange")
                below = itertools.takewhile(lambda line: len(line) > depth and line[depth - 1] in " :+-", plan[k + 1:])
                assert not any("Generate" in line for line in below)


def test_empty_and_means_by_region_id(spark):
    points, rois, pts, roi = _tables(spark)
    held = {row[0] for row in _near(points, rois, 2.5)}
    got = S.empty_rois(roi, pts, 2.5)
    assert sorted(r["roi"] for r in got.collect()) == sorted(r for r, *_ in rois if r not in held)
    vox = spark.createDataFrame([(*p, float(k % 7)) for k, p in enumerate(points + points[:20])], "x int, y int, z int, value double")
    means = {r["roi"]: (r["n_voxels"], r["value"]) for r in S.roi_means(roi, vox, 2.5).collect()}
    keyed = S.roi_means(roi, vox.selectExpr("'a' AS subject", "*"), 2.5, keys=["subject"])
    assert {r["roi"]: (r["n_voxels"], r["value"]) for r in keyed.collect()} == means and set(means) == held
