"""Box numbers of groups that are spread over partitions, against pandas."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortlens.operators import metrics as M


def brute(x, whisker=1.5):
    x = np.sort(np.array([v for v in x if v is not None], float))
    if not len(x):
        return (0, None, None, None, None, None, 0)
    q = np.quantile(x, [0.25, 0.5, 0.75])
    lo, hi = q[0] - whisker * (q[2] - q[0]), q[2] + whisker * (q[2] - q[0])
    inside = x[(x >= lo) & (x <= hi)]
    return (len(x), *q, inside.min(), inside.max(), int(((x < lo) | (x > hi)).sum()))


def rows_of(spark, groups):
    rows = [("a", g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "target string, modality string, r2 double").repartition(6)


def test_box_numbers_of_skewed_groups(spark):
    """One group with nearly all rows, ties, gaps, single values, a group of gaps only."""
    rng = np.random.default_rng(8)
    groups = {"hot": [float(v) for v in rng.normal(size=3000)] + [None] * 7 + [40.0, -40.0],
              "ties": [1.0] * 50 + [2.0] * 50 + [9.0], "one": [3.5], "two": [1.0, 2.0],
              "gaps": [None, None], "rest": [float(v) for v in rng.integers(0, 5, 33)]}
    got = {r.modality: r for r in M.box_summary(rows_of(spark, groups), "r2").collect()}
    assert set(got) == set(groups)
    top = max(brute(v)[2] for v in groups.values() if brute(v)[0])
    for name, values in groups.items():
        r, want = got[name], brute(values)
        assert r.n == want[0] and r.n_outliers == want[6]
        for have, expected in zip((r.q1, r.median, r.q3, r.whisker_lo, r.whisker_hi), want[1:6]):
            assert have is None if expected is None else math.isclose(have, expected, rel_tol=1e-12, abs_tol=1e-12)
        assert r.max_median == top


def test_a_group_lies_in_several_partitions(spark):
    """Distinct values of one group are dealt to many partitions and their running counts agree."""
    df = spark.range(4000).select(F.lit("a").alias("g"), (F.col("id") % 1000).cast("double").alias("v"))
    ranked = M.ranked_values(df, "v", ["g"])
    got = ranked.toPandas().sort_values("__v")
    assert (got["__upto"].to_numpy() == 4 * np.arange(1, 1001)).all() and (got["n"] == 4000).all()
    quart = M.percentiles_by_group(ranked, ["g"], {"p10": 0.1, "p99": 0.99}).first()
    want = pd.Series(np.repeat(np.arange(1000.0), 4)).quantile([0.1, 0.99]).tolist()
    assert math.isclose(quart.p10, want[0]) and math.isclose(quart.p99, want[1])


def test_empty_table(spark):
    assert M.box_summary(rows_of(spark, {"x": [1.0]}).limit(0), "r2").count() == 0
