"""Signal and connectivity operators on long tables.

Tables
------
* series / signal: ``(keys..., t, [roi,] value)`` — one row per time point (and
  ROI).  ``t`` is a materialised order key: Spark rows have no order.
* edges: ``(keys..., i, j, [label_i, label_j,] r)`` — one row per ROI pair.

Per-series statistics (trend, mean, sd) are aggregates (partial + final) that
are joined back on the series key; nothing collects a whole series into one
task except the ``lag`` window, whose partition is a single series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import fisher_z, safe_div
from cohortlens.operators.long_series import BLOCK_POINTS, band_pass_long, split_by_length
from cohortlens.operators.pieces import (NEGLIGIBLE, PIECE_POINTS, ROUNDING, by_series, correlation, regress,
                                         shrunk_correlation)
from cohortlens.session import stored

# fixed values: the nine base confound columns of the 36-parameter model
CONFOUNDS_9P = ["csf", "white_matter", "global_signal",
                "trans_x", "trans_y", "trans_z", "rot_x", "rot_y", "rot_z"]

POINTS_HELD = 100_000        # points up to which a sphere join broadcasts them

FWHM_TO_SIGMA = 2.0 * math.sqrt(2.0 * math.log(2.0))  # 2.3548...


# ---------------------------------------------------------------- confounds

def difference(df: DataFrame, cols: Sequence[str], series_keys: Sequence[str],
               order_cols: Sequence[str], suffix: str = "_der") -> DataFrame:
    """WIN1: first difference per series; the first value (and any NULL
    operand) becomes 0."""
    from cohortlens.operators.ranking import lag_within
    lagged = lag_within(df, series_keys, order_cols, cols, suffix="__lag")
    return lagged.select(*df.columns, *[F.coalesce(F.col(c) - F.col(c + "__lag"), F.lit(0.0)).alias(c + suffix)
                                        for c in cols])


def square_terms(df: DataFrame, cols: Sequence[str], suffix: str = "_2") -> DataFrame:
    """PRJ10: c -> c_2 = c²."""
    return df.select("*", *[(F.col(c) * F.col(c)).alias(c + suffix) for c in cols])


def confounds_36p(df: DataFrame, series_keys: Sequence[str], order_cols: Sequence[str],
                  base_cols: Sequence[str] = CONFOUNDS_9P) -> DataFrame:
    """WIN2: base columns + their differences + squares of both (9 -> 36)."""
    base = list(base_cols)
    d = difference(df.select(*series_keys, *order_cols, *base), base, series_keys, order_cols)
    der = [c + "_der" for c in base]
    return square_terms(d, base + der)


# ---------------------------------------------------------------- series cleaning

def with_time_index(df: DataFrame, series_keys: Sequence[str], order_cols: Sequence[str],
                    name: str = "t") -> DataFrame:
    """Materialise a 0-based time index per series from its order columns."""
    from cohortlens.operators.ranking import rank_within
    return (rank_within(df, series_keys, order_cols, "__rn")
            .withColumn(name, (F.col("__rn") - 1).cast("bigint")).drop("__rn"))


def detrend(df: DataFrame, series_keys: Sequence[str], t: str = "t", value: str = "value") -> DataFrame:
    """SIG1: remove the least-squares line a + b·t of each series."""
    fit = df.groupBy(*series_keys).agg(
        F.regr_slope(F.col(value), F.col(t).cast("double")).alias("__b"),
        F.regr_intercept(F.col(value), F.col(t).cast("double")).alias("__a"))
    return (df.join(fit, list(series_keys))
            .withColumn(value, F.col(value) - (F.coalesce("__a", F.lit(0.0))
                                               + F.coalesce("__b", F.lit(0.0)) * F.col(t)))
            .drop("__a", "__b"))


def standardize(df: DataFrame, series_keys: Sequence[str], value: str = "value") -> DataFrame:
    """SIG2: z-score per series (population sd); a constant series becomes 0."""
    st = df.groupBy(*series_keys).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    z = F.when(F.col("__s") > 0, (F.col(value) - F.col("__m")) / F.col("__s")).otherwise(F.lit(0.0))
    return df.join(st, list(series_keys)).withColumn(value, z).drop("__m", "__s")


def detrend_standardize(df: DataFrame, series_keys: Sequence[str], t: str = "t", value: str = "value",
                        negligible: float = ROUNDING) -> DataFrame:
    """SIG1 then SIG2 with one aggregate and one join per series.

    The residual of the least-squares line has mean 0 and population variance
    (Syy − Sxy²/Sxx)/n, so the z-scored residual needs only the built-in
    regression aggregates (``regr_sxx``/``regr_syy``/``regr_sxy``, merged
    stably); a series whose residual is constant (its sum of squares at most
    ``negligible`` of the series') becomes 0."""
    tt = F.col(t).cast("double")
    v = F.col(value)
    fit = df.groupBy(*series_keys).agg(
        F.regr_slope(v, tt).alias("__b"), F.regr_intercept(v, tt).alias("__a"),
        F.regr_syy(v, tt).alias("__syy"), F.regr_sxy(v, tt).alias("__sxy"), F.regr_sxx(v, tt).alias("__sxx"),
        F.regr_count(v, tt).alias("__n"))
    ssr = F.col("__syy") - F.coalesce(safe_div(F.col("__sxy") * F.col("__sxy"), F.col("__sxx")), F.lit(0.0))
    sd = F.sqrt(F.greatest(ssr, F.lit(0.0)) / F.col("__n"))
    res = v - (F.coalesce("__a", F.lit(0.0)) + F.coalesce("__b", F.lit(0.0)) * F.col(t))
    return (df.join(fit, list(series_keys))
            .withColumn(value, F.when(sd > math.sqrt(negligible) * F.sqrt(F.col("__syy") / F.col("__n") + 1e-300), res / sd)
                        .otherwise(F.lit(0.0)))
            .drop("__a", "__b", "__syy", "__sxy", "__sxx", "__n"))


def center(df: DataFrame, series_keys: Sequence[str], value: str = "value") -> DataFrame:
    st = df.groupBy(*series_keys).agg(F.avg(value).alias("__m"))
    return df.join(st, list(series_keys)).withColumn(value, F.col(value) - F.col("__m")).drop("__m")


def min_duration(df: DataFrame, run_keys: Sequence[str], tr: float | str, min_seconds: float = 120.0,
                 t: str = "t") -> DataFrame:
    """PRJ16: per run n_volumes·TR and whether it exceeds ``min_seconds`` (strict).

    ``tr`` is a number or the name of a per-run column."""
    trc = F.first(F.col(tr)) if isinstance(tr, str) else F.lit(float(tr))
    g = df.groupBy(*run_keys).agg(F.countDistinct(t).alias("n_volumes"), trc.alias("tr"))
    return g.select(*run_keys, F.col("n_volumes").cast("bigint"), "tr",
                    (F.col("n_volumes") * F.col("tr")).alias("duration"),
                    (F.col("n_volumes") * F.col("tr") > min_seconds).alias("long_enough"))


def _in_band(x: np.ndarray, tr: float, low: float, high: float) -> np.ndarray:
    """Columns of x (time x series) projected onto the cosines of frequency k/(2·T·TR)
    in [low, high]: the transform of the mirrored series with all other bins cleared."""
    n = len(x)
    spectrum = np.fft.rfft(np.concatenate([x, x[::-1]]), axis=0)
    freq = np.arange(n + 1) / (2.0 * n * tr)
    spectrum[(freq < low) | (freq > high)] = 0.0
    spectrum[[0, n]] = 0.0                              # the mean is never in the band
    return np.fft.irfft(spectrum, 2 * n, axis=0)[:n]


def band_pass(df: DataFrame, series_keys: Sequence[str], tr: float, low: float = 0.01, high: float = 0.1,
              value: str = "value", t: str = "t", whole_points: int = BLOCK_POINTS) -> DataFrame:
    """SIG5: keep only the cosine (DCT) components with frequency in [low, high] Hz.

    Projection form of a band-pass filter: one transform per series, T·log T and
    no basis table.  The time points of a series are taken as
    equally spaced in the order of ``t``; a missing value counts as 0.  A series of
    more than ``whole_points`` is transformed in blocks over several tasks."""
    df, long = split_by_length(df, series_keys, whole_points)
    out = by_series(df, series_keys, t, value,
                    lambda x: _in_band(np.nan_to_num(x)[:, None], tr, low, high)[:, 0])
    return out if long is None else out.unionByName(band_pass_long(long, series_keys, tr, low, high, value, t))


# ---------------------------------------------------------------- correlation

def pair_moments(signal: DataFrame, run_keys: Sequence[str], include_diagonal: bool = False,
                 both_directions: bool = False, t: str = "t", roi: str = "roi",
                 value: str = "value") -> DataFrame:
    """JOIN12: self-join of the long signal on (run keys, t) for ROI pairs."""
    a = signal.select(*run_keys, t, F.col(roi).alias("i"), F.col(value).alias("xi"))
    b = signal.select(*run_keys, t, F.col(roi).alias("j"), F.col(value).alias("xj"))
    if both_directions:
        cond = (F.col("i") != F.col("j")) if not include_diagonal else F.lit(True)
    else:
        cond = (F.col("i") <= F.col("j")) if include_diagonal else (F.col("i") < F.col("j"))
    return a.join(b, list(run_keys) + [t]).filter(cond)


def correlation_edges(signal: DataFrame, run_keys: Sequence[str], both_directions: bool = False,
                      t: str = "t", roi: str = "roi", value: str = "value") -> DataFrame:
    """AGG1: Pearson correlation per run and ROI pair (i < j, or all i != j).

    Built-in covariance / sd aggregates (numerically stable, mergeable) after
    the self-join; a constant ROI gives NULL, never an error.
    """
    pairs = pair_moments(signal, run_keys, both_directions=both_directions, t=t, roi=roi, value=value)
    return pairs.groupBy(*run_keys, "i", "j").agg(
        safe_div(F.covar_pop("xi", "xj"), F.stddev_pop("xi") * F.stddev_pop("xj")).alias("r"))


def shrunk_correlation_edges(signal: DataFrame, run_keys: Sequence[str], t: str = "t", roi: str = "roi",
                             value: str = "value") -> DataFrame:
    """AGG2: Ledoit-Wolf shrunk covariance turned into correlation, per run.

    Aggregate-only form: with X centred per ROI, S = XᵀX/n,
    beta = (Σ_t(Σ_i x²)²/n − ΣS²)/(p·n), delta = (ΣS² − 2·mu·trS + p·mu²)/p,
    s = min(beta, delta)/delta (0 when beta = 0), shrunk = (1−s)·S + s·mu·I.
    Returns edges i < j.
    """
    keys = list(run_keys)
    x = center(signal.select(*keys, t, roi, value), keys + [roi], value)
    pairs = pair_moments(x, keys, include_diagonal=True, t=t, roi=roi, value=value)
    n = x.groupBy(*keys).agg(F.countDistinct(t).alias("n"), F.countDistinct(roi).alias("p"))
    s = pairs.groupBy(*keys, "i", "j").agg(F.sum(F.col("xi") * F.col("xj")).alias("sxx"))
    s = s.join(n, keys).withColumn("S", F.col("sxx") / F.col("n"))
    per_t = x.groupBy(*keys, t).agg(F.sum(F.col(value) * F.col(value)).alias("q"))
    b1 = per_t.groupBy(*keys).agg(F.sum(F.col("q") * F.col("q")).alias("beta_raw"))
    glob = s.groupBy(*keys).agg(
        F.sum(F.when(F.col("i") == F.col("j"), F.col("S") * F.col("S"))
              .otherwise(2.0 * F.col("S") * F.col("S"))).alias("ss"),
        F.sum(F.when(F.col("i") == F.col("j"), F.col("S")).otherwise(0.0)).alias("tr"),
        F.first("n").alias("n"), F.first("p").alias("p"))
    glob = glob.join(b1, keys)
    mu = F.col("tr") / F.col("p")
    beta = (F.col("beta_raw") / F.col("n") - F.col("ss")) / (F.col("p") * F.col("n"))
    delta = (F.col("ss") - 2.0 * mu * F.col("tr") + F.col("p") * mu * mu) / F.col("p")
    glob = glob.select(*keys, mu.alias("mu"), F.least(beta, delta).alias("beta"), delta.alias("delta"))
    glob = glob.select(*keys, "mu", F.when(F.col("beta") == 0, F.lit(0.0))
                       .otherwise(safe_div(F.col("beta"), F.col("delta"))).alias("shrink"))
    sh = s.join(glob, keys).select(
        *keys, "i", "j",
        ((1.0 - F.col("shrink")) * F.col("S")
         + F.when(F.col("i") == F.col("j"), F.col("shrink") * F.col("mu")).otherwise(0.0)).alias("c"))
    diag = sh.filter(F.col("i") == F.col("j")).select(*keys, F.col("i").alias("__k"), F.col("c").alias("__d"))
    off = sh.filter(F.col("i") < F.col("j"))
    off = off.join(diag.withColumnRenamed("__k", "i").withColumnRenamed("__d", "di"), keys + ["i"])
    off = off.join(diag.withColumnRenamed("__k", "j").withColumnRenamed("__d", "dj"), keys + ["j"])
    return off.select(*keys, "i", "j", safe_div(F.col("c"), F.sqrt(F.col("di") * F.col("dj"))).alias("r"))


def to_fisher_z(edges: DataFrame, r: str = "r", out: str = "z") -> DataFrame:
    """PRJ11: z = atanh(r) with the diagonal set to 0 first."""
    rr = F.when(F.col("i") == F.col("j"), F.lit(0.0)).otherwise(F.col(r))
    return edges.withColumn(out, fisher_z(rr))


def mean_over_runs(edges: DataFrame, keys: Sequence[str], value: str = "z") -> DataFrame:
    """AGG3: mean over runs per (keys, i, j); missing in any run -> missing."""
    return edges.groupBy(*keys, "i", "j").agg(
        F.when(F.count(value) == F.count(F.lit(1)), F.avg(value)).alias(value))


def label_edges(edges: DataFrame, labels: DataFrame, roi: str = "roi", label: str = "label") -> DataFrame:
    """WIN7/SRT1: attach ROI labels and sort each pair (label1 <= label2).

    ``labels`` is (roi, label), one row per ROI — bounded by the atlas size,
    so it is broadcast."""
    lab = F.broadcast(labels.select(F.col(roi).alias("__r"), F.col(label).alias("__l")))
    e = edges.join(lab.withColumnRenamed("__r", "i").withColumnRenamed("__l", "li"), "i")
    e = e.join(lab.withColumnRenamed("__r", "j").withColumnRenamed("__l", "lj"), "j")
    return e.withColumn("roi1", F.least("li", "lj")).withColumn("roi2", F.greatest("li", "lj")).drop("li", "lj")


def upper_triangle(edges: DataFrame) -> DataFrame:
    """WIN7: strict upper triangle (i < j), NULL edges kept."""
    return edges.filter(F.col("i") < F.col("j"))


def network_means(edges: DataFrame, keys: Sequence[str], value: str = "z") -> DataFrame:
    """AGG4: mean per sorted label pair, NULL skipped; name 'roi1_roi2'."""
    return edges.groupBy(*keys, "roi1", "roi2").agg(F.avg(value).alias(value)).withColumn(
        "name", F.concat_ws("_", "roi1", "roi2"))


def exclude_rois(edges: DataFrame, excluded: DataFrame, keys: Sequence[str] = (), value: str = "r") -> DataFrame:
    """RSH7: set the whole row and column of excluded ROIs to NULL."""
    ex = excluded.select(*keys, F.col("roi").alias("__x")).withColumn("__hit", F.lit(True))
    e = edges.join(ex.withColumnRenamed("__x", "i").withColumnRenamed("__hit", "__hi"),
                   list(keys) + ["i"], "left")
    e = e.join(ex.withColumnRenamed("__x", "j").withColumnRenamed("__hit", "__hj"),
               list(keys) + ["j"], "left")
    return e.withColumn(value, F.when(F.col("__hi").isNull() & F.col("__hj").isNull(), F.col(value))).drop(
        "__hi", "__hj")


def symmetry_violations(edges: DataFrame, keys: Sequence[str], value: str = "r",
                        rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """JOIN14: cells where m[i,j] and m[j,i] differ (NULL treated as 0)."""
    a = edges.select(*keys, "i", "j", F.coalesce(F.col(value), F.lit(0.0)).alias("a"))
    b = edges.select(*keys, F.col("j").alias("i"), F.col("i").alias("j"),
                     F.coalesce(F.col(value), F.lit(0.0)).alias("b"))
    j = a.join(b, list(keys) + ["i", "j"], "full")
    av, bv = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return j.filter(F.abs(av - bv) > atol + rtol * F.abs(bv)).select(*keys, "i", "j", av.alias("a"), bv.alias("b"))


# ---------------------------------------------------------------- spheres (geometry)

def sphere_members(roi: DataFrame, points: DataFrame, radius: float, coords: Sequence[str] = ("x", "y", "z"),
                   how: str = "inner") -> DataFrame:
    """JOIN10: (roi, point) pairs with squared distance <= radius²; with ``how`` 'left_semi' the regions
    with a point (possibly repeated).

    Grid-cell equi-join instead of a nested loop: points are bucketed into
    cubes of side ``radius``; each ROI centre looks at its 27 neighbouring cubes.
    Every candidate pair is checked exactly, so the result equals the range join.
    The planner's estimate leaves out the 27 copies of a centre, so the join is fixed here: the points are
    broadcast if they are few, else both sides are shuffled; the centres are never broadcast.
    """
    points = stored(points)             # counted, then joined
    cell = [F.floor(F.col(c) / radius).cast("bigint") for c in coords]
    pts = points.select("*", *[c.alias(f"__c{k}") for k, c in enumerate(cell)])
    few = points.limit(POINTS_HELD + 1).count() <= POINTS_HELD
    pts = F.broadcast(pts) if few else pts.hint("merge")
    offs = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    r = roi.select(F.col("roi"), *[F.col(c).alias(f"__r{c}") for c in coords],
                   *[c.alias(f"__rc{k}") for k, c in enumerate(cell)])
    if few:                             # a small file of centres is one task, its pairs are not small
        r = r.repartition(max(int(roi.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1))
    r = (r.withColumn("__d0", F.explode(offs)).withColumn("__d1", F.explode(offs))
         .withColumn("__d2", F.explode(offs)))
    r = r.select("roi", *[f"__r{c}" for c in coords],
                 *[(F.col(f"__rc{k}") + F.col(f"__d{k}")).alias(f"__n{k}") for k in range(3)])
    d2 = sum(((F.col(c) - F.col(f"__r{c}")) * (F.col(c) - F.col(f"__r{c}")) for c in coords), F.lit(0.0))
    near = d2 <= radius * radius
    for k in range(3):
        near = near & (F.col(f"__n{k}") == F.col(f"__c{k}"))
    return r.join(pts, near, how).select("roi", *(points.columns if how == "inner" else []))


def roi_means(roi: DataFrame, voxels: DataFrame, radius: float, value: str = "value",
              keys: Sequence[str] = (), coords: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """AGG17: mean value over the voxels inside each ROI sphere (per keys).

    Voxels are first reduced to one row per (keys, coordinate) with sum and
    count, so the sphere join touches distinct coordinates only; without keys
    these rows are the points of the join.
    """
    pre = voxels.groupBy(*keys, *coords).agg(F.sum(value).alias("__s"), F.count(value).alias("__n"))
    if keys:
        pre = stored(pre)
        mem = sphere_members(roi, pre.select(*coords).distinct(), radius, coords)
        j = pre.join(mem, list(coords))
    else:
        j = sphere_members(roi, pre, radius, coords)
    return j.groupBy(*keys, "roi").agg(F.sum("__n").cast("bigint").alias("n_voxels"),
                                      safe_div(F.sum("__s"), F.sum("__n").cast("double")).alias(value))


def empty_rois(roi: DataFrame, voxels: DataFrame, radius: float,
               coords: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """SIG6: ROIs whose sphere holds no voxel (left anti join with JOIN10)."""
    geo = voxels.select(*coords).distinct()
    mem = sphere_members(roi, geo, radius, coords, "left_semi").distinct()
    return roi.join(mem, "roi", "left_anti")


def check_empty_rois(empty: DataFrame, max_empty: int = 10) -> int:
    """SIG6: at most ``max_empty`` empty ROIs are tolerated; more raise."""
    n = empty.count()
    if n > max_empty:
        raise RuntimeError(f"{n} regions hold no voxel; at most {max_empty} are allowed")
    return n


def smoothing_kernel(fwhm: float, voxel_size: float = 1.0, truncate: float = 4.0) -> list[tuple[int, float]]:
    """(offset, weight) of the normalised Gaussian along one axis, cut at ``truncate`` sigma."""
    sigma = fwhm / FWHM_TO_SIGMA / voxel_size
    rad = int(truncate * sigma + 0.5)
    ks = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-rad, rad + 1)]
    return [(d, k / sum(ks)) for d, k in zip(range(-rad, rad + 1), ks)]


def smoothing_weights(members: DataFrame, fwhm: float, voxel_size: float = 1.0,
                      coords: Sequence[str] = ("x", "y", "z"), truncate: float = 4.0,
                      box: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """SIG4 folded into AGG17: weight of each source voxel u for ROI r,
    W(r,u) = mean over sphere voxels v of G(v−u), G the separable normalised
    Gaussian (sigma = fwhm/2.3548, truncated at ``truncate`` sigma).

    Linear operators compose, so smoothing-then-sphere-mean equals one weighted
    sum with W; no smoothed volume is materialised.  Applied axis by axis
    (three small steps with a 1-D kernel) instead of a 3-D kernel.  With ``box``
    = (first, last) per axis the image is mirrored at its border (the border
    voxel repeated), without it everything outside counts as 0.
    """
    kern = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(k).alias("k"))
                     for d, k in smoothing_kernel(fwhm, voxel_size, truncate)])
    n = members.groupBy("roi").agg(F.count(F.lit(1)).alias("__n"))
    w = members.join(n, "roi").select("roi", *coords, (F.lit(1.0) / F.col("__n")).alias("w"))
    for axis, c in enumerate(coords):
        at = F.col(c) + F.col("__g.d")
        if box is not None:
            first, size = box[axis][0], box[axis][1] - box[axis][0] + 1
            at = F.pmod(at - first, F.lit(2 * size))
            at = F.when(at < size, at).otherwise(2 * size - 1 - at) + first
        w = (w.withColumn("__g", F.explode(kern))
             .withColumn(c, at.cast("int"))
             .groupBy("roi", *coords).agg(F.sum(F.col("w") * F.col("__g.k")).alias("w")))
    return w


def weighted_roi_signal(weights: DataFrame, voxels: DataFrame, keys: Sequence[str] = (),
                        coords: Sequence[str] = ("x", "y", "z"), value: str = "value") -> DataFrame:
    """AGG17 with smoothing: Σ_u W(r,u)·img(u) per (keys, roi); outside the image counts as 0."""
    j = voxels.join(weights, list(coords))
    return j.groupBy(*keys, "roi").agg(F.sum(F.col("w") * F.col(value)).alias(value))


def region_series(roi: DataFrame, voxels: DataFrame, radius: float, fwhm: float, keys: Sequence[str],
                  box: Sequence[tuple[int, int]], mask: DataFrame | None = None, t: str = "t",
                  coords: Sequence[str] = ("x", "y", "z"), value: str = "value", voxel_size: float = 1.0,
                  max_empty: int = 10) -> DataFrame:
    """SIG4 + AGG17 + SIG6: series (keys, t, roi, value) of the smoothed volumes, and
    whether the region is empty.

    ``voxels`` is (keys, t, coords, value), one row per voxel of a volume; an absent
    one counts as 0.  A region is the mean over the voxels of ``mask`` (default: all
    coordinates that occur) in its sphere.  Smoothing and mean are one table of
    weights (region, voxel), which depends on the atlas and grid alone; each volume
    meets it once, by coordinates, and sums are combined before the exchange.
    ``voxels`` is read for the volumes, their time points and the default mask.

    A region without a voxel has the value 0 at every time point; more than
    ``max_empty`` of them stop the job with an error, in the plan itself."""
    inside = F.lit(True)
    for c, (first, last) in zip(coords, box):
        inside = inside & F.col(c).between(first, last)
    geo = (voxels if mask is None else mask).where(inside).select(*coords).distinct()
    members = stored(sphere_members(roi.select("roi", *coords), geo, radius, coords))
    weights = smoothing_weights(members, fwhm, voxel_size, coords, box=box).select(
        "roi", *coords, "w", F.lit(None).cast("boolean").alias("empty"))
    # one more voxel per volume, outside the box and of value 0, which every region has with weight 0: so each
    # region, also an empty one, has a value at each time point; the list of regions has the atlas' size
    here = members.select("roi").distinct().withColumn("__full", F.lit(True))
    marks = F.collect_list(F.struct("roi", F.col("__full").isNull().alias("empty")))
    listed = roi.select("roi").distinct().join(here, "roi", "left").agg(marks.alias("__all"))
    n_empty = F.size(F.filter("__all", lambda m: m["empty"]))
    allowed = F.when(n_empty > max_empty, F.raise_error(F.concat(
        n_empty.cast("string"), F.lit(f" regions hold no voxel; at most {max_empty} are allowed"))).cast(
            listed.schema["__all"].dataType)).otherwise(F.col("__all"))
    kinds = dict(voxels.dtypes)
    marker = [F.lit(first - 1).cast(kinds[c]).alias(c) for c, (first, _) in zip(coords, box)]
    weights = weights.unionByName(listed.select(F.explode(allowed).alias("__m")).select(
        F.col("__m.roi").alias("roi"), *marker, F.lit(0.0).alias("w"), F.col("__m.empty").alias("empty")))
    rows = voxels.where(inside).select(*keys, t, *coords, F.col(value).cast("double").alias(value))
    rows = rows.unionByName(voxels.select(*keys, t).distinct().select(*keys, t, *marker, F.lit(0.0).alias(value)))
    return rows.join(weights, list(coords)).groupBy(*keys, t, "roi").agg(
        F.coalesce(F.sum(F.col("w") * F.col(value)), F.lit(0.0)).alias(value), F.max("empty").alias("empty"))


# ---------------------------------------------------------------- confound regression (SIG3)

def regress_confounds(signal: DataFrame, confounds: DataFrame, run_keys: Sequence[str],
                      confound_cols: Sequence[str], t: str = "t", roi: str = "roi",
                      value: str = "value", band: tuple[float, float, float] | None = None,
                      piece_points: int = PIECE_POINTS) -> DataFrame:
    """SIG3: residual of every ROI series after least squares on the run's
    confounds (with intercept), all runs in one job, a run in pieces of time.

    Confounds are detrended and standardised per run first and, with ``band``
    = (tr, low, high), limited to the band their signal was limited to.  A
    confound that adds nothing but rounding to those before it is left out.  A
    time point without confounds and a gap in either table are errors."""
    if band is not None:
        confounds = _band_limited(signal, confounds, run_keys, confound_cols, t, band)
    return regress(signal, confounds, run_keys, confound_cols, t, roi, value, band is None, piece_points)


def _band_limited(signal: DataFrame, confounds: DataFrame, run_keys: Sequence[str], cols: Sequence[str], t: str,
                  band: tuple[float, float, float]) -> DataFrame:
    """The confounds at the signal's time points, detrended, standardised and limited to the band."""
    keys = list(run_keys)
    times = signal.select(*keys, t).distinct()
    pairs = F.array(*[F.struct(F.lit(n).alias("c"), F.col(c).cast("double").alias("value")) for n, c in enumerate(cols)])
    long = (confounds.join(times, [*keys, t], "left_semi").select(*keys, t, F.explode(pairs).alias("__p"))
            .select(*keys, t, "__p.c", "__p.value"))
    limited = band_pass(detrend_standardize(long, [*keys, "c"], t, negligible=NEGLIGIBLE), [*keys, "c"], *band, t=t)
    return limited.groupBy(*keys, t).agg(*[F.max(F.when(F.col("c") == n, F.col("value"))).alias(c)
                                           for n, c in enumerate(cols)])


# ---------------------------------------------------------------- Gram path (AGG1, AGG2)

def correlation_edges_gram(signal: DataFrame, run_keys: Sequence[str], t: str = "t", roi: str = "roi",
                           value: str = "value", piece_points: int = PIECE_POINTS) -> DataFrame:
    """AGG1 from moments of pieces of a run: T·R values per run are read once instead
    of T·R²/2 joined pairs.  Gaps are left out pair by pair.  Edges i < j;
    constant ROI -> NULL."""
    return correlation(signal, run_keys, t, roi, value, piece_points)


def shrunk_correlation_edges_gram(signal: DataFrame, run_keys: Sequence[str], t: str = "t", roi: str = "roi",
                                  value: str = "value", piece_points: int = PIECE_POINTS) -> DataFrame:
    """AGG2 (Ledoit–Wolf) from moments of pieces of a run: the same three aggregates as
    ``shrunk_correlation_edges`` (S, Σ_t(Σ_i x²)², trace); gaps are an error."""
    return shrunk_correlation(signal, run_keys, t, roi, value, piece_points)
