"""Queries: confounds, series cleaning, connectivity and sphere geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import long_series as LS
from cohortlens.operators import signal as S
from cohortlens.plans import connectome as CN
from cohortlens.plans.registry import register, rounded
from cohortlens.session import stored
from cohortlens.sources import tables as V
from cohortlens.sources.tables import with_views

TR = 2.0

# ---------------------------------------------------------------- series view

_SERIES_T = """series_t AS (
  SELECT subject, event_id, ts, value,
         CAST(row_number() OVER (PARTITION BY subject ORDER BY ts, event_id) - 1 AS BIGINT) AS t
  FROM series)"""


def _series_t(spark, sf):
    return S.with_time_index(V.series(spark, sf), ["subject"], ["ts", "event_id"])


def _with_series_t(sql: str) -> str:
    return f"WITH series AS ({V.SERIES_SQL}), {_SERIES_T}\n{sql}"


@register("win_confounds_36p", rounded(with_views("""
SELECT subject, event_id, value, value_der, value * value AS value_2, value_der * value_der AS value_der_2 FROM (
  SELECT subject, event_id, value,
         coalesce(value - lag(value) OVER (PARTITION BY subject ORDER BY ts, event_id), 0.0) AS value_der
  FROM series)""", "series"), ["value", "value_der", "value_2", "value_der_2"]))
def q_confounds(spark, sf):
    """WIN1+WIN2+PRJ10: differences (first = 0) and squares per series."""
    c = S.confounds_36p(V.series(spark, sf), ["subject"], ["ts", "event_id"], base_cols=["value"])
    return c.drop("ts")


@register("sig_detrend", rounded(_with_series_t("""
SELECT s.subject, s.event_id, s.t, s.value - (coalesce(f.a, 0.0) + coalesce(f.b, 0.0) * s.t) AS value
FROM series_t s JOIN (SELECT subject, regr_slope(value, CAST(t AS DOUBLE)) AS b,
                             regr_intercept(value, CAST(t AS DOUBLE)) AS a FROM series_t GROUP BY subject) f
  ON s.subject = f.subject"""), ["value"]))
def q_detrend(spark, sf):
    """SIG1: remove each series' least-squares line."""
    return S.detrend(_series_t(spark, sf), ["subject"]).select("subject", "event_id", "t", "value")


@register("sig_standardize", rounded(_with_series_t("""
SELECT s.subject, s.event_id, s.t,
       CASE WHEN f.sd > 0 THEN (s.value - f.m) / f.sd ELSE 0.0 END AS value
FROM series_t s JOIN (SELECT subject, avg(value) AS m, stddev_pop(value) AS sd FROM series_t GROUP BY subject) f
  ON s.subject = f.subject"""), ["value"]))
def q_standardize(spark, sf):
    """SIG2: z-score each series (population sd)."""
    return S.standardize(_series_t(spark, sf), ["subject"]).select("subject", "event_id", "t", "value")


@register("prj_min_duration", rounded(_with_series_t(f"""
SELECT subject, CAST(count(DISTINCT t) AS BIGINT) AS n_volumes, {TR} AS tr, count(DISTINCT t) * {TR} AS duration,
       count(DISTINCT t) * {TR} > 120.0 AS long_enough
FROM series_t GROUP BY subject"""), ["tr", "duration"]))
def q_min_duration(spark, sf):
    """PRJ16: runs longer than 120 s (n_volumes x TR, strict)."""
    return S.min_duration(_series_t(spark, sf), ["subject"], TR)


_BP_SQL = rounded(f"""WITH series AS ({V.SERIES_SQL}), {_SERIES_T},
__n AS (SELECT subject, count(*) AS n FROM series_t GROUP BY subject),
__basis AS (
  SELECT n, t, k, sqrt(2.0 / n) * cos(pi() * k * (t + 0.5) / n) AS phi FROM (
    SELECT n, t, unnest(generate_series(1, n - 1)) AS k FROM (
      SELECT n, unnest(generate_series(0, n - 1)) AS t FROM (SELECT DISTINCT n FROM __n) d) dt) dtk
  WHERE k / (2.0 * n * {TR}) >= 0.01 AND k / (2.0 * n * {TR}) <= 0.1),
__c AS (SELECT s.subject, b.n, b.k, sum(s.value * b.phi) AS c
        FROM series_t s JOIN __n ON s.subject = __n.subject JOIN __basis b ON b.n = __n.n AND b.t = s.t
        GROUP BY s.subject, b.n, b.k),
__f AS (SELECT c.subject, b.t, sum(c.c * b.phi) AS f FROM __c c JOIN __basis b ON b.n = c.n AND b.k = c.k
        GROUP BY c.subject, b.t)
SELECT s.subject, s.event_id, s.t, coalesce(f.f, 0.0) AS value
FROM series_t s LEFT JOIN __f f ON s.subject = f.subject AND s.t = f.t""", ["value"])


@register("sig_band_pass", _BP_SQL)
def q_band_pass(spark, sf):
    """SIG5: band-pass 0.01-0.1 Hz (TR 2 s) as a DCT-domain projection."""
    return S.band_pass(_series_t(spark, sf), ["subject"], TR).select("subject", "event_id", "t", "value")


@register("sig_band_pass_blocks", _BP_SQL)
def q_band_pass_blocks(spark, sf):
    """SIG5 by the transform of long series: every series in blocks of at most 256 numbers."""
    return LS.band_pass_long(_series_t(spark, sf), ["subject"], TR, block_points=256).select("subject", "event_id", "t", "value")


# ---------------------------------------------------------------- connectivity

@register("agg_correlation", rounded(with_views(CN.corr_sql("signal"), "signal"), ["r"]))
def q_correlation(spark, sf):
    """JOIN12+AGG1: Pearson r per (subject, run) and ROI pair i < j."""
    return S.correlation_edges_gram(V.signal(spark, sf), ["subject", "run"])


@register("agg_shrunk_correlation", rounded(with_views(CN.shrunk_sql("signal"), "signal"), ["r"]))
def q_shrunk(spark, sf):
    """AGG2: Ledoit-Wolf shrunk correlation per (subject, run), i < j."""
    return S.shrunk_correlation_edges_gram(V.signal(spark, sf), ["subject", "run"])


@register("agg_network_means", rounded(with_views(CN.network_means_sql("signal", clean=False), "signal"), ["z"]))
def q_network_means(spark, sf):
    """PRJ11+AGG3+WIN7+AGG4: Fisher z, mean over runs, network-pair means."""
    return CN.network_means(V.signal(spark, sf), clean=False)


@register("sig_connectivity_features", rounded(with_views(CN.network_means_sql("signal", clean=True), "signal"),
                                               ["z"]))
def q_connectivity_features(spark, sf):
    """SIG7: SIG1 -> SIG2 -> SIG5 -> SIG3 -> AGG2 -> RSH7 -> PRJ11 -> AGG3 -> WIN7 -> AGG4."""
    return CN.network_means(V.signal(spark, sf), clean=True)


@register("rsh_pivot_networks", rounded(with_views(CN.pivot_sql("signal"), "signal"),
                                        [f"fmri__{n}" for n in CN.network_pair_names()]))
def q_pivot_networks(spark, sf):
    """RSH1+PRJ6: one row per subject, one column per network pair."""
    return CN.network_features_wide(V.signal(spark, sf))


@register("rsh_full_edges", rounded(with_views(CN.full_edges_sql("signal"), "signal"), ["value"]))
def q_full_edges(spark, sf):
    """RSH2+PRJ12: all ROI-pair features in long form, names fmri__{a}__{b}, gaps -> 0."""
    return CN.full_edge_features(V.signal(spark, sf))


@register("rsh_exclude_rois", rounded(with_views(CN.exclude_sql("signal"), "signal"), ["r"]))
def q_exclude_rois(spark, sf):
    """RSH7: whole rows/columns of excluded ROIs set to NULL."""
    return CN.excluded_edges(V.signal(spark, sf))


@register("chk_symmetry", rounded(with_views(CN.symmetry_sql("signal"), "signal"), ["a", "b"]))
def q_symmetry(spark, sf):
    """JOIN14: symmetry check of the full matrix with one planted asymmetric cell per run."""
    return CN.symmetry_check(V.signal(spark, sf))


# ---------------------------------------------------------------- spheres

R = 5.0

_MEMBERS_SQL = f"""
SELECT r.roi, g.x, g.y, g.z FROM roi r JOIN (SELECT DISTINCT x, y, z FROM voxel) g
  ON (g.x - r.x) * (g.x - r.x) + (g.y - r.y) * (g.y - r.y) + (g.z - r.z) * (g.z - r.z) <= {R * R}"""


@register("join_sphere_members", with_views(_MEMBERS_SQL, "voxel", "roi"))
def q_sphere_members(spark, sf):
    """JOIN10: (roi, voxel coordinate) within a 5-unit sphere, via grid-cell equi-join."""
    geo = V.voxel(spark, sf).select("x", "y", "z").distinct()
    return S.sphere_members(V.roi(spark, sf), geo, R).select("roi", "x", "y", "z")


@register("agg_roi_means", rounded(with_views(f"""
SELECT m.roi, CAST(sum(p.n) AS BIGINT) AS n_voxels, sum(p.s) / CAST(sum(p.n) AS DOUBLE) AS value
FROM ({_MEMBERS_SQL}) m JOIN (SELECT x, y, z, sum(value) AS s, count(value) AS n FROM voxel GROUP BY x, y, z) p
  ON m.x = p.x AND m.y = p.y AND m.z = p.z
GROUP BY m.roi""", "voxel", "roi"), ["value"]))
def q_roi_means(spark, sf):
    """AGG17: mean voxel value inside each ROI sphere."""
    return S.roi_means(V.roi(spark, sf), V.voxel(spark, sf), R)


@register("sig_empty_rois", with_views(f"""
SELECT roi, x, y, z FROM roi WHERE roi NOT IN (SELECT roi FROM ({_MEMBERS_SQL}))""", "voxel", "roi"))
def q_empty_rois(spark, sf):
    """SIG6: ROIs whose sphere contains no voxel."""
    return S.empty_rois(V.roi(spark, sf), V.voxel(spark, sf), R)


# ---------------------------------------------------------------- volumes to region series and connectivity

BOX = ((1, 7), (1, 50), (0, 10))      # the grid of the view ``voxel``
FWHM = 2.0


def _volumes(spark, sf):
    """Volumes per return flag and month: mean price (thousands) per coordinate."""
    li = V.table(spark, sf, "lineitem")
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("long")
    return li.groupBy(
        F.col("l_returnflag").alias("subject"), month.alias("t"), F.col("l_linenumber").cast("int").alias("x"),
        F.col("l_quantity").cast("int").alias("y"), F.round(F.col("l_discount") * 100).cast("int").alias("z")).agg(
        (F.avg(F.col("l_extendedprice").cast("double")) / 1000.0).alias("value"))


def _atlas(spark, sf):
    """One region per part size; the last ones lie outside the grid and are empty."""
    size = F.col("p_size").cast("int")
    return V.table(spark, sf, "part").select(size.cast("long").alias("roi"), (size % 7 + 1).alias("x"), (size + 8).alias("y"),
                                             (size % 11).alias("z")).distinct()


def _series_sql() -> str:
    """The plain way: every volume smoothed axis by axis on the whole grid, then the mean in each sphere."""
    kernel = "(VALUES " + ", ".join(f"({d}, CAST({k!r} AS DOUBLE))" for d, k in S.smoothing_kernel(FWHM)) + ") kern(d, k)"
    grid = " CROSS JOIN ".join(f"(SELECT unnest(generate_series({a}, {b})) AS {c}) g{c}" for (a, b), c in zip(BOX, "xyz"))
    ctes = [f"""__vol AS (SELECT l_returnflag AS subject, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS t,
  CAST(l_linenumber AS INTEGER) AS x, CAST(l_quantity AS INTEGER) AS y, CAST(round(l_discount * 100) AS INTEGER) AS z,
  avg(CAST(l_extendedprice AS DOUBLE)) / 1000.0 AS value FROM lineitem GROUP BY ALL)""",
            "__atlas AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS roi, p_size % 7 + 1 AS x, p_size + 8 AS y, p_size % 11 AS z FROM part)",
            "__times AS (SELECT DISTINCT subject, t FROM __vol)",
            f"""__s0 AS MATERIALIZED (SELECT q.subject, q.t, q.x, q.y, q.z, coalesce(v.value, 0.0) AS value
  FROM (SELECT subject, t, x, y, z FROM __times CROSS JOIN (SELECT * FROM {grid}) gg) q
  LEFT JOIN __vol v ON q.subject = v.subject AND q.t = v.t AND q.x = v.x AND q.y = v.y AND q.z = v.z)"""]
    for n, ((a, b), c) in enumerate(zip(BOX, "xyz")):
        m, size = f"(((g.{c} + kern.d - {a}) % {2 * (b - a + 1)} + {2 * (b - a + 1)}) % {2 * (b - a + 1)})", b - a + 1
        at = f"CASE WHEN {m} < {size} THEN {m} ELSE {2 * size - 1} - {m} END + {a}"
        rest = [o for o in "xyz" if o != c]
        ctes.append(f"""__s{n + 1} AS MATERIALIZED (SELECT s.subject, s.t, {', '.join(f's.{o}' for o in rest)}, w.{c}, sum(w.k * s.value) AS value
  FROM __s{n} s JOIN (SELECT g.{c}, {at} AS src, kern.k FROM (SELECT unnest(generate_series({a}, {b})) AS {c}) g, {kernel}) w
    ON s.{c} = w.src GROUP BY s.subject, s.t, {', '.join(f's.{o}' for o in rest)}, w.{c})""")
    ctes += ["""__mem AS (SELECT r.roi, g.x, g.y, g.z FROM __atlas r JOIN (SELECT DISTINCT x, y, z FROM __vol) g
  ON (g.x - r.x) * (g.x - r.x) + (g.y - r.y) * (g.y - r.y) + (g.z - r.z) * (g.z - r.z) <= """ + f"{R * R})",
             """series3 AS MATERIALIZED (SELECT s.subject, s.t, m.roi, avg(s.value) AS value, false AS empty
  FROM __s3 s JOIN __mem m ON s.x = m.x AND s.y = m.y AND s.z = m.z GROUP BY s.subject, s.t, m.roi
  UNION ALL SELECT subject, t, roi, 0.0, true FROM __times CROSS JOIN
    (SELECT roi FROM __atlas WHERE roi NOT IN (SELECT roi FROM __mem)) e)"""]
    return "WITH " + ",\n".join(ctes)


def _region_series(spark, sf):
    return S.region_series(_atlas(spark, sf), stored(_volumes(spark, sf)), R, FWHM, ["subject"], BOX)


@register("sig_region_series", rounded(_series_sql() + "\nSELECT * FROM series3", ["value"]))
def q_region_series(spark, sf):
    """SIG4+AGG17+SIG6: smoothed volumes to region series, empty regions as 0."""
    return _region_series(spark, sf)


@register("sig_volume_connectivity", rounded(_series_sql() + f""",
__in AS (SELECT subject, 0 AS run, t, roi, value FROM series3),
__e AS ({CN.shrunk_sql('__in')})
SELECT subject, i, j, CASE WHEN i IN (SELECT roi FROM series3 WHERE empty) OR j IN (SELECT roi FROM series3 WHERE empty)
                           THEN NULL ELSE r END AS r FROM __e""", ["r"]))
def q_volume_connectivity(spark, sf):
    """SIG7 from the volumes: SIG4 -> SIG6 -> AGG2 -> RSH7 (rows and columns of empty regions NULL)."""
    series = stored(_region_series(spark, sf))
    edges = S.shrunk_correlation_edges_gram(series, ["subject"])
    return S.exclude_rois(edges, series.filter("empty").select("roi").distinct())


# ---------------------------------------------------------------- SIG3

@register("sig_regress_confounds", rounded(with_views(CN.regress_sql("signal"), "signal"), ["value"]))
def q_regress_confounds(spark, sf):
    """SIG3: ROI series residualised on global-signal confounds (gs, derivative, squares) per run."""
    sig = V.signal(spark, sf)
    return S.regress_confounds(sig, CN.global_signal_confounds(sig), ["subject", "run"], CN.CONFOUNDS)


@register("sig_regress_36_confounds", rounded(with_views(CN.regress_blocks_sql(), "signal"), ["value"]))
def q_regress_36(spark, sf):
    """WIN2 -> SIG3: two long runs (run = vec_id mod 2) residualised on 36 confounds of their own."""
    sig = V.signal(spark, sf)
    conf = CN.block_confounds(sig)
    cols = [c for c in conf.columns if c not in ("run", "t")]
    return S.regress_confounds(sig.select("run", "t", "roi", "value"), conf, ["run"], cols)


_SIG3_ONE_SQL = rounded(with_views("""
WITH __gs AS (SELECT subject, run, t, avg(value) AS gs FROM signal GROUP BY subject, run, t),
__fit AS (SELECT subject, run, regr_slope(gs, CAST(t AS DOUBLE)) AS b, regr_intercept(gs, CAST(t AS DOUBLE)) AS a
          FROM __gs GROUP BY subject, run),
__det AS (SELECT g.subject, g.run, g.t, g.gs - (coalesce(f.a, 0.0) + coalesce(f.b, 0.0) * g.t) AS d
          FROM __gs g JOIN __fit f ON g.subject = f.subject AND g.run = f.run),
__st AS (SELECT subject, run, avg(d) AS m, stddev_pop(d) AS s FROM __det GROUP BY subject, run),
__z AS (SELECT d.subject, d.run, d.t, CASE WHEN s.s > 0 THEN (d.d - s.m) / s.s ELSE 0.0 END AS z
        FROM __det d JOIN __st s ON d.subject = s.subject AND d.run = s.run),
__j AS (SELECT s.subject, s.run, s.t, s.roi, s.value AS y, z.z FROM signal s
        JOIN __z z ON s.subject = z.subject AND s.run = z.run AND s.t = z.t),
__mm AS (SELECT subject, run, roi, avg(y) AS my, avg(z) AS mz FROM __j GROUP BY subject, run, roi),
__bb AS (SELECT j.subject, j.run, j.roi,
                sum((j.z - m.mz) * (j.y - m.my)) / nullif(sum((j.z - m.mz) * (j.z - m.mz)), 0) AS b
         FROM __j j JOIN __mm m ON j.subject = m.subject AND j.run = m.run AND j.roi = m.roi
         GROUP BY j.subject, j.run, j.roi)
SELECT j.subject, j.run, j.t, j.roi, (j.y - m.my) - (j.z - m.mz) * b.b AS value
FROM __j j JOIN __mm m ON j.subject = m.subject AND j.run = m.run AND j.roi = m.roi
JOIN __bb b ON j.subject = b.subject AND j.run = b.run AND j.roi = b.roi""", "signal"), ["value"])


@register("sig_regress_one_confound", _SIG3_ONE_SQL)
def q_regress_one(spark, sf):
    """SIG3 with one confound (the detrended, standardised global signal): residuals per ROI series."""
    sig = V.signal(spark, sf)
    gs = sig.groupBy("subject", "run", "t").agg(F.avg("value").alias("gs"))
    return S.regress_confounds(sig, gs, ["subject", "run"], ["gs"])
