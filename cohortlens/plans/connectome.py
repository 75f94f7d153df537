"""Connectivity features for all subjects in one plan (SIG7), plus the SQL text
of the same steps used as the DuckDB oracle.

Input is a long signal ``(subject, run, t, roi, network, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import signal as S

RUN = ["subject", "run"]
NETWORKS = [f"n{k}" for k in range(7)]  # labels of the recast signal view (roi % 7)


def network_pair_names(labels=NETWORKS) -> list[str]:
    """Sorted label pairs a <= b named 'a_b' (string order, as used by RSH1)."""
    ls = sorted(labels)
    return [f"{a}_{b}" for k, a in enumerate(ls) for b in ls[k:]]


# ---------------------------------------------------------------- Spark side

TR, LOW, HIGH = 2.0, 0.01, 0.1    # seconds per volume, pass band in Hz
CONFOUNDS = ["gs", "gs_der", "gs_2", "gs_der_2"]


def global_signal_confounds(signal: DataFrame) -> DataFrame:
    """Global signal per time point with its difference and the squares of both."""
    gs = signal.groupBy(*RUN, "t").agg(F.avg("value").alias("gs"))
    return S.confounds_36p(gs, RUN, ["t"], base_cols=["gs"])


def clean_signal(signal: DataFrame) -> DataFrame:
    """SIG1 and SIG2 (fused) per ROI series, SIG5, then SIG3 on the global-signal
    confounds limited to the same band."""
    sig = S.band_pass(S.detrend_standardize(signal, RUN + ["roi"]), RUN + ["roi"], TR, LOW, HIGH)
    return S.regress_confounds(sig, global_signal_confounds(signal), RUN, CONFOUNDS, band=(TR, LOW, HIGH))


def run_mean_z(signal: DataFrame, clean: bool) -> DataFrame:
    """AGG2 per run (cleaned: also RSH7), PRJ11, AGG3."""
    e = S.shrunk_correlation_edges_gram(clean_signal(signal) if clean else signal, RUN)
    if clean:
        e = S.exclude_rois(e, excluded_rois(signal)).select(*RUN, "i", "j", "r")
    return S.mean_over_runs(S.to_fisher_z(e), ["subject"])


def roi_labels(signal: DataFrame) -> DataFrame:
    """(roi, label) — one row per ROI of the atlas (bounded by the atlas size)."""
    return signal.select("roi", F.col("network").alias("label")).distinct()


def network_means(signal: DataFrame, clean: bool = False) -> DataFrame:
    m = run_mean_z(signal, clean)
    lab = S.label_edges(m, roi_labels(signal))
    return S.network_means(lab, ["subject"]).select("subject", "roi1", "roi2", "name", "z")


def network_features_wide(signal: DataFrame) -> DataFrame:
    nm = network_means(signal)
    names = network_pair_names()
    wide = nm.groupBy("subject").pivot("name", names).agg(F.first("z"))
    return wide.select("subject", *[F.col(n).alias(f"fmri__{n}") for n in names])


def full_edge_features(signal: DataFrame) -> DataFrame:
    m = run_mean_z(signal, clean=False)
    lab = signal.select("roi", F.concat_ws("_", "network", F.col("roi").cast("string")).alias("label")).distinct()
    e = S.label_edges(m, lab)
    return e.select("subject", F.concat(F.lit("fmri__"), "roi1", F.lit("__"), "roi2").alias("name"),
                    F.coalesce("z", F.lit(0.0)).alias("value"))


def excluded_rois(signal: DataFrame) -> DataFrame:
    """ROIs flagged for exclusion: mean signal below -0.02 over all runs."""
    return signal.groupBy("roi").agg(F.avg("value").alias("m")).filter("m < -0.02").select("roi")


def excluded_edges(signal: DataFrame) -> DataFrame:
    e = S.correlation_edges_gram(signal, RUN)
    return S.exclude_rois(e, excluded_rois(signal)).select("subject", "run", "i", "j", "r")


def symmetry_check(signal: DataFrame) -> DataFrame:
    up = S.correlation_edges_gram(signal, RUN)
    e = up.unionByName(up.select(*RUN, F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    e = e.withColumn("r", F.when((F.col("i") == 0) & (F.col("j") == 1), F.lit(999.0)).otherwise(F.col("r")))
    return S.symmetry_violations(e, RUN)


# ---------------------------------------------------------------- SQL side

def corr_sql(src: str, both: bool = False) -> str:
    cond = "a.roi <> b.roi" if both else "a.roi < b.roi"
    return f"""SELECT a.subject, a.run, a.roi AS i, b.roi AS j,
       covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0) AS r
FROM {src} a JOIN {src} b ON a.subject = b.subject AND a.run = b.run AND a.t = b.t AND {cond}
GROUP BY a.subject, a.run, a.roi, b.roi"""


def clean_sql(src: str) -> str:
    det = f"""SELECT s.subject, s.run, s.t, s.roi, s.network,
       s.value - (coalesce(f.a, 0.0) + coalesce(f.b, 0.0) * s.t) AS value
FROM {src} s JOIN (SELECT subject, run, roi, regr_slope(value, CAST(t AS DOUBLE)) AS b,
                          regr_intercept(value, CAST(t AS DOUBLE)) AS a FROM {src} GROUP BY subject, run, roi) f
  ON s.subject = f.subject AND s.run = f.run AND s.roi = f.roi"""
    return f"""SELECT d.subject, d.run, d.t, d.roi, d.network,
       CASE WHEN f.sd > 0 THEN (d.value - f.m) / f.sd ELSE 0.0 END AS value
FROM ({det}) d JOIN (SELECT subject, run, roi, avg(value) AS m, stddev_pop(value) AS sd FROM ({det}) x
                     GROUP BY subject, run, roi) f
  ON d.subject = f.subject AND d.run = f.run AND d.roi = f.roi"""


def regress_sql(src: str, band: bool = False, keys: tuple[str, ...] = ("subject", "run"),
                confounds: tuple[list[str], list[str]] | None = None) -> str:
    """SIG3 of the series (keys, roi) of ``src``: the confounds are detrended,
    standardised (and limited to the band), then made orthogonal one after
    another; residuals are taken on the rows of ``src``.  ``confounds`` are CTEs,
    the last one ``__d`` (keys, t, ...), and the columns to use; by default the
    four of the global signal."""
    ks = ", ".join(keys)
    on = lambda x, y: " AND ".join(f"{x}.{k} = {y}.{k}" for k in keys)
    of = lambda x: ", ".join(f"{x}.{k}" for k in keys)
    if confounds is None:
        confounds = ([f"__gs AS (SELECT {ks}, t, avg(value) AS gs FROM signal GROUP BY {ks}, t)",
                      f"""__d AS (SELECT {ks}, t, gs,
             coalesce(gs - lag(gs) OVER (PARTITION BY {ks} ORDER BY t), 0.0) AS gd FROM __gs)"""],
                     ["gs", "gd", "gs * gs", "gd * gd"])
    ctes, cols = list(confounds[0]), confounds[1]
    n = len(cols)
    dot = f"sum({{a}} * {{b}}) OVER (PARTITION BY {ks})"
    ctes += [f"""__long AS (SELECT {ks}, t, unnest([{', '.join(map(str, range(n)))}]) AS c,
              unnest([{', '.join(cols)}]) AS value FROM __d)""",
             f"""__fit AS (SELECT {ks}, c, regr_slope(value, CAST(t AS DOUBLE)) AS b,
             regr_intercept(value, CAST(t AS DOUBLE)) AS a, var_pop(value) AS v FROM __long GROUP BY {ks}, c)""",
             f"""__det AS (SELECT {of('l')}, l.c, l.t, f.v,
             l.value - (coalesce(f.a, 0.0) + coalesce(f.b, 0.0) * l.t) AS value
           FROM __long l JOIN __fit f ON {on('l', 'f')} AND l.c = f.c)""",
             f"""__z0 AS (SELECT {ks}, c, t, CASE WHEN s2 > 1e-10 * v THEN (value - m) / sqrt(s2) ELSE 0.0 END AS value
          FROM (SELECT *, avg(value) OVER w AS m, var_pop(value) OVER w AS s2 FROM __det
                WINDOW w AS (PARTITION BY {ks}, c)) x)"""]
    last = "__z0"
    if band:
        ctes.append(f"__z1 AS ({band_sql('__z0', 'c')})")
        last = "__z1"
    wide = ", ".join(f"max(CASE WHEN c = {k} THEN value END) AS x{k}" for k in range(n))
    ctes.append(f"__w AS (SELECT {ks}, t, {wide} FROM {last} GROUP BY {ks}, t)")
    cent = ", ".join(f"x{k} - avg(x{k}) OVER (PARTITION BY {ks}) AS x{k}" for k in range(n))
    ctes.append(f"__o0 AS (SELECT {ks}, t, {cent} FROM __w)")
    # step k keeps column k as it is (0 if only rounding is left of it) and takes its part out of the later ones
    ss = ", ".join(f"{dot.format(a=f'x{k}', b=f'x{k}')} AS t{k}" for k in range(n))
    ctes.append(f"__p0 AS (SELECT *, {ss} FROM __o0)")
    for k in range(n):
        qk = f"CASE WHEN {dot.format(a=f'x{k}', b=f'x{k}')} > 1e-10 * t{k} THEN x{k} ELSE 0.0 END"
        ctes.append(f"__q{k} AS (SELECT * REPLACE ({qk} AS x{k}) FROM __p{k})")
        rest = [f"x{j} - x{k} * coalesce({dot.format(a=f'x{k}', b=f'x{j}')} / "
                f"nullif({dot.format(a=f'x{k}', b=f'x{k}')}, 0), 0.0) AS x{j}" for j in range(k + 1, n)]
        ctes.append(f"__p{k + 1} AS (SELECT * " + (f"REPLACE ({', '.join(rest)}) " if rest else "") + f"FROM __q{k})")
    sums = ", ".join(f"sum(y * x{k}) OVER w / nullif(sum(x{k} * x{k}) OVER w, 0) AS b{k}" for k in range(n))
    fit = " - ".join(f"x{k} * coalesce(b{k}, 0.0)" for k in range(n))
    parts = ", ".join(f"p.x{k}" for k in range(n))
    return f"""WITH {", ".join(ctes)},
__y AS (SELECT {of('s')}, s.t, s.roi, s.value - avg(s.value) OVER (PARTITION BY {of('s')}, s.roi) AS y, {parts}
        FROM {src} s JOIN __p{n} p ON {on('s', 'p')} AND s.t = p.t),
__e AS (SELECT {ks}, t, roi, y, y - {fit} AS e
        FROM (SELECT *, {sums} FROM __y WINDOW w AS (PARTITION BY {ks}, roi)) x)
SELECT {ks}, t, roi,
       CASE WHEN sum(e * e) OVER w > 1e-10 * sum(y * y) OVER w THEN e ELSE 0.0 END AS value
FROM __e WINDOW w AS (PARTITION BY {ks}, roi)"""


BLOCKS = [f"b{k}" for k in range(9)]


def block_confounds(signal: DataFrame) -> DataFrame:
    """36 confounds of each long run: the means of nine blocks of regions (roi mod 9), their
    differences and the squares of both."""
    base = signal.groupBy("run", "t").agg(*[F.avg(F.when(F.col("roi") % 9 == k, F.col("value"))).alias(b)
                                            for k, b in enumerate(BLOCKS)])
    return S.confounds_36p(base, ["run"], ["t"], base_cols=BLOCKS)


def regress_blocks_sql() -> str:
    base = ", ".join(f"avg(CASE WHEN roi % 9 = {k} THEN value END) AS {b}" for k, b in enumerate(BLOCKS))
    der = ", ".join(f"coalesce({b} - lag({b}) OVER (PARTITION BY run ORDER BY t), 0.0) AS {b}_der" for b in BLOCKS)
    cols = BLOCKS + [f"{b}_der" for b in BLOCKS]
    return regress_sql("signal", keys=("run",), confounds=(
        [f"__gs AS (SELECT run, t, {base} FROM signal GROUP BY run, t)", f"__d AS (SELECT run, t, {', '.join(BLOCKS)}, {der} FROM __gs)"],
        cols + [f"{c} * {c}" for c in cols]))


def band_sql(src: str, col: str) -> str:
    """SIG5 of the series (subject, run, col) of ``src`` by explicit cosines."""
    return f"""WITH __s AS (
  SELECT subject, run, {col}, t, coalesce(value, 0.0) AS value, count(*) OVER (PARTITION BY subject, run, {col}) AS n,
         row_number() OVER (PARTITION BY subject, run, {col} ORDER BY t) - 1 AS p FROM {src}),
__b AS (
  SELECT n, p, k, sqrt(2.0 / n) * cos(pi() * k * (p + 0.5) / n) AS phi FROM (
    SELECT n, p, unnest(generate_series(1, n - 1)) AS k FROM (
      SELECT n, unnest(generate_series(0, n - 1)) AS p FROM (SELECT DISTINCT n FROM __s) a) b) c
  WHERE k / (2.0 * n * {TR}) >= {LOW} AND k / (2.0 * n * {TR}) <= {HIGH}),
__c AS (SELECT s.subject, s.run, s.{col}, b.n, b.k, sum(s.value * b.phi) AS amp
        FROM __s s JOIN __b b ON s.n = b.n AND s.p = b.p GROUP BY s.subject, s.run, s.{col}, b.n, b.k),
__f AS (SELECT c.subject, c.run, c.{col}, b.p, sum(c.amp * b.phi) AS f
        FROM __c c JOIN __b b ON c.n = b.n AND c.k = b.k GROUP BY c.subject, c.run, c.{col}, b.p)
SELECT s.subject, s.run, s.{col}, s.t, coalesce(f.f, 0.0) AS value
FROM __s s LEFT JOIN __f f ON s.subject = f.subject AND s.run = f.run AND s.{col} = f.{col} AND s.p = f.p"""


def _run_mean_z_sql(src: str, clean: bool = False) -> str:
    r = "r"
    if clean:
        ex = "(SELECT roi FROM signal GROUP BY roi HAVING avg(value) < -0.02)"
        r = f"CASE WHEN i IN {ex} OR j IN {ex} THEN NULL ELSE r END"
    return f"""SELECT subject, i, j, CASE WHEN count(z) = count(*) THEN avg(z) END AS z FROM (
  SELECT subject, run, i, j,
         CASE WHEN abs(r) < 1 THEN atanh(r) WHEN r = 1 THEN 'inf'::DOUBLE WHEN r = -1 THEN '-inf'::DOUBLE END AS z
  FROM (SELECT subject, run, i, j, {r} AS r FROM ({shrunk_sql(src)}) e0) e) zz
GROUP BY subject, i, j"""


def network_means_sql(src: str, clean: bool) -> str:
    """``clean`` works on the view ``signal``, each step written once."""
    steps = ""
    sig = src
    if clean:
        steps = (f"__clean AS MATERIALIZED ({clean_sql(src)}), __band AS MATERIALIZED ({band_sql('__clean', 'roi')}), "
                 f"__res AS MATERIALIZED ({regress_sql('__band', band=True)}),\n")
        sig = "__res"
    return f"""WITH {steps}__lab AS (SELECT DISTINCT roi, network AS label FROM {src}),
__m AS ({_run_mean_z_sql(sig, clean)})
SELECT subject, roi1, roi2, roi1 || '_' || roi2 AS name, avg(z) AS z FROM (
  SELECT m.subject, m.z, least(li.label, lj.label) AS roi1, greatest(li.label, lj.label) AS roi2
  FROM __m m JOIN __lab li ON li.roi = m.i JOIN __lab lj ON lj.roi = m.j) x
GROUP BY subject, roi1, roi2"""


def pivot_sql(src: str) -> str:
    cols = ", ".join(f"max(CASE WHEN name = '{n}' THEN z END) AS fmri__{n}" for n in network_pair_names())
    return f"SELECT subject, {cols} FROM ({network_means_sql(src, False)}) nm GROUP BY subject"


def full_edges_sql(src: str) -> str:
    return f"""WITH __lab AS (SELECT DISTINCT roi, network || '_' || CAST(roi AS VARCHAR) AS label FROM {src}),
__m AS ({_run_mean_z_sql(src)})
SELECT m.subject, 'fmri__' || least(li.label, lj.label) || '__' || greatest(li.label, lj.label) AS name,
       coalesce(m.z, 0.0) AS value
FROM __m m JOIN __lab li ON li.roi = m.i JOIN __lab lj ON lj.roi = m.j"""


def exclude_sql(src: str) -> str:
    return f"""WITH __x AS (SELECT roi FROM {src} GROUP BY roi HAVING avg(value) < -0.02)
SELECT e.subject, e.run, e.i, e.j,
       CASE WHEN e.i IN (SELECT roi FROM __x) OR e.j IN (SELECT roi FROM __x) THEN NULL ELSE e.r END AS r
FROM ({corr_sql(src)}) e"""


def symmetry_sql(src: str) -> str:
    return f"""WITH __up AS MATERIALIZED ({corr_sql(src)}),
__e AS MATERIALIZED (
  SELECT subject, run, i, j, CASE WHEN i = 0 AND j = 1 THEN 999.0 ELSE r END AS r FROM (
    SELECT subject, run, i, j, r FROM __up UNION ALL SELECT subject, run, j AS i, i AS j, r FROM __up) x)
SELECT * FROM (
  SELECT a.subject, a.run, a.i, a.j, coalesce(a.r, 0.0) AS a, coalesce(b.r, 0.0) AS b
  FROM __e a JOIN __e b ON a.subject = b.subject AND a.run = b.run AND a.i = b.j AND a.j = b.i) ab
WHERE abs(a - b) > 1e-8 + 1e-5 * abs(b)"""


def shrunk_sql(src: str) -> str:
    return f"""WITH __x AS (
  SELECT s.subject, s.run, s.t, s.roi, s.value - m.m AS value
  FROM {src} s JOIN (SELECT subject, run, roi, avg(value) AS m FROM {src} GROUP BY subject, run, roi) m
    ON s.subject = m.subject AND s.run = m.run AND s.roi = m.roi),
__np AS (SELECT subject, run, count(DISTINCT t) AS n, count(DISTINCT roi) AS p FROM __x GROUP BY subject, run),
__sm AS (
  SELECT a.subject, a.run, a.roi AS i, b.roi AS j, sum(a.value * b.value) AS sxx
  FROM __x a JOIN __x b ON a.subject = b.subject AND a.run = b.run AND a.t = b.t AND a.roi <= b.roi
  GROUP BY a.subject, a.run, a.roi, b.roi),
__sv AS (SELECT sm.subject, sm.run, sm.i, sm.j, sm.sxx / np.n AS sv, np.n, np.p
         FROM __sm sm JOIN __np np ON sm.subject = np.subject AND sm.run = np.run),
__b1 AS (SELECT subject, run, sum(q * q) AS beta_raw FROM (
           SELECT subject, run, t, sum(value * value) AS q FROM __x GROUP BY subject, run, t) qq
         GROUP BY subject, run),
__g AS (SELECT subject, run,
               sum(CASE WHEN i = j THEN sv * sv ELSE 2.0 * sv * sv END) AS ss,
               sum(CASE WHEN i = j THEN sv ELSE 0.0 END) AS tr, max(n) AS n, max(p) AS p
        FROM __sv GROUP BY subject, run),
__g2 AS (SELECT g.subject, g.run, g.tr / g.p AS mu,
                least((b.beta_raw / g.n - g.ss) / (g.p * g.n),
                      (g.ss - 2.0 * (g.tr / g.p) * g.tr + g.p * (g.tr / g.p) * (g.tr / g.p)) / g.p) AS beta,
                (g.ss - 2.0 * (g.tr / g.p) * g.tr + g.p * (g.tr / g.p) * (g.tr / g.p)) / g.p AS delta
         FROM __g g JOIN __b1 b ON g.subject = b.subject AND g.run = b.run),
__g3 AS (SELECT subject, run, mu, CASE WHEN beta = 0 THEN 0.0 ELSE beta / nullif(delta, 0) END AS shrink FROM __g2),
__sh AS (SELECT v.subject, v.run, v.i, v.j,
                (1.0 - g.shrink) * v.sv + CASE WHEN v.i = v.j THEN g.shrink * g.mu ELSE 0.0 END AS c
         FROM __sv v JOIN __g3 g ON v.subject = g.subject AND v.run = g.run)
SELECT o.subject, o.run, o.i, o.j, o.c / nullif(sqrt(di.c * dj.c), 0) AS r
FROM __sh o JOIN __sh di ON di.subject = o.subject AND di.run = o.run AND di.i = o.i AND di.j = o.i
            JOIN __sh dj ON dj.subject = o.subject AND dj.run = o.run AND dj.i = o.j AND dj.j = o.j
WHERE o.i < o.j"""
