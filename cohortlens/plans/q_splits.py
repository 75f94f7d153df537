"""Queries: stratification, splits, permutations, folds and density weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import checks as C
from cohortlens.operators import density as D
from cohortlens.operators import splits as SP
from cohortlens.plans.registry import register, rounded
from cohortlens.sources import tables as V
from cohortlens.sources.tables import with_views

T = ["acctbal", "total_price"]
N_SPLITS = 5
SEED = 1234


def _corr(a, b):
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


_CORR_SQL = f"SELECT {_corr('acctbal', 'acctbal')} AS acctbal, {_corr('acctbal', 'total_price')} AS total_price " \
            "FROM targets"


@register("agg_corr_to_first", rounded(with_views(_CORR_SQL, "targets"), T))
def q_corr_to_first(spark, sf):
    """AGG14: correlation of every target with the first target."""
    return SP.correlation_to_first(V.targets(spark, sf), T)


_ALIGN = f"""SELECT t.subject,
       CASE WHEN c.acctbal < 0 THEN -1.0 ELSE 1.0 END * t.acctbal AS acctbal,
       CASE WHEN c.total_price < 0 THEN -1.0 ELSE 1.0 END * t.total_price AS total_price
FROM targets t, ({_CORR_SQL}) c"""


@register("prj_align_polarity", rounded(with_views(_ALIGN, "targets"), T))
def q_align(spark, sf):
    """PRJ14: negate targets negatively correlated with the first."""
    return SP.align_polarity(V.targets(spark, sf), T)


_Z = f"""SELECT a.subject,
       (a.acctbal - s.m1) / nullif(s.s1, 0) AS acctbal, (a.total_price - s.m2) / nullif(s.s2, 0) AS total_price
FROM ({_ALIGN}) a, (SELECT avg(acctbal) AS m1, stddev_pop(acctbal) AS s1, avg(total_price) AS m2,
                           stddev_pop(total_price) AS s2 FROM ({_ALIGN}) x) s"""


@register("win_zscore", rounded(with_views(_Z, "targets"), T))
def q_zscore(spark, sf):
    """WIN3 (after PRJ14): global z-score with population sd."""
    return SP.zscore(SP.align_polarity(V.targets(spark, sf), T), T)


_ZM = f"""SELECT subject, (coalesce(acctbal, 0.0) + coalesce(total_price, 0.0))
       / nullif(CAST(acctbal IS NOT NULL AS INTEGER) + CAST(total_price IS NOT NULL AS INTEGER), 0) AS z
FROM ({_Z}) zz"""

_PROBS = ", ".join(repr(p) for p in SP.QUANTILE_PROBS)
_STRATA = f"""SELECT subject, z,
       CASE WHEN z IS NULL THEN NULL ELSE CAST(len(list_filter(inner_e, lambda e: e < z)) AS INTEGER) END AS stratum
FROM ({_ZM}) m, (SELECT CASE WHEN len(u) > 1 THEN list_slice(u, 2, len(u) - 1) ELSE [] END AS inner_e FROM (
      SELECT list_sort(list_distinct(quantile_cont(z, [{_PROBS}]))) AS u FROM ({_ZM}) q) qq) e"""


def _strata(spark, sf):
    return SP.stratify(V.targets(spark, sf), T)


@register("win_stratify", rounded(with_views(_STRATA, "targets"), ["z"]))
def q_stratify(spark, sf):
    """WIN4+WIN5+WIN6: row mean of aligned z-scores cut into 20 quantile bins."""
    return _strata(spark, sf)


_SPLIT_CTES = f"""__s AS ({_STRATA}),
__c AS (SELECT stratum, count(*) AS c FROM __s GROUP BY stratum),
__n AS (SELECT sum(c) AS n, sum(c) - CAST(ceil(0.2 * sum(c)) AS BIGINT) AS n_train FROM __c),
__q0 AS (SELECT stratum, (c * n_train) // n AS base, (c * n_train) % n AS rem, n_train FROM __c, __n),
__q AS (SELECT stratum, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum)
                                   <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM __q0),
__r AS (SELECT s.subject, s.stratum, sp.split,
               row_number() OVER (PARTITION BY sp.split, s.stratum
                                  ORDER BY md5('{SEED}:' || CAST(sp.split AS VARCHAR) || ':' || s.subject), s.subject)
                 AS rk
        FROM __s s, (SELECT CAST(unnest(generate_series(0, {N_SPLITS - 1})) AS INTEGER) AS split) sp),
__sp AS (SELECT r.split, r.subject, CASE WHEN r.rk <= q.quota THEN 'train' ELSE 'test' END AS role
         FROM __r r JOIN __q q ON r.stratum = q.stratum)"""

_SPLITS = f"WITH {_SPLIT_CTES}\nSELECT split, subject, role FROM __sp"


def _splits(spark, sf):
    return SP.stratified_shuffle_splits(_strata(spark, sf), N_SPLITS, seed=SEED)


@register("ml_stratified_splits", with_views(_SPLITS, "targets"))
def q_splits(spark, sf):
    """ML1: 5 stratified shuffle splits (test = ceil(20%)) by md5 order."""
    return _splits(spark, sf)


@register("chk_train_test_overlap", with_views(f"""WITH {_SPLIT_CTES},
__m AS (SELECT split, subject, role FROM __sp
        UNION ALL SELECT split, subject, 'train' AS role FROM __sp WHERE split = 0 AND role = 'test')
SELECT split, subject FROM __m GROUP BY split, subject HAVING count(DISTINCT role) > 1""", "targets"))
def q_overlap(spark, sf):
    """V9/SET3: train/test overlap, with split 0's test rows planted as train too."""
    m = _splits(spark, sf)
    planted = m.filter("split = 0 AND role = 'test'").withColumn("role", F.lit("train"))
    return C.train_test_overlap(m.unionByName(planted))


@register("win_permute", rounded(with_views(f"""WITH {_SPLIT_CTES},
__m AS (SELECT sp.split, sp.role, sp.subject, t.total_price FROM __sp sp JOIN targets t ON sp.subject = t.subject),
__ll AS (SELECT split, role, subject, row_number() OVER (PARTITION BY split, role ORDER BY subject) AS rk FROM __m),
__rr AS (SELECT split, role, total_price, row_number() OVER (
          PARTITION BY split, role ORDER BY md5('{SEED}:' || CAST(split AS VARCHAR) || ':' || role || ':' || subject),
                                             subject) AS rk FROM __m)
SELECT l.split, l.role, l.subject, r.total_price FROM __ll l JOIN __rr r
  ON l.split = r.split AND l.role = r.role AND l.rk = r.rk""", "targets"), ["total_price"]))
def q_permute(spark, sf):
    """WIN8: one md5-ordered shuffle of the target within each (split, role)."""
    return SP.permute_within(_splits(spark, sf), V.targets(spark, sf), ["total_price"], seed=SEED)


@register("win_kfold", with_views(f"""WITH {_SPLIT_CTES},
__t AS (SELECT split, subject, row_number() OVER (PARTITION BY split ORDER BY subject) - 1 AS p,
               count(*) OVER (PARTITION BY split) AS n FROM __sp WHERE role = 'train')
SELECT split, subject,
       CAST(CASE WHEN p < (n % 5) * (n // 5 + 1) THEN p // (n // 5 + 1)
                 ELSE (n % 5) + (p - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
FROM __t""", "targets"))
def q_kfold(spark, sf):
    """WIN10: contiguous 5-fold assignment of each split's training subjects."""
    tr = _splits(spark, sf).filter("role = 'train'").select("split", "subject")
    return SP.kfold(tr, 5)


_DENS = f"""WITH __z AS ({_Z}), __n AS (SELECT count(*) AS n FROM __z)
SELECT a.subject, -(ln(sum(exp(-0.5 * ((a.acctbal - b.acctbal) * (a.acctbal - b.acctbal)
                                    + (a.total_price - b.total_price) * (a.total_price - b.total_price)))))
                  - ln(max(__n.n)) - ln(2 * pi())) AS weight
FROM __z a, __z b, __n GROUP BY a.subject"""


@register("agg_density_weights", rounded(with_views(_DENS, "targets"), ["weight"]))
def q_density(spark, sf):
    """AGG13: -log Gaussian KDE (bandwidth 1) of the z-scored targets, self included."""
    z = SP.zscore(SP.align_polarity(V.targets(spark, sf), T), T)
    return D.density_weights(z, T)


_DENS_RAW = """SELECT a.subject, -(ln(sum(exp(-0.5 * ((a.acctbal - b.acctbal) * (a.acctbal - b.acctbal)
                                    + (a.total_price - b.total_price) * (a.total_price - b.total_price)))))
                  - ln(count(*)) - ln(2 * pi())) AS weight
FROM targets a, targets b GROUP BY a.subject"""


@register("agg_density_weights_raw", rounded(with_views(_DENS_RAW, "targets"), ["weight"]))
def q_density_raw(spark, sf):
    """AGG13 as the weighted fits use it: kernel density (bandwidth 1) of the targets as they are."""
    return D.density_weights(V.targets(spark, sf), T)
