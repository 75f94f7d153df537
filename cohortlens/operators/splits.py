"""Stratification, deterministic stratified shuffle splits, permutations and
k-fold assignment.

Randomness is replaced by md5 ordering of ``seed:split:...:subject`` strings:
reproducible, engine-independent (Spark and DuckDB give the same md5) and
computed per row, so no random state travels between tasks.

Global statistics (means, sds, correlations, quantile edges, stratum counts)
are small aggregates whose few numbers are brought to the driver and inlined as
literals; no unpartitioned window is ever used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import row_mean, safe_corr
from cohortlens.operators.ranking import range_slices, rank_within
from cohortlens.session import stored


# ---------------------------------------------------------------- global stats

def correlation_to_first(y: DataFrame, targets: Sequence[str]) -> DataFrame:
    """AGG14: correlation of each target with the first one (one row)."""
    first = targets[0]
    return y.agg(*[safe_corr(first, t).alias(t) for t in targets])


def polarity(y: DataFrame, targets: Sequence[str]) -> dict[str, float]:
    """Sign per target: -1 where its correlation with the first is < 0 (strict)."""
    row = correlation_to_first(y, targets).first()
    return {t: (-1.0 if (row[t] is not None and row[t] < 0) else 1.0) for t in targets}


def align_polarity(y: DataFrame, targets: Sequence[str], key: Sequence[str] = ("subject",)) -> DataFrame:
    """PRJ14: negate targets negatively correlated with the first one."""
    sign = polarity(y, targets)
    return y.select(*key, *[(F.lit(sign[t]) * F.col(t)).alias(t) for t in targets])


def aligned_zscore(y: DataFrame, targets: Sequence[str], key: Sequence[str] = ("subject",)) -> DataFrame:
    """PRJ14 then WIN3 from one global aggregate: correlations, means and sds
    of the raw targets (negating a column negates its mean, keeps its sd)."""
    first = targets[0]
    row = y.agg(*[safe_corr(first, t).alias(f"c_{t}") for t in targets],
                *[F.avg(t).alias(f"m_{t}") for t in targets],
                *[F.stddev_pop(t).alias(f"s_{t}") for t in targets]).first()
    out = []
    for t in targets:
        c, m, s = row[f"c_{t}"], row[f"m_{t}"], row[f"s_{t}"]
        sign = -1.0 if (c is not None and c < 0) else 1.0
        if m is None or not s:
            out.append(F.lit(None).cast("double").alias(t))
        else:
            out.append(((F.lit(sign) * F.col(t) - F.lit(sign * m)) / F.lit(s)).alias(t))
    return y.select(*key, *out)


def zscore(y: DataFrame, targets: Sequence[str], key: Sequence[str] = ("subject",)) -> DataFrame:
    """WIN3: (y - mean) / population sd over all rows; constant -> NULL.

    One global aggregate (2k numbers) inlined as literals: never an
    unpartitioned window."""
    row = y.agg(*[F.avg(t).alias(f"m_{t}") for t in targets],
                *[F.stddev_pop(t).alias(f"s_{t}") for t in targets]).first()
    out = []
    for t in targets:
        m, s = row[f"m_{t}"], row[f"s_{t}"]
        if m is None or not s:
            out.append(F.lit(None).cast("double").alias(t))
        else:
            out.append(((F.col(t) - F.lit(m)) / F.lit(s)).alias(t))
    return y.select(*key, *out)


# ---------------------------------------------------------------- exact quantiles

def exact_percentiles(df: DataFrame, c: str, probs: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolation percentiles of column ``c`` (NULLs ignored).

    Equal values are first counted (map-side), so ties cost one row; the distinct
    values are range-partitioned, and the running counts of the partitions that
    hold a wanted rank give its value.  The driver sees one count per partition
    and at most two values per percentile."""
    counts = df.select(F.col(c).alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(
        F.count(F.lit(1)).alias("n"))
    parts = range_slices(counts, [], ["v"])
    first, n = {}, 0                        # rank of the first value of each partition
    for r in sorted(parts.groupBy("__pid").agg(F.sum("n").alias("n")).collect()):
        first[r["__pid"]], n = n, n + r["n"]
    if n == 0:
        return [None] * len(probs)
    ranks = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
    home = {r: max(pid for pid, lo in first.items() if lo <= r) for r in ranks}
    start = F.create_map(*[F.lit(x) for pid in sorted(set(home.values())) for x in (pid, first[pid])])
    running = F.sum("n").over(Window.partitionBy("__pid").orderBy("v"))
    upto = parts.filter(F.col("__pid").isin(sorted(set(home.values())))).select(
        "v", "n", (F.try_element_at(start, F.col("__pid")) + running).alias("hi"))
    wanted = F.exists(F.array(*[F.lit(r).cast("long") for r in ranks]),
                      lambda r: (r < F.col("hi")) & (r >= F.col("hi") - F.col("n")))
    got = sorted((r["hi"], r["v"]) for r in upto.filter(wanted).collect())
    stat = {r: next(v for hi, v in got if r < hi) for r in ranks}
    out = []
    for p in probs:
        h = p * (n - 1)
        lo, hi = stat[math.floor(h)], stat[math.ceil(h)]
        out.append(lo + (hi - lo) * (h - math.floor(h)))
    return out


# fixed values: 20 quantile bins -> 21 equally spaced probabilities
QUANTILE_PROBS = [k / 20 for k in range(21)]


def quantile_bins(df: DataFrame, c: str, probs: Sequence[float] = QUANTILE_PROBS, out: str = "stratum") -> DataFrame:
    """WIN5: bin by quantile edges (linear), duplicate edges dropped,
    right-closed bins with the lowest edge included: bin = #inner edges < x."""
    edges = exact_percentiles(df, c, probs)
    uniq = sorted(set(e for e in edges if e is not None))
    inner = uniq[1:-1] if len(uniq) > 1 else []
    if not inner:
        b = F.lit(0)
    else:
        b = sum((F.when(F.col(c) > F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
    return df.withColumn(out, F.when(F.col(c).isNotNull(), b.cast("int")))


def stratify(y: DataFrame, targets: Sequence[str], key: Sequence[str] = ("subject",)) -> DataFrame:
    """WIN6: polarity -> z-score -> row mean -> 20 quantile bins."""
    z = aligned_zscore(y.select(*key, *targets), targets, key)
    zm = stored(z.select(*key, row_mean(list(targets)).alias("z")))   # read by the quantile passes
    return quantile_bins(zm, "z")


# ---------------------------------------------------------------- splits

def md5_key(*parts: Column | str) -> Column:
    cols = [F.col(p) if isinstance(p, str) and not p.startswith("'") else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def largest_remainder(counts: dict, total: int, n: int) -> dict:
    """Integer quotas floor(c·total/n) plus one for the largest remainders
    (ties by key order), summing to ``total``."""
    base = {k: (c * total) // n for k, c in counts.items()}
    rem = {k: (c * total) % n for k, c in counts.items()}
    short = total - sum(base.values())
    for k in sorted(counts, key=lambda k: (-rem[k], k is None, 0 if k is None else k))[:short]:
        base[k] += 1
    return base


def stratified_shuffle_splits(strata: DataFrame, n_splits: int, test_size: float = 0.2, seed: int = 1234,
                              key: str = "subject", stratum: str = "stratum") -> DataFrame:
    """ML1: (split, subject, role) for ``n_splits`` stratified shuffle splits.

    test = ceil(test_size·n), train = n - test; per-stratum train quota by
    largest remainder; inside (split, stratum) subjects are ordered by
    md5(seed:split:subject) and the first ``quota`` are train.  Subjects without
    a stratum (NULL) are a stratum of their own.
    """
    strata = stored(strata.select(key, stratum))   # counted, then ranked
    counts = {r[stratum]: r["n"] for r in strata.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    quota = largest_remainder(counts, n_train, n)
    q = None
    for s, v in quota.items():
        same = F.col(stratum).eqNullSafe(F.lit(s))
        q = F.when(same, F.lit(v)) if q is None else q.when(same, F.lit(v))
    rows = strata.select(key, stratum, F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split"))
    ranked = rank_within(rows, ["split", stratum], [md5_key(F.lit(seed), "split", key), F.col(key)], "__rk")
    return ranked.select("split", key, F.when(F.col("__rk") <= q, F.lit("train")).otherwise(F.lit("test"))
                         .alias("role"))


def permute_within(members: DataFrame, values: DataFrame, value_cols: Sequence[str], seed: int = 1234,
                   key: str = "subject", group: Sequence[str] = ("split", "role")) -> DataFrame:
    """WIN8: one shuffle of the values within each (split, role).

    Position k in subject order receives the values of position k in
    md5(seed:split:role:subject) order: two row_numbers joined on rank.
    """
    group = list(group)
    m = members.join(values.select(key, *value_cols), key)
    left = rank_within(m.select(*group, key), group, [F.col(key)], "__rk")
    right = rank_within(m.select(*group, key, *[F.col(c).alias(f"__v_{c}") for c in value_cols]), group,
                        [md5_key(F.lit(seed), *group, key), F.col(key)], "__rk").drop(key)
    j = left.join(right, group + ["__rk"])
    return j.select(*group, key, *[F.col(f"__v_{c}").alias(c) for c in value_cols])


def kfold(members: DataFrame, k: int = 5, key: str = "subject", group: Sequence[str] = ("split",),
          out: str = "fold", place: str | None = None, total: str | None = None) -> DataFrame:
    """WIN10: contiguous k-fold over subject order within each group; the
    first n % k folds hold one extra row.  ``place`` and ``total`` name columns for the
    0-based position and the number of rows of the group."""
    group = list(group)
    n = members.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    r = rank_within(members.join(n, group), group, [F.col(key)], "__p1").withColumn("__p", F.col("__p1") - 1)
    r = r.drop("__p1")
    q = F.floor(F.col("__n") / k)
    rr = F.col("__n") % k
    big = rr * (q + 1)
    # a group of fewer than k rows has q = 0: all its rows are below ``big``
    fold = F.when(F.col("__p") < big, F.floor(F.col("__p") / (q + 1))).otherwise(
        rr + F.floor((F.col("__p") - big) / F.greatest(q, F.lit(1))))
    further = [F.col(c).alias(name) for c, name in (("__p", place), ("__n", total)) if name]
    return r.select(*members.columns, fold.cast("int").alias(out), *further)


def first_fraction(members: DataFrame, fraction: float, key: str = "subject",
                   group: Sequence[str] = ("fold",)) -> DataFrame:
    """Learning-curve sizes: the first ceil-free int(fraction·n) rows of each
    group in subject order (the training part of a fold)."""
    group = list(group)
    n = members.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    r = rank_within(members.join(n, group), group, [F.col(key)], "__p")
    return r.filter(F.col("__p") <= F.floor(F.col("__n") * fraction)).drop("__n", "__p")
