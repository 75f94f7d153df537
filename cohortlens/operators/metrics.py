"""Grouped model-evaluation metrics (weighted R², MAE, macro F1, Pearson r²),
their long form, box summaries and pairwise model comparison.

All metrics are plain aggregates, so Spark runs them as partial (map-side) +
final aggregation: a group holding a third of all rows never lands whole in
one task.  R² needs the weighted group mean first (two passes, numerically
stable); the first pass yields one row per group which is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import safe_corr, safe_div
from cohortlens.operators.ranking import join_slices, range_slices

# fixed values: metric names accepted in the long form, in the order their
# prefixes are removed from column names ("pearsonr2_" before "r2_")
ALLOWED_METRICS = ["pearsonr2", "r2", "f1", "mae"]

def _w(weight_col: str | None) -> Column:
    return F.col(weight_col).cast("double") if weight_col else F.lit(1.0)


def _r2_from_sums(ss_res: Column, ss_tot: Column, n: Column) -> Column:
    """R² from residual and total sums of squares.

    Zero total variance: 1.0 when the fit is perfect, else 0.0; fewer than two
    rows: NULL (the metric is undefined).
    """
    return (F.when(n < 2, F.lit(None).cast("double"))
            .when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - ss_res / ss_tot))


def _group_means(df: DataFrame, group_cols: Sequence[str], y_cols: Sequence[str],
                 weight_col: str | None) -> DataFrame:
    w = _w(weight_col)
    aggs = [F.sum(w).alias("__sw")]
    for y in y_cols:
        aggs.append(safe_div(F.sum(w * F.col(y)), F.sum(w)).alias(f"__wm_{y}"))
    return df.groupBy(*group_cols).agg(*aggs)


def calc_metrics(df: DataFrame, y_cols: Sequence[str], metric_names: Sequence[str] = ("r2", "mae"),
                 group_cols: Sequence[str] = ("modality", "split"), kind: str = "",
                 weight_col: str | None = None, return_average: bool = False) -> DataFrame:
    """Per-group metrics for predictions ``{y}_pred`` against truth ``{y}``.

    Output columns: group columns, then per target ``r2_{y}``, ``pearsonr2_{y}``,
    ``mae_{y}``, ``f1_{y}`` (those requested), then the averages, then ``kind``.
    Averages (only with ``return_average`` and more than one target) are
    unweighted: mean R² over targets, multilabel macro F1, row mean of r².
    """
    y_cols = list(y_cols)
    group_cols = list(group_cols)
    metric_names = list(metric_names)
    for m in metric_names:
        if m not in ALLOWED_METRICS:
            raise ValueError(f"unknown metric {m}")
    if "f1" in metric_names:
        f1 = macro_f1(df, y_cols, group_cols, weight_col)
    else:
        f1 = None
    do_avg = return_average and len(y_cols) > 1
    w = _w(weight_col)
    need_r2 = "r2" in metric_names
    if need_r2 and weight_col is not None:      # without weights the variance is an aggregate of the same scan
        base = df.join(_group_means(df, group_cols, y_cols, weight_col), group_cols)
    else:
        base = df
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for y in y_cols:
        yc, pc = F.col(y), F.col(f"{y}_pred")
        if need_r2:
            aggs.append(F.sum(w * (yc - pc) * (yc - pc)).alias(f"__ssr_{y}"))
            spread = F.var_pop(yc) * F.count(yc)
            aggs.append((spread if weight_col is None else F.sum(
                w * (yc - F.col(f"__wm_{y}")) * (yc - F.col(f"__wm_{y}")))).alias(f"__sst_{y}"))
            if do_avg:
                aggs.append(F.sum((yc - pc) * (yc - pc)).alias(f"__ussr_{y}"))
                aggs.append(spread.alias(f"__usst_{y}"))
        if "pearsonr2" in metric_names:
            aggs.append(F.pow(safe_corr(yc, pc), 2).alias(f"pearsonr2_{y}"))
        if "mae" in metric_names:
            aggs.append(safe_div(F.sum(w * F.abs(yc - pc)), F.sum(w)).alias(f"mae_{y}"))
    agg = base.groupBy(*group_cols).agg(*aggs)
    n = F.col("__n")
    out: list[Column] = [F.col(c) for c in group_cols]
    for y in y_cols:
        if need_r2:
            out.append(_r2_from_sums(F.col(f"__ssr_{y}"), F.col(f"__sst_{y}"), n).alias(f"r2_{y}"))
        if "pearsonr2" in metric_names:
            out.append(F.col(f"pearsonr2_{y}"))
        if "mae" in metric_names:
            out.append(F.col(f"mae_{y}"))
        if f1 is not None:
            out.append(F.col(f"f1_{y}"))
    if do_avg and need_r2:
        r2s = [_r2_from_sums(F.col(f"__ussr_{y}"), F.col(f"__usst_{y}"), n) for y in y_cols]
        out.append((sum(r2s[1:], r2s[0]) / F.lit(float(len(r2s)))).alias("r2_average"))
    if do_avg and f1 is not None:
        out.append(F.col("f1_average"))
    if do_avg and "pearsonr2" in metric_names:
        from cohortlens.functions import row_mean
        out.append(row_mean([f"pearsonr2_{y}" for y in y_cols]).alias("pearsonr2_average"))
    if f1 is not None:
        agg = agg.join(f1, group_cols, "left")
    out.append(F.lit(kind).alias("kind"))
    return agg.select(*out)


def macro_f1(df: DataFrame, y_cols: Sequence[str], group_cols: Sequence[str] = ("modality", "split"),
             weight_col: str | None = None) -> DataFrame:
    """Macro F1 per group over the union of true and predicted classes.

    Each row contributes one (class, true) and one (class, predicted) record;
    two aggregation levels (group+class, then group) give per-class tp/fp/fn
    and their mean.  0/0 counts as 0.  Also ``f1_average``: multilabel macro F1
    over binary targets (positive class 1), unweighted.
    """
    y_cols, group_cols = list(y_cols), list(group_cols)
    w = _w(weight_col)
    result = None
    for y in y_cols:
        rec = df.select(*group_cols, w.alias("__w"),
                        F.explode(F.array(
                            F.struct(F.col(y).alias("c"), F.lit(1.0).alias("t"), F.lit(0.0).alias("p"),
                                     (F.col(y) == F.col(f"{y}_pred")).cast("double").alias("hit")),
                            F.struct(F.col(f"{y}_pred").alias("c"), F.lit(0.0).alias("t"), F.lit(1.0).alias("p"),
                                     F.lit(0.0).alias("hit")))).alias("r"))
        per_class = rec.groupBy(*group_cols, F.col("r.c").alias("c")).agg(
            F.sum(F.col("__w") * F.col("r.hit")).alias("tp"),
            F.sum(F.col("__w") * F.col("r.t")).alias("n_true"),
            F.sum(F.col("__w") * F.col("r.p")).alias("n_pred"))
        f1c = F.coalesce(safe_div(2 * F.col("tp"), F.col("n_true") + F.col("n_pred")), F.lit(0.0))
        per_group = per_class.groupBy(*group_cols).agg(F.avg(f1c).alias(f"f1_{y}"))
        result = per_group if result is None else result.join(per_group, group_cols, "full")
    if len(y_cols) > 1:
        aggs = []
        for y in y_cols:
            t = (F.col(y) == 1).cast("double")
            p = (F.col(f"{y}_pred") == 1).cast("double")
            aggs.append(F.coalesce(safe_div(2 * F.sum(t * p), F.sum(t) + F.sum(p)), F.lit(0.0)))
        avg = df.groupBy(*group_cols).agg((sum(aggs[1:], aggs[0]) / F.lit(float(len(aggs)))).alias("f1_average"))
        result = result.join(avg, group_cols, "full")
    return result


def metrics_to_long(df: DataFrame, metric_type: str, y_cols: Sequence[str],
                    includes_average: bool = False,
                    id_cols: Sequence[str] = ("modality", "split", "kind")) -> DataFrame:
    """Unpivot ``{metric}_{target}`` columns to (ids..., target, {metric})."""
    if metric_type not in ALLOWED_METRICS:
        raise ValueError(metric_type)
    y_cols = list(y_cols)
    value_vars = []
    if metric_type in ("r2", "f1", "pearsonr2") and len(y_cols) > 1 and includes_average:
        value_vars.append(f"{metric_type}_average")
    value_vars += [f"{metric_type}_{c}" for c in y_cols]
    long = df.unpivot(list(id_cols), value_vars, "target", metric_type)
    return long.withColumn("target", strip_metric_prefix(F.col("target")))


def strip_metric_prefix(c: Column) -> Column:
    """Remove every ``{metric}_`` substring, metrics taken in the fixed order."""
    for m in ALLOWED_METRICS:
        c = F.replace(c, F.lit(f"{m}_"), F.lit(""))
    return c


def compare_distributions(df: DataFrame, m1_col: str, m2_col: str,
                          group_cols: Sequence[str] = ()) -> DataFrame:
    """Pairwise comparison of two score columns (optionally per group).

    m1_better_m2 / m2_better_m1 in percent (a NULL comparison counts as not
    better), n_splits = rows, mean_diff / std_diff of m2 - m1 (sample sd).
    """
    m1, m2 = F.col(m1_col), F.col(m2_col)
    aggs = [
        (F.avg(F.when(m1 > m2, 1.0).otherwise(0.0)) * 100.0).alias("m1_better_m2"),
        (F.avg(F.when(m2 > m1, 1.0).otherwise(0.0)) * 100.0).alias("m2_better_m1"),
        F.count(F.lit(1)).alias("n_splits"),
        F.avg(m2 - m1).alias("mean_diff"),
        F.stddev_samp(m2 - m1).alias("std_diff"),
    ]
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return g.agg(*aggs)


def ranked_values(df: DataFrame, value_col: str, group_cols: Sequence[str]) -> DataFrame:
    """The distinct values of each group with their number ``__n``, the number of values up to
    and with them ``__upto`` and the group's number of values ``n``.

    Equal values are counted first (map-side); the distinct ones are range-partitioned, so a
    group of any size is spread over the partitions.  NULL values count 0."""
    group = list(group_cols)
    v = F.col(value_col)
    counts = df.select(*group, v.alias("__v")).groupBy(*group, "__v").agg(F.count("__v").alias("__n"))
    parts = range_slices(counts, group, ["__v"])
    slices = parts.groupBy("__pid", *group).agg(F.sum("__n").alias("__c"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("__pid", *group, F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"),
                           F.sum("__c").over(whole).alias("n"))
    running = F.sum("__n").over(Window.partitionBy("__pid", *group).orderBy("__v"))
    return join_slices(parts.withColumn("__run", running), slices, group).select(
        *group, "__v", "__n", (F.col("__off") + F.col("__run")).alias("__upto"), "n")


def percentiles_by_group(ranked: DataFrame, group_cols: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear interpolation) of all groups of ``ranked_values`` in one aggregate."""
    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("__upto")) & (rank >= F.col("__upto") - F.col("__n")), F.col("__v")))

    def place(p: float) -> Column:
        return F.lit(p) * (F.col("n") - 1)

    both = [c for name, p in probs.items() for c in (value_at(F.floor(place(p))).alias(f"__lo_{name}"),
                                                     value_at(F.ceil(place(p))).alias(f"__hi_{name}"))]
    found = ranked.groupBy(*group_cols, "n").agg(*both)

    def between(name: str, p: float) -> Column:
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return F.when(lo == hi, lo).otherwise((F.ceil(place(p)) - place(p)) * lo + (place(p) - F.floor(place(p))) * hi)

    return found.select(*group_cols, "n", *[between(name, p).alias(name) for name, p in probs.items()])


def box_summary(df: DataFrame, value_col: str, group_cols: Sequence[str] = ("target", "modality"),
                max_over: Sequence[str] = ("target",), whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles (linear interpolation), whiskers at
    the most extreme values within ``whisker``·IQR of the box, outlier count,
    the median label rounded to 2 and the largest median within ``max_over``.

    ``df`` is read once; a group may have any number of values.  A group without
    values has n = 0 and NULL numbers; groups with a NULL key are left out.
    """
    group_cols = list(group_cols)
    ranked = ranked_values(df, value_col, group_cols)
    quart = percentiles_by_group(ranked, group_cols, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - whisker * F.col("iqr")
    hi_f = F.col("q3") + whisker * F.col("iqr")
    joined = ranked.drop("n").join(quart, group_cols)
    x = F.col("__v")
    wk = joined.groupBy(*group_cols).agg(
        F.min(F.when(x >= lo_f, x)).alias("whisker_lo"),
        F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
        F.sum(F.when((x < lo_f) | (x > hi_f), F.col("__n")).otherwise(0)).cast("bigint").alias("n_outliers"))
    res = quart.join(wk, group_cols)
    mx = res.groupBy(*max_over).agg(F.max("median").alias("max_median"))
    return res.join(mx, list(max_over)).select(
        *group_cols, F.col("n").cast("bigint").alias("n"), "q1", "median", "q3", "iqr",
        "whisker_lo", "whisker_hi", "n_outliers",
        F.round(F.col("median"), 2).alias("median_label"), "max_median")
