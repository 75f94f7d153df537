"""Queries: evaluation metrics on the ``pred`` and ``cls`` views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import metrics as M
from cohortlens.plans.registry import register, rounded
from cohortlens.sources import tables as V

Y = ["price", "tax"]


# ---------------------------------------------------------------- SQL helpers

def _sq(e: str) -> str:
    return f"(({e}) * ({e}))"


def _r2_sql(y: str, w: str, mean: str) -> str:
    ssr = f"sum({w} * {_sq(f'{y} - {y}_pred')})"
    sst = f"sum({w} * {_sq(f'{y} - {mean}')})"
    return (f"CASE WHEN count(*) < 2 THEN NULL WHEN {sst} = 0 THEN CASE WHEN {ssr} = 0 THEN 1.0 ELSE 0.0 END "
            f"ELSE 1.0 - {ssr} / {sst} END")


def _corr_sql(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


def _means_cte(view: str, ys: list[str], w: str = "weight") -> str:
    cols = ", ".join(f"sum({w} * {y}) / nullif(sum({w}), 0) AS wm_{y}, avg({y}) AS m_{y}" for y in ys)
    return f"__m AS (SELECT modality, split, {cols} FROM {view} GROUP BY modality, split)"


def _metrics_sql(weighted: bool, metrics: list[str], average: bool, kind: str) -> tuple[str, list[str]]:
    w = "p.weight" if weighted else "1.0"
    sel, dbl = [], []
    for y in Y:
        if "r2" in metrics:
            sel.append(_r2_sql(f"p.{y}", w, f"__m.{'wm' if weighted else 'm'}_{y}") + f" AS r2_{y}")
            dbl.append(f"r2_{y}")
        if "pearsonr2" in metrics:
            sel.append(f"power({_corr_sql(f'p.{y}', f'p.{y}_pred')}, 2) AS pearsonr2_{y}")
            dbl.append(f"pearsonr2_{y}")
        if "mae" in metrics:
            sel.append(f"sum({w} * abs(p.{y} - p.{y}_pred)) / nullif(sum({w}), 0) AS mae_{y}")
            dbl.append(f"mae_{y}")
    if average and "r2" in metrics:
        parts = [_r2_sql(f"p.{y}", "1.0", f"__m.m_{y}") for y in Y]
        sel.append("((" + ") + (".join(parts) + f")) / {float(len(parts))} AS r2_average")
        dbl.append("r2_average")
    body = ", ".join(sel)
    sql = f"""SELECT modality, split, {body}, '{kind}' AS kind
FROM pred p JOIN __m USING (modality, split) GROUP BY modality, split"""
    if average and "pearsonr2" in metrics:
        # row mean over the per-target r² columns, NULLs skipped
        cols = [f"pearsonr2_{y}" for y in Y]
        num = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
        den = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
        inner_cols = ", ".join(c for c in dbl)
        sql = (f"SELECT modality, split, {inner_cols}, ({num}) / nullif({den}, 0) AS pearsonr2_average, kind "
               f"FROM ({sql}) __x")
        dbl.append("pearsonr2_average")
    return sql, dbl


def _metrics_query_sql(weighted: bool, metrics: list[str], average: bool, kind: str) -> str:
    sql, dbl = _metrics_sql(weighted, metrics, average, kind)
    full = f"WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)}\n{sql}"
    return rounded(full, dbl)


# ---------------------------------------------------------------- queries

_SQL = _metrics_query_sql(True, ["r2"], False, "test")


@register("agg_r2_weighted", _SQL)
def q_r2_weighted(spark, sf):
    """AGG6: weighted R² per (modality, split) for two targets."""
    return M.calc_metrics(V.pred(spark, sf), Y, ["r2"], weight_col="weight", kind="test")


@register("agg_mae_weighted", _metrics_query_sql(True, ["mae"], False, "test"))
def q_mae_weighted(spark, sf):
    """AGG7: weighted MAE per (modality, split)."""
    return M.calc_metrics(V.pred(spark, sf), Y, ["mae"], weight_col="weight", kind="test")


@register("agg_pearsonr2", _metrics_query_sql(False, ["pearsonr2"], False, "test"))
def q_pearsonr2(spark, sf):
    """AGG9: squared Pearson correlation per group (always unweighted)."""
    return M.calc_metrics(V.pred(spark, sf), Y, ["pearsonr2"], kind="test")


@register("agg_calc_metrics", _metrics_query_sql(False, ["r2", "pearsonr2", "mae"], True, "test"))
def q_calc_metrics(spark, sf):
    """AGG10+AGG11: all regression metrics plus target averages."""
    return M.calc_metrics(V.pred(spark, sf), Y, ["r2", "pearsonr2", "mae"], kind="test",
                          return_average=True)


# macro F1 on the class view ---------------------------------------------------

_F1_SQL = rounded(f"""
WITH cls AS ({V.CLS_SQL}),
rec AS (
  SELECT modality, split, weight AS w, quality AS c, 1.0 AS t, 0.0 AS p,
         CASE WHEN quality = quality_pred THEN 1.0 ELSE 0.0 END AS hit FROM cls
  UNION ALL
  SELECT modality, split, weight AS w, quality_pred AS c, 0.0 AS t, 1.0 AS p, 0.0 AS hit FROM cls),
pc AS (SELECT modality, split, c, sum(w * hit) AS tp, sum(w * t) AS nt, sum(w * p) AS np
       FROM rec GROUP BY modality, split, c)
SELECT modality, split, avg(coalesce(2 * tp / nullif(nt + np, 0), 0.0)) AS f1_quality, 'test' AS kind
FROM pc GROUP BY modality, split""", ["f1_quality"])


@register("agg_macro_f1", _F1_SQL)
def q_macro_f1(spark, sf):
    """AGG8: weighted macro F1 per (source, split) on document labels."""
    return M.calc_metrics(V.cls(spark, sf), ["quality"], ["f1"], weight_col="weight", kind="test")


_F1_PART = ("coalesce(2 * sum(CASE WHEN {y} = 1 AND {p} = 1 THEN 1.0 ELSE 0.0 END) / nullif("
            "sum(CASE WHEN {y} = 1 THEN 1.0 ELSE 0.0 END) + sum(CASE WHEN {p} = 1 THEN 1.0 ELSE 0.0 END), 0), 0.0)")


@register("agg_f1_average", rounded(f"""
SELECT modality, split, ({_F1_PART.format(y="quality", p="quality_pred")}
                         + {_F1_PART.format(y="clean", p="clean_pred")}) / 2.0 AS f1_average
FROM (SELECT *, quality_pred AS clean, quality AS clean_pred FROM ({V.CLS_SQL}) c0) c GROUP BY modality, split""",
                                   ["f1_average"]))
def q_f1_average(spark, sf):
    """AGG10: mean F1 of the positive class over two binary targets per (source, split)."""
    both = V.cls(spark, sf).select("*", F.col("quality_pred").alias("clean"), F.col("quality").alias("clean_pred"))
    return M.macro_f1(both, ["quality", "clean"]).select("modality", "split", "f1_average")


# long form, box summary, comparison ------------------------------------------

_LONG_INNER, _ = _metrics_sql(False, ["r2"], True, "test")
_LONG_SQL = rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)},
wide AS ({_LONG_INNER})
SELECT modality, split, kind, 'average' AS target, r2_average AS r2 FROM wide
UNION ALL SELECT modality, split, kind, 'price' AS target, r2_price AS r2 FROM wide
UNION ALL SELECT modality, split, kind, 'tax' AS target, r2_tax AS r2 FROM wide""", ["r2"])


def _long(spark, sf):
    wide = M.calc_metrics(V.pred(spark, sf), Y, ["r2"], kind="test", return_average=True)
    return M.metrics_to_long(wide, "r2", Y, includes_average=True)


@register("rsh_metrics_long", _LONG_SQL)
def q_metrics_long(spark, sf):
    """RSH4 + PRJ20: R² per target in long form, average included."""
    return _long(spark, sf)


_BOX_SQL = rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)},
wide AS ({_LONG_INNER}),
lng AS (
  SELECT modality, split, kind, 'average' AS target, r2_average AS r2 FROM wide
  UNION ALL SELECT modality, split, kind, 'price' AS target, r2_price AS r2 FROM wide
  UNION ALL SELECT modality, split, kind, 'tax' AS target, r2_tax AS r2 FROM wide),
q AS (SELECT target, modality, count(r2) AS n, quantile_cont(r2, 0.25) AS q1, quantile_cont(r2, 0.5) AS median,
             quantile_cont(r2, 0.75) AS q3 FROM lng GROUP BY target, modality),
q2 AS (SELECT *, q3 - q1 AS iqr FROM q),
wk AS (SELECT l.target, l.modality,
              min(CASE WHEN l.r2 >= q2.q1 - 1.5 * q2.iqr THEN l.r2 END) AS whisker_lo,
              max(CASE WHEN l.r2 <= q2.q3 + 1.5 * q2.iqr THEN l.r2 END) AS whisker_hi,
              CAST(sum(CASE WHEN l.r2 < q2.q1 - 1.5 * q2.iqr OR l.r2 > q2.q3 + 1.5 * q2.iqr THEN 1 ELSE 0 END)
                   AS BIGINT) AS n_outliers
       FROM lng l JOIN q2 ON l.target = q2.target AND l.modality = q2.modality GROUP BY l.target, l.modality),
mx AS (SELECT target, max(median) AS max_median FROM q2 GROUP BY target)
SELECT q2.target, q2.modality, CAST(q2.n AS BIGINT) AS n, q1, median, q3, iqr, whisker_lo, whisker_hi, n_outliers,
       round(median, 2) AS median_label, max_median
FROM q2 JOIN wk ON q2.target = wk.target AND q2.modality = wk.modality JOIN mx ON q2.target = mx.target""",
                   ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "median_label", "max_median"])


@register("agg_box_summary", _BOX_SQL)
def q_box_summary(spark, sf):
    """AGG16: box-plot numbers of R² by (target, modality)."""
    return M.box_summary(_long(spark, sf), "r2")


_CMP_INNER, _ = _metrics_sql(False, ["r2", "pearsonr2"], False, "test")
_CMP_SQL = rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)},
wide AS ({_CMP_INNER})
SELECT modality,
       avg(CASE WHEN r2_price > pearsonr2_price THEN 1.0 ELSE 0.0 END) * 100.0 AS m1_better_m2,
       avg(CASE WHEN pearsonr2_price > r2_price THEN 1.0 ELSE 0.0 END) * 100.0 AS m2_better_m1,
       count(*) AS n_splits,
       avg(pearsonr2_price - r2_price) AS mean_diff,
       stddev_samp(pearsonr2_price - r2_price) AS std_diff
FROM wide GROUP BY modality""", ["m1_better_m2", "m2_better_m1", "mean_diff", "std_diff"])


@register("agg_compare_models", _CMP_SQL)
def q_compare(spark, sf):
    """AGG12: per modality, how often R² beats squared correlation over splits."""
    wide = M.calc_metrics(V.pred(spark, sf), Y, ["r2", "pearsonr2"], kind="test")
    return M.compare_distributions(wide, "r2_price", "pearsonr2_price", ["modality"])


# ---------------------------------------------------------------- counts, first splits, per-group UDF

@register("agg_counts", """
SELECT modality, count(DISTINCT split) AS n_splits, count(DISTINCT subject) AS n_subjects, count(*) AS n_rows
FROM (""" + V.PRED_SQL + """) p GROUP BY modality""")
def q_counts(spark, sf):
    """AGG15: number of splits, subjects and prediction rows per modality."""
    p = V.pred(spark, sf)
    return p.groupBy("modality").agg(F.countDistinct("split").alias("n_splits"),
                                     F.countDistinct("subject").alias("n_subjects"),
                                     F.count(F.lit(1)).alias("n_rows"))


_FIRST_INNER, _ = _metrics_sql(False, ["r2"], False, "test")


@register("win_first_splits", rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)}
SELECT * FROM ({_FIRST_INNER}) w WHERE split < 4""", ["r2_price", "r2_tax"]))
def q_first_splits(spark, sf):
    """WIN9: keep the first n (=4) splits of a metrics table (numeric split order)."""
    wide = M.calc_metrics(V.pred(spark, sf), Y, ["r2"], kind="test")
    return wide.filter(F.col("split") < 4)


@register("udf_apply_per_group", rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)}
SELECT modality, split, r2_price AS value FROM ({_FIRST_INNER}) w""", ["value"]))
def q_udf(spark, sf):
    """UDF1: a pandas closure (R² of price) applied per (modality, split) group."""
    from cohortlens.operators.tidy import apply_per_group

    def r2(pdf):
        y, p = pdf["price"].to_numpy(), pdf["price_pred"].to_numpy()
        ss = ((y - y.mean()) ** 2).sum()
        return float(1.0 - ((y - p) ** 2).sum() / ss) if ss > 0 else 0.0

    d = V.pred(spark, sf).select("modality", "split", "price", "price_pred")
    return apply_per_group(d, ["modality", "split"], r2, "modality string, split int, value double")


_REN_INNER, _ = _metrics_sql(False, ["r2", "mae"], False, "test")


@register("prj_rename_columns", rounded(f"""
WITH pred AS ({V.PRED_SQL}), {_means_cte('pred', Y)}
SELECT modality, split, r2_price AS R2_extprice, r2_tax AS R2_tax, mae_price AS mae_extprice, mae_tax, kind
FROM ({_REN_INNER}) w""", ["R2_extprice", "R2_tax", "mae_extprice", "mae_tax"]))
def q_rename(spark, sf):
    """PRJ9: substring renames applied to every column name, in order ('price'->'extprice', 'r2_'->'R2_')."""
    from cohortlens.operators.tidy import rename_substrings
    wide = M.calc_metrics(V.pred(spark, sf), Y, ["r2", "mae"], kind="test")
    return rename_substrings(wide, {"price": "extprice", "r2_": "R2_"})
