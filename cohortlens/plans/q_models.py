"""Queries: imputation, scaling, ridge, PCA, forests, search, learning curve,
permutation importance — on customer features (learn_x) and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import linear as L
from cohortlens.operators import metrics as M
from cohortlens.operators import models as ML
from cohortlens.operators import signal as S
from cohortlens.operators import splits as SP
from cohortlens.operators.wide_pca import pca_scores
from cohortlens.plans import learning as LR
from cohortlens.plans.q_splits import N_SPLITS, SEED, T, _SPLIT_CTES
from cohortlens.plans.registry import register, rounded
from cohortlens.session import stored
from cohortlens.sources import tables as V
from cohortlens.sources.tables import LEARN_FEATURES, with_views

FX = LEARN_FEATURES
GAPS = [f for f in FX if f.startswith("price_")]


def _members(spark, sf, n_splits=N_SPLITS):
    return SP.stratified_shuffle_splits(SP.stratify(V.targets(spark, sf), T), n_splits, seed=SEED)


def _rows(spark, sf, features=FX, targets=T, n_splits=N_SPLITS):
    return L.design_rows(V.learn_x(spark, sf), features, V.targets(spark, sf), targets,
                         _members(spark, sf, n_splits))


_D = f"""WITH {_SPLIT_CTES},
__d AS (SELECT sp.split, sp.subject, sp.role, x.price_F, x.price_O, x.price_P, x.n_F, x.n_O, x.n_P,
               t.acctbal, t.total_price
        FROM __sp sp JOIN learn_x x ON sp.subject = x.subject JOIN targets t ON sp.subject = t.subject),
__m AS (SELECT split, {", ".join(f"avg({c}) AS m_{c}" for c in FX)} FROM __d WHERE role = 'train' GROUP BY split)"""


# ---------------------------------------------------------------- ML2, ML3

_IMP_SQL = rounded(with_views(_D + "\n" + "\nUNION ALL ".join(
    [f"SELECT d.split, d.subject, '{c}' AS feature, coalesce(d.{c}, m.m_{c}) AS value "
     f"FROM __d d JOIN __m m ON d.split = m.split" for c in FX]
    + [f"SELECT d.split, d.subject, '{c}_missing' AS feature, CASE WHEN d.{c} IS NULL THEN 1.0 ELSE 0.0 END AS value "
       f"FROM __d d" for c in GAPS]), "learn_x", "targets"), ["value"])


@register("ml_impute_indicators", _IMP_SQL)
def q_impute(spark, sf):
    """ML2: per split train-mean imputation plus missing indicators (long form)."""
    rows, names = ML.prepare(_rows(spark, sf), feature_names=FX)
    nm = F.array(*[F.lit(n) for n in names])
    return rows.select("split", "subject", F.posexplode("x").alias("j", "value")).select(
        "split", "subject", F.element_at(nm, F.col("j") + 1).alias("feature"), "value")


_SCALE_SQL = rounded(with_views(_D + "\n" + "\nUNION ALL ".join(
    f"SELECT d.split, '{c}' AS feature, max(m.m_{c}) AS mean, "
    f"sqrt(avg((coalesce(d.{c}, m.m_{c}) - m.m_{c}) * (coalesce(d.{c}, m.m_{c}) - m.m_{c}))) AS sd "
    f"FROM __d d JOIN __m m ON d.split = m.split WHERE d.role = 'train' GROUP BY d.split" for c in FX)
    + "".join(f"\nUNION ALL SELECT split, '{c}_missing' AS feature, avg(CAST({c} IS NULL AS INTEGER)) AS mean, "
              f"stddev_pop(CAST({c} IS NULL AS INTEGER)) AS sd FROM __d WHERE role = 'train' GROUP BY split" for c in GAPS),
    "learn_x", "targets"), ["mean", "sd"])


@register("ml_standard_scale", _SCALE_SQL)
def q_scale(spark, sf):
    """ML3: per split train mean and population sd of every (imputed) feature and indicator."""
    rows, names = ML.prepare(_rows(spark, sf), feature_names=FX)
    mo = L.moments(rows.filter("role = 'train'"))
    k = len(names)
    nm = F.array(*[F.lit(n) for n in names])
    ex = mo.select("split", "n", "cxx", F.posexplode("mx").alias("j", "mean"))
    return ex.select(
        "split", F.element_at(nm, F.col("j") + 1).alias("feature"), "mean",
        F.sqrt(F.get(F.col("cxx"), F.col("j") * (k + 1)) / F.col("n")).alias("sd"))


# ---------------------------------------------------------------- ML7 / ML11 with one feature and one alpha

_ONE_SQL = rounded(with_views(f"""WITH {_SPLIT_CTES},
__d AS (SELECT sp.split, sp.subject, sp.role, x.n_O AS x, t.total_price AS y
        FROM __sp sp JOIN learn_x x ON sp.subject = x.subject JOIN targets t ON sp.subject = t.subject),
__st AS (SELECT split, avg(x) AS mx, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END AS sx, avg(y) AS my
         FROM __d WHERE role = 'train' GROUP BY split),
__st2 AS (SELECT d.split, sum(((d.x - s.mx) / s.sx) * (d.y - s.my)) AS sxy,
                 sum(((d.x - s.mx) / s.sx) * ((d.x - s.mx) / s.sx)) AS sxx
          FROM __d d JOIN __st s ON d.split = s.split WHERE d.role = 'train' GROUP BY d.split)
SELECT d.split, d.subject, s.my + (s2.sxy / (s2.sxx + 1.0)) * (d.x - s.mx) / s.sx AS total_price_pred
FROM __d d JOIN __st s ON d.split = s.split JOIN __st2 s2 ON d.split = s2.split WHERE d.role = 'test'""",
                              "learn_x", "targets"), ["total_price_pred"])


@register("ml_ridge_one_feature", _ONE_SQL)
def q_ridge_one(spark, sf):
    """ML3+ML7+ML11: standardised one-feature ridge (alpha 1) per split, test predictions."""
    rows = stored(_rows(spark, sf, ["n_O"], ["total_price"]))
    coef = L.ridge_cv(rows.filter("role = 'train'"), [1.0])
    pred = L.predict_linear(rows.filter("role = 'test'"), coef, 1, ["total_price"])
    return pred.select("split", "subject", "total_price_pred")


# ---------------------------------------------------------------- full ridge pipeline (rows-only)

@register("ml_ridge_cv")
def q_ridge_cv(spark, sf):
    """ML7: chosen alpha and coefficients per split (100 alphas, exact LOO)."""
    rows, names = ML.prepare(_rows(spark, sf), feature_names=FX, imputer="iterative")
    coef = L.ridge_cv(rows.filter("role = 'train'"))
    return coef.select("split", "alpha", F.posexplode("w").alias("j", "w"))


@register("ml_learn_ridge")
def q_learn_ridge(spark, sf):
    """ML13: impute -> scale -> ridge for every split in one job; test predictions with truth."""
    res = LR.learn_customers(spark, sf, "ridgecv")
    return res["predictions"]


@register("ml_permuted_ridge")
def q_permuted(spark, sf):
    """ML12: predictions of models fitted on permuted targets, against permuted truth."""
    res = LR.learn_customers(spark, sf, "ridgecv", permuted=True)
    return res["predictions_permuted"]


@register("ml_evaluate_ridge")
def q_evaluate(spark, sf):
    """End to end: ridge per split -> R², MAE, r² per split -> long -> box summary."""
    res = LR.learn_customers(spark, sf, "ridgecv")
    pred = res["predictions"].withColumn("modality", F.lit("orders"))
    wide = M.calc_metrics(pred, T, ["r2", "pearsonr2", "mae"], kind="test", return_average=True)
    return M.box_summary(M.metrics_to_long(wide, "r2", T, includes_average=True), "r2")


@register("ml_iterative_impute")
def q_iterative_impute(spark, sf):
    """ML2: round-robin Bayesian-ridge imputation per split (fit on train rows), long form."""
    rows, names = ML.prepare(_rows(spark, sf), feature_names=FX, imputer="iterative")
    nm = F.array(*[F.lit(n) for n in names])
    return rows.select("split", "subject", F.posexplode("x").alias("j", "value")).select(
        "split", "subject", F.element_at(nm, F.col("j") + 1).alias("feature"), "value")


@register("ml_pca")
def q_pca(spark, sf):
    """ML4: scale + PCA(2) of the price block per split; the rest passes through."""
    rows, names = ML.prepare(_rows(spark, sf), pca_block=[FX.index("n_F"), FX.index("n_O"), FX.index("n_P")],
                             n_components=2, feature_names=FX)
    nm = F.array(*[F.lit(n) for n in names])
    return rows.select("split", "subject", F.posexplode("x").alias("j", "value")).select(
        "split", "subject", F.element_at(nm, F.col("j") + 1).alias("feature"), "value")


@register("ml_pca_wide")
def q_pca_wide(spark, sf):
    """ML4 on a block wider than its rows: PCA(3) of all connectivity edges, rows = (subject, run), two
    splits that train on one run each."""
    edges = S.correlation_edges_gram(V.signal(spark, sf), ["subject", "run"])
    cells = F.sort_array(F.collect_list(F.struct("i", "j", F.coalesce("r", F.lit(0.0)).alias("r"))))
    rows = edges.groupBy("subject", "run").agg(cells.getField("r").alias("x"))
    rows = stored(rows.select(F.concat_ws("_", "subject", "run").alias("subject"), "run", "x"))
    rows = rows.withColumn("split", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("role", F.when(F.col("run") == F.col("split"), "train").otherwise("test"))
    out = pca_scores(rows, 3, column_block=512)
    return out.select("split", "subject", "role", F.posexplode("pc").alias("component", "value"))


@register("ml_learning_curve")
def q_learning_curve(spark, sf):
    """ML14+SET5+RSH3: ridge learning curve, 5 sizes x 5 folds in one job, long scores."""
    return LR.learning_curve(V.learn_x(spark, sf), FX, V.targets(spark, sf), T)


@register("ml_permutation_importance")
def q_perm_importance(spark, sf):
    """ML15: mean R² drop over 5 md5-ordered shuffles of each pipeline input on test rows."""
    return LR.permutation_importance(V.learn_x(spark, sf), FX, V.targets(spark, sf), T, stored(_members(spark, sf)),
                                     LR.ridge_fit_predict(T))


_CURVE_ONE_SQL = rounded(with_views("""WITH __t AS (
  SELECT t.subject, x.n_O AS x, t.total_price AS y, row_number() OVER (ORDER BY t.subject) - 1 AS p, count(*) OVER () AS n
  FROM targets t JOIN learn_x x ON t.subject = x.subject),
__f AS (SELECT *, CASE WHEN p < (n % 5) * (n // 5 + 1) THEN p // (n // 5 + 1)
                       ELSE (n % 5) + (p - (n % 5) * (n // 5 + 1)) // (n // 5) END AS own FROM __t),
__n0 AS (SELECT count(*) AS n0 FROM __f WHERE own <> 0),
__g AS (SELECT s.frac, f.fold FROM (SELECT unnest([0.2, 0.4, 0.6, 0.8, 1.0]) AS frac) s,
                                   (SELECT unnest(generate_series(0, 4)) AS fold) f),
__r AS (SELECT g.frac, g.fold, f.x, f.y, f.own = g.fold AS held,
               row_number() OVER (PARTITION BY g.frac, g.fold, f.own = g.fold ORDER BY f.subject) AS rk FROM __g g, __f f),
__d AS (SELECT r.*, CASE WHEN held THEN 'validation' ELSE 'train' END AS kind FROM __r r, __n0
        WHERE held OR rk <= floor(CAST(n0 AS DOUBLE) * CAST(frac AS DOUBLE))),
__st AS (SELECT frac, fold, count(*) AS train_size, avg(x) AS mx, avg(y) AS my,
                CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END AS sx
         FROM __d WHERE kind = 'train' GROUP BY frac, fold),
__w AS (SELECT d.frac, d.fold, sum((d.x - s.mx) / s.sx * (d.y - s.my)) / (sum((d.x - s.mx) / s.sx * ((d.x - s.mx) / s.sx)) + 1.0) AS w
        FROM __d d JOIN __st s ON d.frac = s.frac AND d.fold = s.fold WHERE d.kind = 'train' GROUP BY d.frac, d.fold)
SELECT 'orders' AS modality, s.train_size, d.kind, CAST(d.fold AS VARCHAR) AS cv_split,
       1.0 - sum((d.y - s.my - w.w * (d.x - s.mx) / s.sx) * (d.y - s.my - w.w * (d.x - s.mx) / s.sx))
             / (var_pop(d.y) * count(*)) AS score
FROM __d d JOIN __st s ON d.frac = s.frac AND d.fold = s.fold JOIN __w w ON d.frac = w.frac AND d.fold = w.fold
GROUP BY s.train_size, d.kind, d.fold, d.frac""", "learn_x", "targets"), ["score"])


@register("ml_learning_curve_one_feature", _CURVE_ONE_SQL)
def q_learning_curve_one(spark, sf):
    """ML14+SET5 checkable in SQL: one-feature ridge (alpha 1), 5 sizes x 5 folds, train and validation scores."""
    return LR.learning_curve(V.learn_x(spark, sf), ["n_O"], V.targets(spark, sf), ["total_price"], alphas=[1.0])


_IMPORTANCE_ONE_SQL = rounded(with_views(f"""WITH {_SPLIT_CTES},
__d AS (SELECT sp.split, sp.subject, sp.role, x.n_O AS x, t.total_price AS y
        FROM __sp sp JOIN learn_x x ON sp.subject = x.subject JOIN targets t ON sp.subject = t.subject),
__st AS (SELECT split, avg(x) AS mx, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END AS sx, avg(y) AS my
         FROM __d WHERE role = 'train' GROUP BY split),
__w AS (SELECT d.split, sum((d.x - s.mx) / s.sx * (d.y - s.my)) / (sum((d.x - s.mx) / s.sx * ((d.x - s.mx) / s.sx)) + 1.0) AS w
        FROM __d d JOIN __st s ON d.split = s.split WHERE d.role = 'train' GROUP BY d.split),
__te AS (SELECT d.*, CAST(r.r AS INTEGER) AS r FROM __d d, (SELECT unnest(generate_series(-1, 4)) AS r) r WHERE d.role = 'test'),
__ll AS (SELECT *, row_number() OVER (PARTITION BY split, r ORDER BY subject) AS rk FROM __te),
__rr AS (SELECT split, r, x AS xp, row_number() OVER (PARTITION BY split, r ORDER BY
           CASE WHEN r < 0 THEN subject
                ELSE md5('{SEED}:' || CAST(split AS VARCHAR) || ':0:' || CAST(r AS VARCHAR) || ':' || subject) END, subject) AS rk
         FROM __te),
__sc AS (SELECT l.split, l.r, 1.0 - sum((l.y - s.my - w.w * (q.xp - s.mx) / s.sx) * (l.y - s.my - w.w * (q.xp - s.mx) / s.sx))
                                    / (var_pop(l.y) * count(*)) AS score
         FROM __ll l JOIN __rr q ON l.split = q.split AND l.r = q.r AND l.rk = q.rk
              JOIN __st s ON l.split = s.split JOIN __w w ON l.split = w.split GROUP BY l.split, l.r)
SELECT 'orders' AS modality, split, 'n_O' AS feature,
       avg(score) FILTER (WHERE r < 0) - avg(score) FILTER (WHERE r >= 0) AS permutation_importance
FROM __sc GROUP BY split""", "learn_x", "targets"), ["permutation_importance"])


@register("ml_importance_one_feature", _IMPORTANCE_ONE_SQL)
def q_importance_one(spark, sf):
    """ML15 checkable in SQL: one-feature ridge (alpha 1), R² drop over 5 md5-ordered shuffles."""
    return LR.permutation_importance(V.learn_x(spark, sf), ["n_O"], V.targets(spark, sf), ["total_price"],
                                     stored(_members(spark, sf)), LR.ridge_fit_predict(["total_price"], [1.0]))


# ---------------------------------------------------------------- forests (rows-only)

@register("ml_forest_regress")
def q_forest(spark, sf):
    """ML5+ML10+ML11: weighted random forests (256 trees) per split, test predictions."""
    return LR.learn_customers(spark, sf, "basic", n_splits=2, weights=True, depth=LR.FOREST_DEPTH)["predictions"]


@register("ml_feature_importances")
def q_importances(spark, sf):
    """ML16: forest feature importances per split and target."""
    return LR.learn_customers(spark, sf, "basic", n_splits=2, depth=LR.FOREST_DEPTH)["importances"]


@register("ml_forest_classify")
def q_forest_cls(spark, sf):
    """ML6: random-forest classifier (gini) per split on document labels."""
    return LR.classify_documents(spark, sf)


@register("ml_grid_search")
def q_grid(spark, sf):
    """ML9+RSH5: depth search with 5 contiguous folds on one stratified split."""
    return LR.grid_search_table(spark, sf)



@register("snk_coefficients_roundtrip")
def q_coefficients_roundtrip(spark, sf):
    """SNK6+SRC13: ridge coefficients stored per (model, modality, split, feature), loaded for the first 3 splits."""
    import uuid

    from cohortlens.session import scratch_path
    from cohortlens.sources import files as SRC
    from cohortlens.sources import sinks as SNK
    rows, names = ML.prepare(_rows(spark, sf), feature_names=FX)
    coef = L.ridge_cv(rows.filter("role = 'train'"))
    nm = F.array(*[F.lit(n) for n in names])
    long = coef.select("split", F.posexplode("w").alias("idx", "fi")).select(
        F.lit("ridgecv").alias("model"), F.lit("orders").alias("modality"), "split",
        F.element_at(nm, (F.floor(F.col("idx") / len(T)) + 1).cast("int")).alias("feature_name"),
        (F.col("idx") % len(T)).cast("int").alias("target"), "fi")
    out = scratch_path(spark, f"coefficients-{uuid.uuid4().hex[:12]}")
    SNK.write_coefficients(long, out)
    return SRC.load_feature_importances(spark, out, n_splits=3).select(
        "model", "modality", "split", "feature_name", "target", "fi")


_PERM_ONE_SQL = rounded(with_views(f"""WITH {_SPLIT_CTES},
__m0 AS (SELECT sp.split, sp.role, sp.subject, t.total_price FROM __sp sp JOIN targets t ON sp.subject = t.subject),
__ll AS (SELECT split, role, subject, row_number() OVER (PARTITION BY split, role ORDER BY subject) AS rk FROM __m0),
__rr AS (SELECT split, role, total_price, row_number() OVER (
          PARTITION BY split, role ORDER BY md5('{SEED}:' || CAST(split AS VARCHAR) || ':' || role || ':' || subject),
                                             subject) AS rk FROM __m0),
__py AS (SELECT l.split, l.role, l.subject, r.total_price AS y FROM __ll l JOIN __rr r
           ON l.split = r.split AND l.role = r.role AND l.rk = r.rk),
__d AS (SELECT p.split, p.subject, p.role, x.n_O AS x, p.y FROM __py p JOIN learn_x x ON p.subject = x.subject),
__st AS (SELECT split, avg(x) AS mx, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END AS sx, avg(y) AS my
         FROM __d WHERE role = 'train' GROUP BY split),
__st2 AS (SELECT d.split, sum(((d.x - s.mx) / s.sx) * (d.y - s.my)) AS sxy,
                 sum(((d.x - s.mx) / s.sx) * ((d.x - s.mx) / s.sx)) AS sxx
          FROM __d d JOIN __st s ON d.split = s.split WHERE d.role = 'train' GROUP BY d.split)
SELECT d.split, d.subject, s.my + (s2.sxy / (s2.sxx + 1.0)) * (d.x - s.mx) / s.sx AS total_price_pred,
       d.y AS total_price
FROM __d d JOIN __st s ON d.split = s.split JOIN __st2 s2 ON d.split = s2.split WHERE d.role = 'test'""",
                                   "learn_x", "targets"), ["total_price_pred", "total_price"])


@register("ml_permuted_one_feature", _PERM_ONE_SQL)
def q_permuted_one(spark, sf):
    """ML12 checkable in SQL: one-feature ridge (alpha 1) fitted on md5-permuted train targets,
    predictions on test rows against the permuted test targets."""
    members = stored(_members(spark, sf))
    perm = SP.permute_within(members, V.targets(spark, sf), ["total_price"], seed=SEED)
    py = perm.select("split", "subject", "role", F.array(F.col("total_price").cast("double")).alias("y"))
    xa = V.learn_x(spark, sf).select("subject", F.array(F.col("n_O").cast("double")).alias("x"))
    rows = stored(py.join(xa, "subject"))
    coef = L.ridge_cv(rows.filter("role = 'train'"), [1.0])
    pred = L.predict_linear(rows.filter("role = 'test'"), coef, 1, ["total_price"])
    truth = perm.filter("role = 'test'").select("split", "subject", "total_price")
    return pred.join(truth, ["split", "subject"]).select("split", "subject", "total_price_pred", "total_price")


#: Two features, three penalties: the leave-one-out errors have a closed form.
_ALPHAS = (0.1, 10.0, 1000.0)
_STORE_SQL = with_views(f"""WITH {_SPLIT_CTES},
__m0 AS (SELECT sp.split, sp.role, sp.subject, t.total_price FROM __sp sp JOIN targets t ON sp.subject = t.subject),
__ll AS (SELECT split, role, subject, row_number() OVER (PARTITION BY split, role ORDER BY subject) AS rk FROM __m0),
__rr AS (SELECT split, role, total_price, row_number() OVER (
          PARTITION BY split, role ORDER BY md5('{SEED}:' || CAST(split AS VARCHAR) || ':' || role || ':' || subject),
                                             subject) AS rk FROM __m0),
__y AS (SELECT 'test' AS kind, split, role, subject, total_price AS y FROM __m0
        UNION ALL SELECT 'permuted', l.split, l.role, l.subject, r.total_price FROM __ll l JOIN __rr r
           ON l.split = r.split AND l.role = r.role AND l.rk = r.rk),
__d AS (SELECT y.kind, y.split, y.role, y.subject, CAST(x.n_O AS DOUBLE) AS a, CAST(x.n_F AS DOUBLE) AS b, y.y
        FROM __y y JOIN learn_x x ON y.subject = x.subject),
__st AS (SELECT kind, split, count(*) AS n, avg(a) AS ma, CASE WHEN stddev_pop(a) > 0 THEN stddev_pop(a) ELSE 1.0 END AS sa,
                avg(b) AS mb, CASE WHEN stddev_pop(b) > 0 THEN stddev_pop(b) ELSE 1.0 END AS sb, avg(y) AS my
         FROM __d WHERE role = 'train' GROUP BY kind, split),
__z AS (SELECT d.kind, d.split, d.role, d.subject, n, (a - ma) / sa AS u, (b - mb) / sb AS v, d.y - my AS e, my, d.y
        FROM __d d JOIN __st s ON d.kind = s.kind AND d.split = s.split),
__sq AS (SELECT kind, split, sum(u * u) AS uu, sum(u * v) AS uv, sum(v * v) AS vv, sum(u * e) AS ue, sum(v * e) AS ve
        FROM __z WHERE role = 'train' GROUP BY kind, split),
__a AS (SELECT *, (uu + alpha) * (vv + alpha) - uv * uv AS det FROM __sq, (SELECT unnest([{", ".join(map(str, _ALPHAS))}]) AS alpha) q),
__w AS (SELECT *, ((vv + alpha) * ue - uv * ve) / det AS wu, ((uu + alpha) * ve - uv * ue) / det AS wv FROM __a),
__loo AS (SELECT w.kind, w.split, w.alpha, sum(power((z.e - wu * z.u - wv * z.v) / (1 - 1.0 / z.n
                 - (z.u * z.u * (vv + w.alpha) - 2 * z.u * z.v * uv + z.v * z.v * (uu + w.alpha)) / det), 2)) AS sse
          FROM __w w JOIN __z z ON w.kind = z.kind AND w.split = z.split WHERE z.role = 'train' GROUP BY w.kind, w.split, w.alpha),
__best AS (SELECT kind, split, alpha FROM __loo QUALIFY row_number() OVER (PARTITION BY kind, split ORDER BY sse, alpha) = 1)
SELECT z.kind, z.split, z.subject, w.alpha, round(z.my + w.wu * z.u + w.wv * z.v, 3) AS total_price_pred,
       round(CAST(z.y AS DOUBLE), 3) AS total_price
FROM __z z JOIN __best b ON z.kind = b.kind AND z.split = b.split
     JOIN __w w ON w.kind = b.kind AND w.split = b.split AND w.alpha = b.alpha
WHERE z.role = 'test'""", "learn_x", "targets")


@register("ml_learn_ridge_store", _STORE_SQL)
def q_learn_ridge_store(spark, sf):
    """ML7+ML12+ML13+SNK4+SNK6+SRC10: ``learn`` with a choice of three penalties by leave-one-out error, stored, and the
    predictions of the fits on true and permuted targets read back by kind, with the penalty of the true fit or
    that of the permuted one."""
    import os
    import uuid

    from cohortlens.session import scratch_path
    from cohortlens.sources import files as SRC
    out = scratch_path(spark, f"study-{uuid.uuid4().hex[:12]}")
    LR.learn(V.learn_x(spark, sf), ["n_O", "n_F"], V.targets(spark, sf).select("subject", "acctbal", "total_price"), ["total_price"],
             modality="orders", permuted=True, out_path=out, alphas=_ALPHAS, strata=T)
    both = [SRC.load_predictions(spark, os.path.join(out, "predictions"), "ridgecv", ["orders"], permuted=p) for p in (False, True)]
    coef = spark.read.parquet(os.path.join(out, "coefficients")).select("kind", "split", "alpha")
    return both[0].unionByName(both[1]).join(coef, ["kind", "split"]).select(
        "kind", "split", "subject", "alpha", F.round("total_price_pred", 3).alias("total_price_pred"),
        F.round(F.col("total_price").cast("double"), 3).alias("total_price"))


@register("ml_forest_permutation_importance")
def q_forest_perm_importance(spark, sf):
    """ML15 on forests: R² drop per feature over 5 md5-ordered shuffles of the test rows (one split)."""
    return LR.permutation_importance(V.learn_x(spark, sf), FX, V.targets(spark, sf), T, stored(_members(spark, sf, 1)),
                                     LR.forest_fit_predict(T, 1, LR.FOREST_DEPTH))
