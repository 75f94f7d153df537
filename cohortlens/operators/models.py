"""Model fitting per split: pipelines, forests, grid search, learning curves,
permuted fits and importances.

Linear pipelines ('ridgecv', optionally '+fmripcaN') run every split in one
Spark job (see ``linear``).  Forests use ``pyspark.ml``: one distributed fit
per (split, candidate, fold), a bounded thread pool submits them
concurrently; assembled vectors are cached once per split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import forest as FO
from cohortlens.operators import linear as L
from cohortlens.operators import splits as SP
from cohortlens.operators import tidy as TD
from cohortlens.operators.wide_pca import pca_scores
from cohortlens.session import stored

# fixed values: forest search grid (depth None = unlimited maps to Spark's maximum 30)
FOREST_DEPTHS = [3, 5, 7, 10, 15, 20, 40, 50, None]
FOREST_TREES = 256
MANY_ROWS = 50_000                     # train rows from which regression forests are grown by ``forest``
SPARK_MAX_DEPTH = 30
REGRESSION_CRITERIA = ["mse"]          # "mae" has no Spark equivalent (not built)
CLASSIFIER_CRITERIA = ["gini", "entropy"]
MODEL_TYPES = ("basic", "rfc", "ridgecv")


def parse_model_type(model_type: str) -> tuple[str, int | None]:
    """ML8: 'basic' | 'rfc' | 'ridgecv', each optionally '+fmripca{N}'."""
    base, _, pca = model_type.partition("+fmripca")
    if base not in MODEL_TYPES or (pca and not pca.isdigit()):
        raise NotImplementedError(model_type)
    return base, (int(pca) if pca else None)


def spark_depth(d: int | None) -> int:
    return SPARK_MAX_DEPTH if d is None else min(int(d), SPARK_MAX_DEPTH)


# ---------------------------------------------------------------- preprocessing

WIDE_BLOCK = 2000            # columns up to which the k x k form is always taken


def _is_wide(train: DataFrame, k: int) -> bool:
    """Whether the block has more columns than the largest split has train rows (one number read)."""
    if k <= WIDE_BLOCK:
        return False
    most = train.groupBy("split").count().agg(F.max("count").alias("n")).first()["n"]
    return most is not None and most < k


def _elements(col: str, idx: Sequence[int]):
    """Elements of an array column; a run of neighbours is one slice."""
    cuts = [k for k in range(len(idx)) if k == 0 or idx[k] != idx[k - 1] + 1] + [len(idx)]
    runs = [F.slice(col, idx[a] + 1, b - a) for a, b in zip(cuts, cuts[1:])]
    return F.concat(*runs) if runs else F.array().cast("array<double>")


def prepare(rows: DataFrame, pca_block: Sequence[int] | None = None, n_components: int | None = None,
            feature_names: Sequence[str] = (), imputer: str = "mean") -> tuple[DataFrame, list[str]]:
    """PCA on a column block (ML4), then imputation with missing indicators
    (ML2) fitted on each split's train rows: ``imputer`` 'mean' (the initial
    strategy) or 'iterative' (round-robin Bayesian ridge, as the pipelines use).

    Returns the prepared rows and the model-input feature names:
    ``{p}pca_0..`` first, then the remaining columns, then ``{c}_missing``."""
    names = list(feature_names)
    if pca_block and n_components:
        train = rows.filter("role = 'train'")
        blk = [i for i in pca_block]
        rest = [i for i in range(len(names)) if i not in blk]
        sel = lambda idx: _elements("x", idx)
        # block columns must be gap-free: a NULL in the train part raises
        if _is_wide(train, len(blk)):
            proj = pca_scores(rows.withColumn("__blk", sel(blk)), n_components, "__blk", "__pc")
        else:
            fitted = L.pca_fit(train.withColumn("x", sel(blk)), n_components)
            proj = L.pca_transform(rows.withColumn("__blk", sel(blk)), fitted, "__blk", "__pc")
        rows = proj.withColumn("x", F.concat(F.col("__pc"), sel(rest))).drop("__blk", "__pc")
        names = [f"fmri__pca_{i}" for i in range(n_components)] + [names[i] for i in rest]
    train = rows.filter("role = 'train'")
    ind = L.gap_columns(train)
    indicators = [F.when(F.get(F.col("x"), i).isNull(), F.lit(1.0)).otherwise(F.lit(0.0)) for i in ind]
    if imputer == "iterative":
        rows = rows.withColumn("__ind", F.array(*indicators)) if ind else rows
        rows = L.iterative_impute(rows, len(names))
        if ind:
            rows = rows.withColumn("x", F.concat("x", "__ind")).drop("__ind")
    elif imputer == "mean":
        rows = L.impute_with_indicators(rows, L.column_means(train), ind)
    else:
        raise ValueError(imputer)
    return rows, names + [f"{names[i]}_missing" for i in ind]


# ---------------------------------------------------------------- linear learning (ML13 for ridge)

def learn_ridge(x: DataFrame, features: Sequence[str], y: DataFrame, targets: Sequence[str],
                members: DataFrame, seed: int = 1234, alphas=L.RIDGE_ALPHAS,
                pca_block: Sequence[int] | None = None, n_components: int | None = None,
                imputer: str = "iterative", permuted: bool = False) -> dict:
    """ML7+ML11+ML12+ML13: all splits at once.

    Returns DataFrames ``predictions`` (test), ``predictions_training``,
    ``coefficients`` and, if asked for, ``predictions_permuted`` (fit on
    md5-permuted train targets, evaluated against md5-permuted test targets).
    ``members`` and ``y`` are read several times.
    """
    rows = stored(L.design_rows(x, features, y, targets, members))
    rows, names = prepare(rows, pca_block, n_components, features, imputer=imputer)
    rows = stored(rows)
    train, test = rows.filter("role = 'train'"), rows.filter("role = 'test'")
    coef = L.ridge_cv(train, alphas)
    pred = L.predict_linear(test, coef, len(targets), targets)
    pred_train = L.predict_linear(train, coef, len(targets), targets)
    out = {"predictions": _with_truth(pred, y, targets), "predictions_training": _with_truth(pred_train, y, targets),
           "coefficients": coef, "feature_names": names, "rows": rows}
    if permuted:
        # one md5-ordered shuffle of the targets within train and within test
        perm = stored(SP.permute_within(members, y, list(targets), seed=seed))
        perm_y = perm.select("split", "subject", F.array(*[F.col(t).cast("double") for t in targets]).alias("y"))
        # every member has features and permuted targets (``design_rows`` checks it): the outer align adds no gaps
        rows_p = stored(TD.outer_align(rows.drop("y"), perm_y, ["split", "subject"]))
        coef_p = L.ridge_cv(rows_p.filter("role = 'train'"), alphas)
        pred_p = L.predict_linear(rows_p.filter("role = 'test'"), coef_p, len(targets), targets)
        truth_p = perm.filter("role = 'test'").select("split", "subject", *targets)
        out["predictions_permuted"] = TD.outer_align(pred_p, truth_p, ["split", "subject"])
        out["coefficients_permuted"] = coef_p
    return out


def _with_truth(pred: DataFrame, y: DataFrame, targets: Sequence[str]) -> DataFrame:
    return pred.join(y.select("subject", *targets), "subject", "left")


# ---------------------------------------------------------------- forests (ML5, ML6, ML10, ML16)

def _vectors(rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return rows.withColumn("features", array_to_vector("x"))


def _forest(kind: str, depth: int | None, criterion: str, seed: int, n_trees: int, label: str,
            weight_col: str | None):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor
    common = dict(featuresCol="features", labelCol=label, numTrees=n_trees, maxDepth=spark_depth(depth),
                  featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)
    if weight_col:
        common["weightCol"] = weight_col
    if kind == "rfc":
        return RandomForestClassifier(impurity=criterion, **common)
    if criterion != "mse":
        raise NotImplementedError(f"criterion {criterion}")
    return RandomForestRegressor(impurity="variance", **common)


def fit_forests(train: DataFrame, targets: Sequence[str], kind: str = "basic", depth: int | None = None,
                criterion: str | None = None, seed: int = 1234, n_trees: int = FOREST_TREES,
                weight_col: str | None = None) -> list:
    """ML5/ML6 (+ML10 weights): one forest per target on prepared rows.

    Regression forests on ``MANY_ROWS`` or more are grown by ``forest.fit``, all others by
    ``pyspark.ml``: there, every partition sends the bin statistics of all open nodes in each level,
    however few rows it has, so there are no more partitions than cores; rows keep the node they have reached."""
    criterion = criterion or ("gini" if kind == "rfc" else "mse")
    if kind != "rfc" and (n := train.count()) >= MANY_ROWS:
        return FO.fit(train, n, len(targets), [_forest(kind, depth, criterion, seed, n_trees, f"__y{i}", weight_col)
                                               for i in range(len(targets))], weight_col)
    data = _vectors(train)
    data = data.select("features", *([weight_col] if weight_col else []),
                       *[F.get(F.col("y"), i).alias(f"__y{i}") for i in range(len(targets))])
    data = data.coalesce(max(1, train.sparkSession.sparkContext.defaultParallelism))
    return [_forest(kind, depth, criterion, seed, n_trees, f"__y{i}", weight_col).fit(data)
            for i in range(len(targets))]


def predict_forests(models: list, rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """ML11 for forests: ``{t}_pred`` columns, one chained transform per target (forests of ``forest.fit``: one pass for all)."""
    if all(hasattr(m, "walks") for m in models):
        return FO.predict(models, rows, targets)
    data = _vectors(rows)
    for m, t in zip(models, targets):
        data = m.setPredictionCol(f"{t}_pred").transform(data)
    return data.drop("features", "x", "y")


def feature_importances(models: list, names: Sequence[str], spark, split: int) -> DataFrame:
    """ML16: (split, target index, feature, importance) from fitted forests."""
    rows = []
    for ti, m in enumerate(models):
        imp = m.featureImportances.toArray()
        rows += [(split, ti, names[i], float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "split int, target int, feature string, fi double")


def r2_uniform(pred: DataFrame, targets: Sequence[str]) -> float | None:
    """Mean over targets of R² (the search score), one aggregate."""
    aggs = []
    for t in targets:
        y, p = F.col(t), F.col(f"{t}_pred")
        aggs += [F.sum((y - p) * (y - p)).alias(f"r_{t}"), (F.var_pop(y) * F.count(y)).alias(f"s_{t}")]
    row = pred.agg(*aggs).first()
    vals = []
    for t in targets:
        r, s = row[f"r_{t}"], row[f"s_{t}"]
        if r is None or s is None:
            return None
        vals.append(1.0 if s == 0 and r == 0 else (0.0 if s == 0 else 1.0 - r / s))
    return sum(vals) / len(vals)


def grid_search(train: DataFrame, targets: Sequence[str], kind: str = "basic", seed: int = 1234,
                depths: Sequence[int | None] = FOREST_DEPTHS, criteria: Sequence[str] | None = None,
                n_folds: int = 5, n_trees: int = FOREST_TREES, weight_col: str | None = None,
                parallelism: int = 4) -> tuple[dict, list[dict]]:
    """ML9: exhaustive search over criteria × depths with contiguous k folds
    (WIN10) of the split's train rows, for classifiers within each class of the
    first target; score = mean R² over targets.

    Returns (best params, one result dict per candidate with mean train and
    validation scores)."""
    criteria = list(criteria or (CLASSIFIER_CRITERIA if kind == "rfc" else REGRESSION_CRITERIA))
    if kind == "rfc":
        by_class = train.withColumn("__class", F.get("y", 0))
        folds = stored(SP.kfold(by_class, n_folds, group=["split", "__class"]).drop("__class"))
    else:
        folds = stored(SP.kfold(train, n_folds, group=["split"]))
    cands = [{"criterion": c, "max_depth": d, "n_estimators": n_trees, "max_features": "sqrt"}
             for c in criteria for d in depths]

    def run(cand):
        tr_s, va_s = [], []
        for f in range(n_folds):
            tr = folds.filter(F.col("fold") != f)
            va = folds.filter(F.col("fold") == f)
            ms = fit_forests(tr, targets, kind, cand["max_depth"], cand["criterion"], seed, n_trees, weight_col)
            truth = lambda d: d.select("*", *[F.get(F.col("y"), i).alias(t) for i, t in enumerate(targets)])  # noqa
            tr_s.append(r2_uniform(predict_forests(ms, truth(tr), targets), targets))
            va_s.append(r2_uniform(predict_forests(ms, truth(va), targets), targets))
        mean = lambda v: (sum(x for x in v if x is not None) / max(1, sum(x is not None for x in v)))  # noqa
        return {"params": cand, "mean_train_score_gs": mean(tr_s), "mean_test_score_gs": mean(va_s)}

    # candidates that map to the same Spark model (depths above 30) are fitted once
    uniq = {}
    for cand in cands:
        uniq.setdefault((cand["criterion"], spark_depth(cand["max_depth"])), cand)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        done = dict(zip(uniq, ex.map(run, uniq.values())))
    results = []
    for cand in cands:
        r = done[(cand["criterion"], spark_depth(cand["max_depth"]))]
        results.append({"params": cand, "mean_train_score_gs": r["mean_train_score_gs"],
                        "mean_test_score_gs": r["mean_test_score_gs"]})
    best = max(results, key=lambda r: (r["mean_test_score_gs"] if r["mean_test_score_gs"] is not None
                                       else -math.inf))
    return best["params"], results


# ---------------------------------------------------------------- learning curve (ML14)

# fixed values: train-size fractions of the learning curve
TRAIN_SIZES = [0.2, 0.4, 0.6, 0.8, 1.0]


def learning_curve_members(subjects: DataFrame, n_folds: int = 5, sizes: Sequence[float] = TRAIN_SIZES,
                           key: str = "subject") -> DataFrame:
    """ML14 membership: for each (size, fold) a synthetic split id; train = the
    first int(size·n_train) subjects (subject order) of the fold's train part,
    test = the fold.  Returns (split, size_idx, fold, subject, role).

    One k-fold assignment and one explode over the size × fold grid: folds are
    contiguous in subject order, so a row's rank in a fold's train part is its
    position less the fold, if that lies before it."""
    base = subjects.select(key).withColumn("split", F.lit(0))
    folded = SP.kfold(base, n_folds, key=key, group=["split"], place="__p", total="__n").withColumnRenamed("fold", "__own")
    grid = F.array(*[F.struct(F.lit(si).alias("size_idx"), F.lit(f).alias("fold"), F.lit(float(fr)).alias("frac"))
                     for si, fr in enumerate(sizes) for f in range(n_folds)])
    g = folded.withColumn("__g", F.explode(grid)).select(
        key, "__own", "__p", "__n", "__g.size_idx", "__g.fold", "__g.frac")
    g = g.withColumn("split", (F.col("size_idx") * n_folds + F.col("fold")).cast("int"))
    test = g.filter(F.col("__own") == F.col("fold")).withColumn("role", F.lit("test"))
    size = lambda fold: F.floor(F.col("__n") / n_folds) + F.when(fold < F.col("__n") % n_folds, 1).otherwise(0)
    rank = F.col("__p") + 1 - F.when(F.col("__own") > F.col("fold"), size(F.col("fold"))).otherwise(0)
    # sizes are fractions of the first fold's training rows, the same for all folds
    wanted = F.floor((F.col("__n") - size(F.lit(0))) * F.col("frac"))
    tr = g.filter((F.col("__own") != F.col("fold")) & (rank <= wanted)).withColumn("role", F.lit("train"))
    cols = ["split", "size_idx", "fold", key, "role"]
    return tr.select(*cols).unionByName(test.select(*cols))
