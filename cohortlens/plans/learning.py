"""Learning jobs (ML13, ML14, ML15, ML6/ML9 drivers).

``learn``, ``learning_curve`` and ``permutation_importance`` take any subject
tables; ``learn_customers`` and the jobs at the end apply them to the recast tables.
Linear models run all splits in one job; forests submit one pyspark.ml fit
per split through a bounded thread pool.
"""

from __future__ import annotations

import os
import time
import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import checks as C
from cohortlens.operators import density as D
from cohortlens.operators import linear as L
from cohortlens.operators import models as ML
from cohortlens.operators import splits as SP
from cohortlens.operators import tidy as TD
from cohortlens.session import stored, stored_table
from cohortlens.sources import sinks as SNK
from cohortlens.sources import tables as V
from cohortlens.sources.tables import LEARN_FEATURES

T = ["acctbal", "total_price"]
SEED = 1234
N_SPLITS = 5
# forest settings of the registered queries: depth 10 is a candidate of the
# reference grid; deeper Spark trees cost ~10x more per fit (see README)
FOREST_DEPTH = 10
SEARCH_DEPTHS = [3, 5, 7, 10]
SEARCH_TREES = 64


def prepare_x_y(x: DataFrame, features: Sequence[str], y: DataFrame, modality: str = "",
                allowed_missing: Sequence[str] | None = None) -> DataFrame:
    """V7, recoding and V1: X and y must hold the same subjects once each; in
    modalities with assessments sex and diagnosis become numbers; gaps are an
    error outside ``allowed_missing`` (None: no column is checked)."""
    C.assert_none(C.duplicate_keys(x, ["subject"]), "subjects occur more than once in X")
    C.assert_none(C.unaligned_keys(x, y), "X and y hold different subjects")
    x = x.select("subject", *features)
    if "clinical" in modality:
        for c, recode in (("clin__risk__demo_sex", TD.recode_sex), ("clin__assess__diag", TD.recode_diagnosis)):
            x = recode(x, c) if c in features else x
    if allowed_missing is not None:
        C.check_missings(x, allowed_missing)
    return x


class SplitsFailed(RuntimeError):
    """Some splits of a learning run could not be fitted."""


def learn(x: DataFrame, features: Sequence[str], y: DataFrame, targets: Sequence[str], model_type: str = "ridgecv",
          n_splits: int = N_SPLITS, seed: int = SEED, modality: str = "", allowed_missing: Sequence[str] | None = None,
          pca_features: Sequence[str] = (), weights: bool | DataFrame = False, permuted: bool = False,
          search: dict | None = None, depth: int | None = None, n_trees: int = ML.FOREST_TREES, parallelism: int = 4,
          out_path: str | None = None, alphas: Sequence[float] = L.RIDGE_ALPHAS,
          strata: Sequence[str] | None = None, report_failures: bool | None = None) -> dict:
    """ML13: check X and y, stratify, split, prepare, fit, predict test / train / permuted.

    ``strata``: the columns of y that splits are stratified by, the targets if not given.
    ``weights``: True (kernel density of the targets) or a table (subject,
    weight), left-aligned to the subjects.  ``search``: options of
    ``models.grid_search``; each split's forests are searched on its own train
    rows and fitted again with the best candidate.  Without it forests take
    ``depth``.  With ``out_path`` all results are written below it, with the
    split members, the input tables and the models.  A forest split is written
    as soon as it is done, each output to a folder of that split alone and then a
    completion mark; only splits with a mark are read, and they are skipped by a
    later run, so a run that loses executors or the driver resumes.  A split whose
    fit fails lets the others go on, then raises ``SplitsFailed``: results without it
    would look like whole ones.  Only with ``report_failures`` (None: with ``out_path``,
    where a later run fits what is missing) it is a row of ``failures`` and a warning
    instead; if all fail the first error is raised.  An error while a split is written is
    raised after the other splits have ended: the store may be incomplete.  Ridge predictions
    (test, train and permuted, by column ``kind``) and coefficients are stored by
    model and modality, so other models may use the same path.
    """
    base, n_pca = ML.parse_model_type(model_type)
    pca_block = [features.index(c) for c in pca_features] if n_pca else None
    x, y = stored(x.select("subject", *features)), stored(y)      # read by the checks, the splits and the results
    x = prepare_x_y(x, features, y, modality, allowed_missing)
    spark = x.sparkSession
    members = stored(SP.stratified_shuffle_splits(SP.stratify(y, list(strata or targets)), n_splits, seed=seed))
    if out_path:
        for name, df in (("x", x), ("y", y)):
            df.write.mode("overwrite").parquet(os.path.join(out_path, "input", name))
        SNK.write_split_members(members, os.path.join(out_path, "members"))
    if base == "ridgecv":
        res = ML.learn_ridge(x, features, y, targets, members, seed, alphas, pca_block=pca_block, n_components=n_pca,
                             permuted=permuted)
        if out_path:
            of = {"model": F.lit(model_type), "modality": F.lit(modality or "all")}
            SNK.write_predictions(SNK.marked_predictions(res).withColumns(of), os.path.join(out_path, "predictions"))
            fits = [res[name].withColumn("kind", F.lit(kind)) for name, kind in (("coefficients", "test"), ("coefficients_permuted", "permuted"))
                    if name in res]
            SNK.write_coefficients(TD.stack(fits, sort_columns=False).withColumns(of), os.path.join(out_path, "coefficients"))
        return res
    rows = stored(L.design_rows(x, features, y, targets, members))
    rows, names = ML.prepare(rows, pca_block, n_pca, features, imputer="iterative")
    wcol = None
    if weights is not False:
        table = D.density_weights(y, targets) if weights is True else weights.select("subject", "weight")
        rows = TD.left_align(rows, table)
        wcol = "weight"
    rows = stored(rows)

    def one(split: int) -> tuple[dict, dict]:
        began = time.time()
        tr = rows.filter((F.col("split") == split) & (F.col("role") == "train"))
        te = rows.filter((F.col("split") == split) & (F.col("role") == "test"))
        best = {"max_depth": depth, "criterion": None, "n_estimators": n_trees}
        out = {}
        if search is not None:
            best, found = ML.grid_search(tr, targets, base, seed + split, weight_col=wcol, parallelism=1,
                                         **{"n_trees": n_trees, **search})
            out["search"] = search_table(spark, split, found)
        fit = lambda train: ML.fit_forests(
            train, targets, base, best["max_depth"], best["criterion"], seed, best["n_estimators"], wcol)
        ms = fit(tr)
        out["predictions"] = ML.predict_forests(ms, te, targets).drop("weight")
        out["predictions_training"] = ML.predict_forests(ms, tr, targets).drop("weight")
        out["importances"] = ML.feature_importances(ms, names, spark, split)
        if permuted:
            perm = SP.permute_within(members.filter(F.col("split") == split), y, targets, seed=seed)
            py = perm.select("split", "subject", "role", F.array(*[F.col(t).cast("double") for t in targets]).alias("y"))
            trp = TD.outer_align(tr.drop("y"), py.filter("role = 'train'").drop("role"), ["split", "subject"])
            p = ML.predict_forests(fit(trp), te, targets).drop("weight")
            truth = perm.filter("role = 'test'").select("split", "subject", *targets)
            out["predictions_permuted"] = TD.outer_align(p, truth, ["split", "subject"])
        out["split_info"] = spark.createDataFrame(
            [(split, time.time() - began, list(features), list(names))],
            "split int, seconds double, input_features array<string>, model_features array<string>")
        return out, dict(zip(targets, ms))

    store = SplitStore(spark, out_path) if out_path else None
    done = store.splits() if store else set()
    failures, parts, unwritten = [], [], []

    def run(split: int) -> None:
        try:
            out, models = one(split)
        except Exception as e:  # a split's fit: recorded, the other splits go on
            failures.append((split, e))
            return
        parts.append((split, out))
        if store:
            try:
                store.write(split, out, models)
            except Exception as e:
                unwritten.append(e)

    todo = [s for s in range(n_splits) if s not in done]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        list(ex.map(run, todo))
    if unwritten:
        raise unwritten[0]
    failures.sort(key=lambda f: f[0])
    if failures and len(failures) == n_splits:
        raise failures[0][1]
    if failures:
        lost = SplitsFailed(f"splits {[k for k, _ in failures]} of {n_splits} have no results: {failures[0][1]}")
        if not (bool(out_path) if report_failures is None else report_failures):
            raise lost from failures[0][1]
        warnings.warn(str(lost), stacklevel=2)
    wanted = ["predictions", "predictions_training", "importances", "split_info"]
    wanted += ["predictions_permuted"] * permuted + ["search"] * (search is not None)
    if store:
        res = {k: store.read(k) for k in wanted}
    else:
        ordered = [out for _, out in sorted(parts, key=lambda p: p[0])]
        res = {k: TD.stack([out[k] for out in ordered], sort_columns=False) for k in wanted}
    truth = y.select("subject", *targets)
    for key in ("predictions", "predictions_training"):
        res[key] = TD.left_align(res[key], truth)
    res["failures"] = spark.createDataFrame([(s, str(e)) for s, e in failures], "split int, error string")
    res["feature_names"], res["skipped_splits"] = names, sorted(done)
    return res


def search_table(spark: SparkSession, split: int, found: Sequence[dict]) -> DataFrame:
    """RSH5: one row per candidate of a search, its parameters as columns (one fit's result list, bounded by the grid)."""
    recs = [(split, r["mean_train_score_gs"], r["mean_test_score_gs"], {k: str(v) for k, v in r["params"].items()})
            for r in found]
    gs = spark.createDataFrame(recs, "split int, mean_train_score_gs double, mean_test_score_gs double, "
                                     "params map<string,string>")
    return TD.params_to_columns(gs, ["criterion", "max_depth", "n_estimators", "max_features"])


class SplitStore:
    """Results of splits below one path, visible only with the split's completion mark.

    Every output of a split has a folder of its own, ``<output>/split=<k>``, so writers of other
    splits, in threads or other drivers, share no folder that a commit cleans up.
    What an ended run left without a mark is replaced."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, output: str, split: int) -> str:
        return os.path.join(self.path, output, f"split={split}")

    def write(self, split: int, outputs: dict[str, DataFrame], models: dict | None = None) -> None:
        for target, model in (models or {}).items():
            SNK.save_model(model, os.path.join(self._folder("models", split), f"target={target}"))
        for name, df in outputs.items():
            df.drop("split").write.mode("overwrite").parquet(self._folder(name, split))
        self.spark.range(1).write.mode("overwrite").parquet(self._folder("done", split))

    def splits(self) -> set[int]:
        try:
            marks = self.spark.read.schema("split int").parquet(os.path.join(self.path, "done"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()                                 # no store yet
        return {r[0] for r in marks.distinct().collect()}

    def read(self, output: str) -> DataFrame:
        """The rows of all splits with a mark."""
        folders = [self._folder(output, k) for k in sorted(self.splits())]
        return self.spark.read.option("basePath", os.path.join(self.path, output)).parquet(*folders)


def _members(spark, sf, n_splits):
    return SP.stratified_shuffle_splits(SP.stratify(V.targets(spark, sf), T), n_splits, seed=SEED)


def learn_customers(spark: SparkSession, sf: str, model_type: str = "ridgecv", **options) -> dict:
    """``learn`` on the customers' order features (price columns have gaps) and both targets."""
    return learn(V.learn_x(spark, sf), LEARN_FEATURES, V.targets(spark, sf), T, model_type, modality="orders",
                 allowed_missing=["price_F", "price_O", "price_P"], pca_features=["n_F", "n_O", "n_P"], **options)


# ---------------------------------------------------------------- ML14

def learning_curve(x: DataFrame, features: Sequence[str], y: DataFrame, targets: Sequence[str], modality: str = "orders",
                   model_type: str = "ridgecv", alphas=L.RIDGE_ALPHAS, best: dict | None = None, n_folds: int = 5,
                   parallelism: int = 4) -> DataFrame:
    """ML14: scores (R², mean over targets) of (size, fold) fits on their train part and
    held-out fold, long.  Ridge fits all of them in one job; forests take the
    parameters ``best`` (max_depth, criterion, n_estimators), one fit per (size, fold)."""
    base, _ = ML.parse_model_type(model_type)
    y = stored(y.select("subject", *targets))
    members = stored(ML.learning_curve_members(y.select("subject"), n_folds))
    rows = stored(L.design_rows(x, features, y, targets, members.drop("size_idx", "fold")))
    rows, _ = ML.prepare(rows, feature_names=features, imputer="iterative")
    rows = stored(rows)
    if base == "ridgecv":
        pred = L.predict_linear(rows, L.ridge_cv(rows.filter("role = 'train'"), alphas), len(targets), targets)
    else:
        best = best or {}

        def one(split):
            own = rows.filter(F.col("split") == split)
            ms = ML.fit_forests(own.filter("role = 'train'"), targets, base, best.get("max_depth"), best.get("criterion"),
                                SEED, best.get("n_estimators", ML.FOREST_TREES))
            return ML.predict_forests(ms, own, targets)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            pred = TD.stack(list(ex.map(one, range(n_folds * len(ML.TRAIN_SIZES)))), sort_columns=False)
    pred = pred.join(y.select("subject", *targets), "subject")
    sizes = members.filter("role = 'train'").groupBy("split", "fold").agg(F.count(F.lit(1)).alias("train_size"))
    by_role = _r2_by_group(pred, ["split", "role"], targets).join(sizes, "split")
    sc = TD.concat_labelled({"train": by_role.filter("role = 'train'"), "validation": by_role.filter("role = 'test'")})
    wide = sc.groupBy("train_size", "kind").pivot("fold", list(range(n_folds))).agg(F.first("score"))
    wide = wide.select("train_size", "kind", *[F.col(str(f)).alias(f"cv_{f}") for f in range(n_folds)])
    wide = wide.withColumn("modality", F.lit(modality))
    return TD.unpivot_scores(wide, ["modality", "train_size", "kind"], [f"cv_{f}" for f in range(n_folds)])


def _r2_by_group(pred: DataFrame, group, targets) -> DataFrame:
    """Mean over targets of (unweighted) R² per group — the search/curve score."""
    aggs = []
    for t in targets:
        yv, p = F.col(t), F.col(f"{t}_pred")
        aggs += [F.sum((yv - p) * (yv - p)).alias(f"r_{t}"), (F.var_pop(yv) * F.count(yv)).alias(f"s_{t}")]
    g = pred.groupBy(*group).agg(*aggs)
    r2s = [F.when(F.col(f"s_{t}") == 0, F.when(F.col(f"r_{t}") == 0, 1.0).otherwise(0.0))
           .otherwise(1.0 - F.col(f"r_{t}") / F.col(f"s_{t}")) for t in targets]
    return g.select(*group, (sum(r2s[1:], r2s[0]) / float(len(r2s))).alias("score"))


# ---------------------------------------------------------------- ML15

def permuted_copies(test: DataFrame, k: int, n_repeats: int = 5, seed: int = SEED) -> DataFrame:
    """Test rows repeated for every (feature j, repeat r) with x[j] replaced by
    the x[j] of the row at the same md5-order position (one shuffle of the
    column, gaps included, within the split's test rows).  Adds columns j, r."""
    base = test.select("split", "subject", "x", "y")
    left = SP.rank_within(base, ["split"], [F.col("subject")], "__rk")     # the same for every copy
    long = base.select("split", "subject", "x").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
    g = ["split", "j", "r"]
    right = SP.rank_within(long.select(*g, "subject", F.get(F.col("x"), F.col("j")).alias("__xp")), g,
                           [SP.md5_key(F.lit(seed), "split", "j", "r", "subject"), F.col("subject")], "__rk")
    # the k·n_repeats new values of a place meet its row at once
    new = right.groupBy("split", "__rk").agg(F.collect_list(F.struct("j", "r", "__xp")).alias("__new"))
    pair = left.join(new, ["split", "__rk"]).select(*base.columns, F.explode("__new").alias("__c")).select(*base.columns, "__c.*")
    return pair.withColumn("x", F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("__xp")).otherwise(v))).drop("__xp")


def permutation_importance(x: DataFrame, features: Sequence[str], y: DataFrame, targets: Sequence[str], members: DataFrame,
                           fit_predict, n_repeats: int = 5, modality: str = "orders") -> DataFrame:
    """ML15: test R² minus the R² with one input feature shuffled, averaged over repeats.

    The shuffled columns are those that enter the pipeline: every shuffled copy
    of a test row goes through the imputation fitted on the split's train rows, in
    the same job as the plain test rows.  ``fit_predict(train, test)`` gets
    prepared rows and adds ``{t}_pred`` to the test rows."""
    rows = stored(L.design_rows(x, features, y, targets, members))
    copies = stored_table(permuted_copies(rows.filter("role = 'test'"), len(features), n_repeats), "permuted-copies").withColumn(
        "role", F.lit("test"))
    plain = rows.withColumn("j", F.lit(-1)).withColumn("r", F.lit(-1))
    ready, _ = ML.prepare(plain.unionByName(copies), feature_names=features, imputer="iterative")
    train = stored(ready.filter("role = 'train'").drop("j", "r"))
    test = ready.filter("role = 'test'").select("*", *[F.get(F.col("y"), i).alias(t) for i, t in enumerate(targets)])
    scores = stored(_r2_by_group(fit_predict(train, test), ["split", "j", "r"], targets))      # copies are scored in one pass
    per = scores.groupBy("split", "j").agg(F.avg("score").alias("score"))
    base = per.filter("j = -1").select("split", F.col("score").alias("base_score"))
    nm = F.array(*[F.lit(n) for n in features])
    return per.filter("j >= 0").join(base, "split").select(
        F.lit(modality).alias("modality"), "split", F.element_at(nm, F.col("j") + 1).alias("feature"),
        (F.col("base_score") - F.col("score")).alias("permutation_importance"))


def ridge_fit_predict(targets: Sequence[str], alphas=L.RIDGE_ALPHAS):
    """For ``permutation_importance``: ridge, all splits in one job."""
    return lambda train, test: L.predict_linear(test, L.ridge_cv(train, alphas), len(targets), targets)


def forest_fit_predict(targets: Sequence[str], n_splits: int, depth: int | None, n_trees: int = ML.FOREST_TREES):
    """For ``permutation_importance``: random forests, one fit per split and target."""
    def run(train, test):
        parts = []
        for s in range(n_splits):
            ms = ML.fit_forests(train.filter(F.col("split") == s), targets, "basic", depth, None, SEED, n_trees)
            parts.append(ML.predict_forests(ms, test.filter(F.col("split") == s), targets))
        return TD.stack(parts, sort_columns=False)
    return run


# ---------------------------------------------------------------- ML6, ML9

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits"]


def document_features(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = V.table(spark, sf, "documents")
    lab = V.table(spark, sf, "labels")
    x = d.select(F.col("doc_id").cast("string").alias("subject"),
                 F.col("n_chars").cast("double").alias("n_chars"),
                 F.size(F.split("text", " ")).cast("double").alias("n_words"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                 F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("n_digits"))
    y = lab.select(F.col("doc_id").cast("string").alias("subject"), F.col("quality").cast("double").alias("quality"))
    return x.join(y.select("subject"), "subject", "left_semi"), y


def classify_documents(spark: SparkSession, sf: str, n_splits: int = 2) -> DataFrame:
    x, y = document_features(spark, sf)
    members = SP.stratified_shuffle_splits(y.withColumn("stratum", F.col("quality").cast("int")), n_splits, seed=SEED)
    rows = L.design_rows(x, DOC_FEATURES, y, ["quality"], members)
    rows, _ = ML.prepare(rows, feature_names=DOC_FEATURES, imputer="iterative")
    rows = stored(rows)
    outs = []
    for s in range(n_splits):
        tr = rows.filter((F.col("split") == s) & (F.col("role") == "train"))
        te = rows.filter((F.col("split") == s) & (F.col("role") == "test"))
        ms = ML.fit_forests(tr, ["quality"], "rfc", FOREST_DEPTH, "gini", SEED)
        outs.append(ML.predict_forests(ms, te, ["quality"]))
    return TD.stack(outs, sort_columns=False).join(y, "subject", "left")


def grid_search_table(spark: SparkSession, sf: str) -> DataFrame:
    y = V.targets(spark, sf)
    members = _members(spark, sf, 1)
    rows = stored(L.design_rows(V.learn_x(spark, sf), LEARN_FEATURES, y, ["total_price"], members))
    rows, _ = ML.prepare(rows, feature_names=LEARN_FEATURES, imputer="iterative")
    train = stored(rows.filter("role = 'train'"))
    _, results = ML.grid_search(train, ["total_price"], "basic", SEED, depths=SEARCH_DEPTHS,
                                n_trees=SEARCH_TREES, parallelism=2)
    return search_table(spark, 0, results)
