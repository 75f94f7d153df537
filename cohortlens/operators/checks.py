"""Data checks.  Each returns a *violations* DataFrame (empty = fine);
``assert_none`` turns violations into an error with the reference's message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.tidy import any_missing


class CheckFailed(RuntimeError):
    pass


def assert_none(violations: DataFrame, message: str, show: int = 20) -> None:
    """Raise if the violations table has rows; at most ``show`` rows reach the driver."""
    rows = violations.limit(show).collect()
    if rows:
        raise CheckFailed(f"{message}: {[r.asDict() for r in rows]}")


def missing_outside_allowed(df: DataFrame, allowed: Sequence[str], key: Sequence[str] = ("subject",)) -> DataFrame:
    """V1: (column) for every column with a NULL that is not allow-listed."""
    cols = [c for c in df.columns if c not in key and c not in set(allowed)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string")
    return any_missing(df, cols).filter("any_missing").select("column")


#: The assessment columns that may have gaps (the imputer fills them).
BASIC_ALLOWED_MISSING = (
    "clin__risk__apoe_apoe", "clin__risk__apoe_e2count", "clin__risk__apoe_e3count", "clin__risk__apoe_e4count",
    "clin__assess__diag", "clin__risk__demo_education", "clin__risk__smoke_TOBAC30", "clin__risk__smoke_TOBAC100",
    "clin__risk__smoke_SMOKYRS", "clin__risk__smoke_PACKSPER", "clin__risk__diabetes_DIABETES",
    "clin__risk__hypercho_HYPERCHO", "clin__risk__cvasc_HYPERTEN", "clin__risk__cvasc_CBSTROKE",
    "clin__risk__cvasc_CBTIA", "clin__risk__cvasc_CVHATT", "clin__risk__cvasc_CVAFIB", "clin__risk__cvasc_CVANGIO",
    "clin__risk__cvasc_CVOTHR", "clin__assess__cdr_commun", "clin__assess__cdr_homehobb",
    "clin__assess__cdr_judgment", "clin__assess__cdr_memory", "clin__assess__cdr_orient",
    "clin__assess__cdr_perscare", "clin__assess__cdr_cdrGlobal", "clin__assess__gds_gdsSum",
    "clin__assess__faq_BILLS", "clin__assess__faq_TAXES", "clin__assess__faq_SHOPPING", "clin__assess__faq_GAMES",
    "clin__assess__faq_STOVE", "clin__assess__faq_MEALPREP", "clin__assess__faq_EVENTS",
    "clin__assess__faq_PAYATTN", "clin__assess__faq_REMDATES", "clin__assess__faq_TRAVEL",
    "clin__assess__faq_faqSum", "clin__assess__npiq_npiqPresSum", "clin__assess__npiq_npiqSevSum",
    "clin__npsy__WMSlm_LOGIMEM", "clin__npsy__WMSlm_MEMUNITS", "clin__npsy__WMSlm_MEMTIME",
    "clin__npsy__WMSds_DIGIF", "clin__npsy__WMSds_DIGIFLEN", "clin__npsy__WMSds_DIGIB",
    "clin__npsy__WMSds_DIGIBLEN", "clin__npsy__WF_ANIMALS", "clin__npsy__WF_VEG", "clin__npsy__TMTA_TRAILA",
    "clin__npsy__TMTA_TRAILARR", "clin__npsy__TMTA_TRAILALI", "clin__npsy__TMTB_TRAILB",
    "clin__npsy__TMTB_TRAILBRR", "clin__npsy__TMTB_TRAILBLI", "clin__npsy__TMTB_TRAILBnorm",
    "clin__npsy__WAIS_WAIS", "clin__npsy__BOSTON_BOSTON", "clin__risk__familyHist_MOMDEM",
    "clin__risk__familyHist_DADDEM", "clin__risk__familyHist_sumSibDem", "clin__risk__familyHist_ratioSibDem",
)


def check_missings(df: DataFrame, allowed: Sequence[str], key: Sequence[str] = ("subject",)) -> None:
    """V1 as an assertion with the reference wording."""
    bad = [r["column"] for r in missing_outside_allowed(df, allowed, key).collect()]
    if bad:
        raise CheckFailed(f"Columns {bad} contain missings, but are not included in the allowed_missing_cols")


def missing_keys(requested: DataFrame, present: DataFrame, key: str = "subject") -> DataFrame:
    """V2/SET4: requested keys absent from ``present``."""
    return requested.select(key).join(present.select(key), key, "left_anti")


def rows_with_null(df: DataFrame) -> DataFrame:
    """V3: rows holding any NULL (loaded predictions must be complete)."""
    cond = None
    for c in df.columns:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.filter(cond)


def files_per_key(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V4: keys with zero or several input files (expected keys left-joined to counts)."""
    counts = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_files"))
    return (expected.select(*keys).distinct().join(counts, list(keys), "left")
            .select(*keys, F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"))
            .filter("n_files <> 1"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V5/SET2: keys occurring more than once (partial aggregation, skew-safe)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").withColumn("n", F.col("n").cast("bigint")))


def outside_domain(df: DataFrame, c: str, allowed: Sequence, key: Sequence[str] = ()) -> DataFrame:
    """V6: rows whose value is not in the allowed domain (NULL counts as outside)."""
    return df.filter(~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False))).select(*key, c)


def not_positive(df: DataFrame, c: str, key: Sequence[str] = ()) -> DataFrame:
    """V6: values that must be > 0 (TR, volumes)."""
    return df.filter(~F.coalesce(F.col(c) > 0, F.lit(False))).select(*key, c)


def unaligned_keys(x: DataFrame, y: DataFrame, key: str = "subject") -> DataFrame:
    """V7: keys present on only one side of X and y."""
    a = x.select(F.col(key).alias("__kx")).distinct()
    b = y.select(F.col(key).alias("__ky")).distinct()
    j = a.join(b, a.__kx == b.__ky, "full")
    return j.filter(F.col("__kx").isNull() | F.col("__ky").isNull()).select(
        F.coalesce("__kx", "__ky").alias(key),
        F.when(F.col("__kx").isNull(), F.lit("y_only")).otherwise(F.lit("x_only")).alias("side"))


def incomplete_subjects(inventory: DataFrame, keys: Sequence[str] = ("subject", "session"),
                        anat_suffix: str = "T1w", func_suffix: str = "bold") -> DataFrame:
    """V8: (subject, session) without a T1w image or without a functional run."""
    g = inventory.groupBy(*keys).agg(
        F.count(F.when(F.col("suffix") == anat_suffix, 1)).alias("n_anat"),
        F.count(F.when(F.col("suffix") == func_suffix, 1)).alias("n_func"))
    return g.filter("n_anat = 0 OR n_func = 0").select(
        *keys, F.col("n_anat").cast("bigint"), F.col("n_func").cast("bigint"))


def train_test_overlap(members: DataFrame, split_col: str = "split", key: str = "subject",
                       role_col: str = "role") -> DataFrame:
    """V9/SET3: (split, subject) that is both train and test."""
    return (members.groupBy(split_col, key).agg(F.countDistinct(role_col).alias("n_roles"))
            .filter("n_roles > 1").select(split_col, key))
