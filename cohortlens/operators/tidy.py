"""Tidy layer: projections, renames, joins on subject, unions and reshapes.

Feature tables come in two shapes:

* long ``(subject, [session,] name, value)`` — the canonical form; any number
  of features, unions instead of joins;
* wide ``(subject, f1, f2, ...)`` — built by pivot only for bounded name lists.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import recode, strip_prefix

# fixed values: recoding maps for categorical clinical columns
SEX_CODES = {"F": 0, "M": 1}
DIAGNOSIS_CODES = {"hc": 0, "mci": 1, "dem": 2}

# fixed values: allowed modality strategies and the feature tables each joins
STRATEGIES = {
    "clinical": ["clinical"],
    "structural": ["fs"],
    "structGlobScort": ["structGlobScort"],
    "functional": ["fmri"],
    "fullcon": ["fullcon"],
    "clinical+structural": ["clinical", "fs"],
    "clinical+structGlobScort": ["clinical", "structGlobScort"],
    "clinical+functional": ["clinical", "fmri"],
    "clinical+fullcon": ["clinical", "fullcon"],
    "clinical+structGlobScort+functional": ["clinical", "structGlobScort", "fmri"],
    "clinical+structGlobScort+fullcon": ["clinical", "structGlobScort", "fullcon"],
}
MODALITY_PARTS = ["clinical", "structural", "structGlobScort", "functional", "fullcon"]


# ---------------------------------------------------------------- projections

def strip_id_prefixes(df: DataFrame, subject_col: str | None = "subject",
                      session_col: str | None = "session") -> DataFrame:
    """PRJ1: drop a leading 'sub-' / 'ses-' from the id columns (either optional)."""
    out = df
    if subject_col:
        out = out.withColumn(subject_col, strip_prefix(subject_col, "sub-"))
    if session_col:
        out = out.withColumn(session_col, strip_prefix(session_col, "ses-"))
    return out


def session_map(df: DataFrame, participant_col: str = "participant_id",
                session_col: str = "session_id") -> DataFrame:
    """SRC1/PRJ1: (participant_id, session_id) -> (subject, session) without prefixes."""
    return strip_id_prefixes(df.select(F.col(participant_col).alias("subject"),
                                       F.col(session_col).alias("session")))


def recode_sex(df: DataFrame, c: str) -> DataFrame:
    """PRJ2: F->0, M->1; other values become NULL (reported by check_domain)."""
    return df.withColumn(c, recode(c, SEX_CODES))


def recode_diagnosis(df: DataFrame, c: str) -> DataFrame:
    """PRJ3: hc->0, mci->1, dem->2; other values become NULL."""
    return df.withColumn(c, recode(c, DIAGNOSIS_CODES))


def select_names(long: DataFrame, names: Sequence[str], name_col: str = "name") -> DataFrame:
    """PRJ4: keep the listed feature names (long form; the list is a literal IN)."""
    return long.filter(F.col(name_col).isin(list(names)))


def drop_names(long: DataFrame, names: Sequence[str], name_col: str = "name") -> DataFrame:
    """PRJ5: drop the listed feature names."""
    return long.filter(~F.col(name_col).isin(list(names)))


def prefix_names(long: DataFrame, prefix: str, name_col: str = "name") -> DataFrame:
    """PRJ6 (long form): name -> prefix || name."""
    return long.withColumn(name_col, F.concat(F.lit(prefix), F.col(name_col)))


def add_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ("subject",)) -> DataFrame:
    """PRJ6 (wide form): rename every non-key column to prefix + name."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def prefix_tables(dfs: Sequence[DataFrame], prefixes: Sequence[str] | None,
                  keep: Sequence[str] = ("subject",)) -> list[DataFrame]:
    """PRJ6: '{prefix}__' per table; the number of prefixes must match."""
    if prefixes is None:
        return list(dfs)
    if len(prefixes) != len(dfs):
        raise ValueError("number of tables and prefixes differ")
    return [add_prefix(d, p + "__", keep) for d, p in zip(dfs, prefixes)]


def filter_names_regex(long: DataFrame, pattern: str, name_col: str = "name") -> DataFrame:
    """PRJ7 (long form): unanchored, case-sensitive regex on the feature name."""
    return long.filter(F.col(name_col).rlike(pattern))


def filter_columns_regex(df: DataFrame, pattern: str, keep: Sequence[str] = ("subject",)) -> DataFrame:
    """PRJ7 (wide form): keep columns whose name matches ``pattern``."""
    rx = re.compile(pattern)
    return df.select(*[c for c in df.columns if c in keep or rx.search(c)])


def sanitize_names(c: str | Column) -> Column:
    """PRJ8: '&' -> '_' in a name."""
    return F.translate(F.col(c) if isinstance(c, str) else c, "&", "_")


def rename_substrings(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ9: apply substring replacements to all column names, in order."""
    names = list(df.columns)
    for old, new in mapping.items():
        names = [n.replace(old, new) for n in names]
    return df.toDF(*names)


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ12: NULL -> 0 on the given (default all numeric) columns."""
    return df.fillna(0, subset=list(cols) if cols else None)


def columns_with_missing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """AGG5 evaluated: names of columns holding at least one NULL (one pass)."""
    if not cols:
        return []
    row = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def any_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG5 as a table: (column, any_missing, n_missing)."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = agg.unpivot([], list(cols), "column", "n_missing")
    return long.select("column", (F.col("n_missing") > 0).alias("any_missing"),
                       F.col("n_missing").cast("bigint").alias("n_missing"))


def fillna_missing_in_attributes(df: DataFrame, key: Sequence[str] = ("subject",),
                                 fill_value: float = 999.0,
                                 missing_cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ13: NULL -> -fill in place plus ``{c}_missing`` (value, or +fill where
    missing) for each column that has at least one NULL.

    The set of twin columns depends on the data; it is found with one aggregate
    pass (``columns_with_missing``) unless passed in.
    """
    feats = [c for c in df.columns if c not in key]
    if missing_cols is None:
        missing_cols = columns_with_missing(df, feats)
    out = [F.col(c) for c in key]
    out += [F.coalesce(F.col(c), F.lit(-fill_value)).alias(c) if c in missing_cols else F.col(c) for c in feats]
    out += [F.coalesce(F.col(c), F.lit(fill_value)).alias(f"{c}_missing") for c in missing_cols]
    return df.select(*out)


def filter_rows(df: DataFrame, requested: DataFrame, key: str = "subject") -> DataFrame:
    """PRJ15: rows for the requested keys, in request order.

    ``requested`` is (key, pos); the result carries ``pos`` so that a final
    ``orderBy('pos')`` restores the requested order.
    """
    return df.join(requested.select(key, "pos"), key, "inner")


def exclude(df: DataFrame, excluded: DataFrame, key: str = "subject") -> DataFrame:
    """PRJ17: drop listed keys (left anti join)."""
    return df.join(excluded.select(key), key, "left_anti")


def validate_modality(modality: str) -> list[str]:
    """PRJ18: split 'a+b' into parts; every part must be a known modality and
    the whole string a known strategy.  Returns the feature tables to join."""
    for part in modality.split("+"):
        if part not in MODALITY_PARTS:
            raise ValueError(f"unknown modality part {part!r} in {modality!r}")
    if modality not in STRATEGIES:
        raise ValueError(f"unknown strategy {modality!r}")
    return STRATEGIES[modality]


def modality_membership(modalities: DataFrame, order: Sequence[str], col: str = "modality",
                        sep: str = " + ") -> DataFrame:
    """PRJ19: 'checkerboard' — per modality row i (0-based ``pos`` column) and
    per part in ``order``: i+1 if the part is a member, else 0."""
    parts = F.split(F.col(col), re.escape(sep))
    return modalities.select(
        "pos", col,
        *[F.when(F.array_contains(parts, F.lit(o)), F.col("pos") + 1).otherwise(0).alias(o) for o in order])


def strip_cv_prefix(c: str | Column) -> Column:
    """PRJ21: 'cv_3' -> '3' (stays a string)."""
    return strip_prefix(c, "cv_")


# ---------------------------------------------------------------- joins

def concat_modalities(dfs: Sequence[DataFrame], prefixes: Sequence[str] | None = None,
                      key: str = "subject") -> DataFrame:
    """JOIN1: horizontal concat of feature tables = full outer joins on subject."""
    dfs = prefix_tables(dfs, prefixes, (key,))
    out = dfs[0]
    for d in dfs[1:]:
        out = out.join(d, key, "full")
    return out


def concat_modalities_long(dfs: Sequence[DataFrame]) -> DataFrame:
    """JOIN1 in long form: a union, no join at all."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def left_align(df: DataFrame, other: DataFrame, key: str | Sequence[str] = "subject") -> DataFrame:
    """JOIN2/JOIN4/JOIN7: left join on the key (rows multiply on duplicate keys: check V5)."""
    return df.join(other, key, "left")


def outer_align(df: DataFrame, other: DataFrame, key: str | Sequence[str] = "subject") -> DataFrame:
    """JOIN6/JOIN8: full outer align on the key."""
    return df.join(other, key, "full")


def semi(df: DataFrame, keys: DataFrame, key: str = "subject") -> DataFrame:
    """JOIN5: rows whose key is requested."""
    return df.join(keys.select(key), key, "left_semi")


def anti(df: DataFrame, keys: DataFrame, key: str = "subject") -> DataFrame:
    """JOIN5/SET4: keys of ``df`` absent from ``keys``."""
    return df.join(keys.select(key), key, "left_anti")


def lookup_session(df: DataFrame, smap: DataFrame, key: str = "subject") -> DataFrame:
    """JOIN9: attach the session of each subject (inner join)."""
    return df.join(smap.select(key, "session"), key, "inner")


# ---------------------------------------------------------------- unions, sort

def stack(dfs: Sequence[DataFrame], sort_columns: bool = True) -> DataFrame:
    """SET1 (+SRT2): vertical union by name, missing columns NULL, columns sorted."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.select(*sorted(out.columns)) if sort_columns else out


def concat_labelled(dfs: Mapping[str, DataFrame], label_col: str = "kind") -> DataFrame:
    """SET5: union with a literal label per input."""
    parts = [d.withColumn(label_col, F.lit(k)) for k, d in dfs.items()]
    return stack(parts, sort_columns=False)


# ---------------------------------------------------------------- reshape

def pivot_wide(long: DataFrame, names: Sequence[str], key: str = "subject", name_col: str = "name",
               value_col: str = "value") -> DataFrame:
    """RSH1/FS3: long -> wide with an explicit (bounded) name list."""
    return long.groupBy(key).pivot(name_col, list(names)).agg(F.first(value_col))


def unpivot_scores(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
                   var_name: str = "cv_split", value_name: str = "score") -> DataFrame:
    """RSH3: wide cv_* columns -> long, 'cv_' stripped from the split label."""
    long = df.unpivot(list(id_cols), list(value_cols), var_name, value_name)
    return long.withColumn(var_name, strip_cv_prefix(var_name))


def params_to_columns(gs: DataFrame, param_names: Sequence[str], params_col: str = "params") -> DataFrame:
    """RSH5: map<string,string> of parameters -> one column per known key, after ``split``."""
    rest = [c for c in gs.columns if c not in ("split", params_col)]
    return gs.select("split", *rest, *[F.col(params_col)[k].alias(k) for k in param_names])


def matrix_to_long(df: DataFrame, matrix_col: str = "matrix", keys: Sequence[str] = ()) -> DataFrame:
    """RSH6: array<array<double>> -> (keys..., i, j, value)."""
    rows = df.select(*keys, F.posexplode(matrix_col).alias("i", "__row"))
    return rows.select(*keys, "i", F.posexplode("__row").alias("j", "value"))


def flatten_list(c: str | Column) -> Column:
    """RSH8: one level of list flattening."""
    return F.flatten(F.col(c) if isinstance(c, str) else c)


def sorted_columns(df: DataFrame, first: Iterable[str] = ()) -> DataFrame:
    """SRT2: columns in sorted order (optionally some first)."""
    first = list(first)
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


# ---------------------------------------------------------------- user-defined per-group functions (UDF1)

def apply_per_group(df: DataFrame, keys: Sequence[str], fn, schema: str) -> DataFrame:
    """UDF1: run a pandas function on every group (``applyInPandas``).

    ``fn(pdf) -> scalar | dict | DataFrame``: a scalar becomes one column
    ``value``, a dict one row with several columns.  Built-in metrics should be
    preferred (they are partial aggregates); a group is handed to ``fn`` whole,
    so use this only for groups of bounded size.
    """
    import pandas as pd
    keys = list(keys)

    def run(pdf):
        out = fn(pdf)
        if isinstance(out, pd.DataFrame):
            res = out
        elif isinstance(out, dict):
            res = pd.DataFrame([out])
        else:
            res = pd.DataFrame({"value": [out]})
        for k in keys:
            res.insert(0, k, pdf[k].iloc[0]) if k not in res.columns else None
        return res

    return df.groupBy(*keys).applyInPandas(run, schema)
