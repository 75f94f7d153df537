"""Scalar column helpers (all JVM-side expressions, no Python UDFs).

Missing-value policy: a source never keeps NaN, it is turned into NULL on the
way in (``nan_to_null``).  Divisions that can hit zero use ``safe_div`` so that
ANSI mode never raises and a zero denominator yields NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (keeps NULL), so that aggregates skip it like pandas does."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Apply ``nan_to_null`` to every float/double column of ``df``."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select([nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def safe_div(num: Column, den: Column) -> Column:
    """num / den with NULL for a zero or NULL denominator (ANSI-safe)."""
    return num / F.nullif(den, F.lit(0.0))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation aggregate; NULL for a constant column (never raises)."""
    x, y = col(x), col(y)
    return safe_div(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def fisher_z(r: str | Column) -> Column:
    """atanh(r); +-Infinity at +-1 like numpy, NULL outside [-1, 1]."""
    r = col(r)
    return (F.when(F.abs(r) < 1, F.atanh(r))
            .when(r == 1, F.lit(float("inf")))
            .when(r == -1, F.lit(float("-inf"))))


def sort_pair(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """(smaller, larger) of two non-NULL strings in byte order."""
    return F.least(col(a), col(b)), F.greatest(col(a), col(b))


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """Remove a leading literal prefix (anchored)."""
    return F.regexp_replace(col(c), "^" + _regex_escape(prefix), "")


def recode(c: str | Column, mapping: Mapping[str, float | int]) -> Column:
    """Map string codes to numbers; unmapped values become NULL (see check_domain)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out


def any_null(c: str | Column) -> Column:
    """Aggregate: true if any row of the group has NULL in ``c``."""
    return F.max(col(c).isNull())


def row_mean(cols: Iterable[str | Column]) -> Column:
    """Mean across columns of one row, NULLs skipped (pandas ``mean(axis=1)``)."""
    cols = [col(c) for c in cols]
    s = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return safe_div(s, n.cast("double"))


def round6(c: str | Column) -> Column:
    return F.round(col(c), 6)


def _regex_escape(s: str) -> str:
    special = set(".^$*+?{}[]\\|()")
    return "".join("\\" + ch if ch in special else ch for ch in s)
