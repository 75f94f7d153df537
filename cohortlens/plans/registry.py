"""Registry of named queries: a Spark builder and (where SQL can say it) the
equivalent DuckDB SQL used as an oracle.

Every registered query reads the driver tables (or views Spark derives from
them) in full.  Double outputs are rounded to 6 decimals on both sides so that
float summation order does not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round double columns to 6 decimals (and fold -0.0 into 0.0).

    Rounded as round(x·1e6)/1e6: a tie of the scaled value is exactly
    representable, so Spark and DuckDB both round it away from zero and give
    the same double."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scaled = F.round(F.col(f.name).cast("double") * F.lit(1e6), 0)
            out.append((scaled / F.lit(1e6) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rounded(sql: str, double_cols: Sequence[str]) -> str:
    """Wrap oracle SQL so that the listed double columns are rounded like ``finish``."""
    if not double_cols:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE) * 1000000.0) / 1000000.0 + 0.0 AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) __q"
