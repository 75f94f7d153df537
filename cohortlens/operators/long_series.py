"""Band-pass of series that are longer than a task should hold.

The projection onto the cosines of a band is a convolution of the mirrored series
with one kernel that has a closed form.  Series and kernel are transformed in four
steps: a series of n points is laid out as n1 x n2 numbers (n1 * n2 >= 3 n); tasks
transform groups of columns, turn them by the twiddle factors, and deal the result out
by groups of rows; these are transformed, multiplied, transformed back and dealt out by
columns again.  A task holds about ``block_points`` numbers, whatever the length of the
series; the exchanges carry blocks, not points.

Edge cases: the points of a series are taken as equally spaced in the order of ``t``; equal
``t`` are ordered by their value; a missing value counts as 0; a NULL key is a key; an empty
table gives an empty one; other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortlens.operators.ranking import rank_within
from cohortlens.session import stored

BLOCK_POINTS = 1 << 20       # numbers of a block in a task

SHAPE = ["__n", "__n1", "__n2", "__cols", "__rows"]


def layout(n: int, block_points: int) -> tuple[int, int, int, int]:
    """(n1, n2, columns of a group, rows of a group) of a series of n points."""
    n1 = 2
    while n1 * n1 < 3 * n:
        n1 *= 2
    n2 = -(-3 * n // n1)
    return n1, n2, max(1, block_points // n1), max(1, block_points // n2)


def band(n: int, tr: float, low: float, high: float) -> tuple[int, int]:
    """First and last cosine of n points with a frequency k/(2·n·TR) in [low, high]; never the mean."""
    def freq(k):
        return k / (2.0 * n * tr)

    a = max(1, math.ceil(low * 2.0 * n * tr) - 1)
    while freq(a) < low:
        a += 1
    b = min(n - 1, math.floor(high * 2.0 * n * tr) + 1)
    while b > 0 and freq(b) > high:
        b -= 1
    return a, b


def kernel(m: np.ndarray, n: int, a: int, b: int) -> np.ndarray:
    """Sum of cos(pi k m / n) / n over k in [a, b]; angles are reduced to [-pi/2, pi/2] as integers,
    so small sines keep their digits."""
    if b < a:
        return np.zeros(m.shape)

    def sine(k):
        r = (k * m + 2 * n) % (4 * n) - 2 * n
        r = np.where(r > n, 2 * n - r, np.where(r < -n, -2 * n - r, r))
        return np.sin(np.pi * r / (2.0 * n))

    below = 2.0 * sine(1)
    same = m % (2 * n) == 0
    return np.where(same, b - a + 1.0, (sine(2 * b + 1) - sine(2 * a - 1)) / np.where(same, 1.0, below)) / n


def _turn(j: np.ndarray, k: np.ndarray, size: int, sign: float) -> np.ndarray:
    return np.exp(sign * 2j * np.pi * ((j * k) % size) / size)


def _same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def split_by_length(df: DataFrame, series_keys: Sequence[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of series of at most ``most`` points, and the rows of longer ones (None: there are none)."""
    keys = list(series_keys)
    sizes = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]))
    if sizes.isEmpty():
        return df, None
    cond = _same_keys(keys, sizes.columns)
    return df.join(sizes, cond, "left_anti"), df.join(sizes, cond, "left_semi")


def band_pass_long(df: DataFrame, series_keys: Sequence[str], tr: float, low: float = 0.01, high: float = 0.1,
                   value: str = "value", t: str = "t", block_points: int = BLOCK_POINTS) -> DataFrame:
    """SIG5 for series of any length: no task holds more than blocks of one."""
    keys = list(series_keys)
    ranked = stored(rank_within(df, keys, [t, value], "__s").withColumn("__s", F.col("__s").cast("long") - 1))
    kinds = [ranked.schema[k] for k in keys]
    whole = [StructField(name, LongType()) for name in SHAPE]

    def shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [layout(int(n), block_points) for n in frame["__n"]]
            for i, name in enumerate(SHAPE[1:]):
                frame[name] = np.array([m[i] for m in made], np.int64)
            yield frame

    sizes = ranked.groupBy(*keys).agg((F.max("__s") + 1).alias("__n")).mapInPandas(shapes, StructType(kinds + whole))
    names = [f"__k{i}" for i in range(len(keys))]
    sizes = sizes.withColumnsRenamed(dict(zip(keys, names)))
    points = ranked.select(*keys, "__s", F.col(value).cast("double").alias("__x")).join(sizes, _same_keys(keys, names))
    points = points.select(*keys, *SHAPE, "__x", F.explode(
        F.array(F.col("__n") + F.col("__s"), F.col("__n") - 1 - F.col("__s"))).alias("__u"))
    points = points.withColumn("__cg", F.floor((F.col("__u") % F.col("__n2")) / F.col("__cols")).cast("long"))

    def frame_of(key, m: int, schema: pa.Schema, **columns) -> pa.Table:
        """Key columns repeated, then ``columns``."""
        fixed = [pa.array([v.as_py()] * m, schema.field(i).type) for i, v in enumerate(key)]
        return pa.Table.from_arrays(
            fixed + [pa.array(columns[f.name], f.type) for f in list(schema)[len(fixed):]], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    def arrow(ddl: str) -> tuple[StructType, pa.Schema]:
        spark_schema = StructType(kinds + whole + list(StructType.fromDDL(ddl)))
        return spark_schema, to_arrow_schema(spark_schema)

    first, first_arrow = arrow("__rg long, __cg long, x binary, h binary")
    second, second_arrow = arrow("__cg long, __rg long, y binary")
    last, last_arrow = arrow("__s long, y double")

    def by_columns(key: tuple, rows: pa.Table) -> pa.Table:
        n, n1, n2, cols, height, group = (v.as_py() for v in key[len(keys):])
        j0, size = group * cols, n1 * n2
        j = np.arange(j0, min(j0 + cols, n2), dtype=np.int64)
        u = rows.column("__u").to_numpy()
        x = np.zeros((n1, len(j)))
        x[u // n2, u % n2 - j0] = np.nan_to_num(rows.column("__x").to_numpy())
        at = np.arange(n1, dtype=np.int64)[:, None] * n2 + j
        at = np.where(at > size - n, at - size, at)
        h = np.where(at < 2 * n, kernel(at, n, *band(n, tr, low, high)), 0.0)
        turn = _turn(j, np.arange(n1, dtype=np.int64)[:, None], size, -1.0)
        x, h = np.fft.fft(x, axis=0) * turn, np.fft.fft(h, axis=0) * turn
        cut = range(0, n1, height)
        return frame_of(key[:-1], len(cut), first_arrow, __rg=np.arange(len(cut)), __cg=np.full(len(cut), group),
                        x=[x[k:k + height].tobytes() for k in cut], h=[h[k:k + height].tobytes() for k in cut])

    def assembled(rows: pa.Table, name: str, group: str, width: int, total: int, other: int, by_col: bool) -> np.ndarray:
        out = np.empty((other, total) if by_col else (total, other), complex)
        for g, block in zip(rows.column(group).to_pylist(), rows.column(name)):
            a, b = g * width, min(g * width + width, total)
            if by_col:
                out[:, a:b] = np.frombuffer(block.as_buffer(), complex).reshape(other, b - a)
            else:
                out[a:b] = np.frombuffer(block.as_buffer(), complex).reshape(b - a, other)
        return out

    def by_rows(key: tuple, rows: pa.Table) -> pa.Table:
        n, n1, n2, cols, height, group = (v.as_py() for v in key[len(keys):])
        k = np.arange(group * height, min(group * height + height, n1), dtype=np.int64)
        y = np.fft.fft(assembled(rows, "x", "__cg", cols, n2, len(k), True), axis=1)
        y *= np.fft.fft(assembled(rows, "h", "__cg", cols, n2, len(k), True), axis=1)
        y = np.fft.ifft(y, axis=1) * _turn(np.arange(n2, dtype=np.int64), k[:, None], n1 * n2, 1.0)
        cut = range(0, n2, cols)
        return frame_of(key[:-1], len(cut), second_arrow, __cg=np.arange(len(cut)), __rg=np.full(len(cut), group),
                        y=[y[:, j:j + cols].tobytes() for j in cut])

    def back(key: tuple, rows: pa.Table) -> pa.Table:
        n, n1, n2, cols, height, group = (v.as_py() for v in key[len(keys):])
        j = np.arange(group * cols, min(group * cols + cols, n2), dtype=np.int64)
        y = np.fft.ifft(assembled(rows, "y", "__rg", height, n1, len(j), False), axis=0).real
        s = np.arange(n1, dtype=np.int64)[:, None] * n2 + j - n
        here = (s >= 0) & (s < n)
        return frame_of(key[:-1], int(here.sum()), last_arrow, __s=s[here], y=y[here])

    series = [*keys, *SHAPE]
    made = points.groupBy(*series, "__cg").applyInArrow(by_columns, first)
    made = made.groupBy(*series, "__rg").applyInArrow(by_rows, second)
    made = made.groupBy(*series, "__cg").applyInArrow(back, last)
    made = made.select(*[F.col(k).alias(name) for k, name in zip(keys, names)], F.col("__s").alias("__p"),
                       F.col("y").alias("__y"))
    joined = ranked.join(made, _same_keys([*keys, "__s"], [*names, "__p"]))
    return joined.select(*[F.col("__y").cast(df.schema[c].dataType).alias(c) if c == value else F.col(c) for c in df.columns])
