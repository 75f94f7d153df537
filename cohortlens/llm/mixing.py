"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times.  The
whole part is taken as it is; the fraction is rounded by pivotal steps: two
documents with open fractions exchange words (fraction times size) at random,
unbiased, until one of the fractions is 0 or 1.  Each step keeps the pair's sum
of words, so a source misses its target by less than its last open document.

Distribution: the documents of a source are dealt into chunks by hash; a chunk
leaves one open document at most, and these residuals are combined level by
level, ``fan`` chunks at a time, until a source has one.  A source with a third
of all documents only has more chunks.  Only ids and sizes move, never texts.
The random numbers derive from the seed, source, level and chunk, so that
repeated runs agree.

Targets: the sources in order of their code points (NULL last) weigh
``weights``, repeating, and share the sum of all sizes; a target stops at
``most`` times its source's size, the excess is shared again by weight.

Edge cases: NULL text has size 0; a document of size 0 keeps the whole part of
its copies; NULL sources form a source; repeated rows are rounded one by one;
empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, stored, unused

WEIGHTS = (5, 2, 1)
MOST = 3
_ROW = "source string, chunk long, id long, content long, size long, base int, p double, open boolean"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, n, source_size, target) from rows (source, size).

    With the ratio cap / weight ascending, the level that remains after capping all
    sources before one is largest at the first that is not capped; every target is
    the smaller of its cap and that level times its weight."""
    each = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    each = each.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (
        (F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("double"))
    each = each.withColumn("cap", (F.col("source_size") * most).cast("double"))
    before = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    total = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    share = F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    each = each.withColumn("level", left / share).withColumn("level", F.max("level").over(total))
    return each.select("source", "n", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def pivotal(p: list[float], size: list[int], random) -> int:
    """Rounds the fractions ``p`` in place to 0 or 1 by exchanges of words between two
    documents; returns the index of the one that stays open, or -1."""
    eps, held = 1e-12, -1
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = size[held], size[i]
        up = min((1 - p[held]) * a, p[i] * b)          # words from the second to the first
        down = min(p[held] * a, (1 - p[i]) * b)
        move = up if random.random() * (up + down) < down else -down
        p[held] += move / a
        p[i] -= move / b
        first, second = (x <= eps or x >= 1 - eps for x in (p[held], p[i]))
        if first:
            p[held] = round(p[held])
        if second:
            p[i] = round(p[i])
        held = held if not first else i if not second else -1
    return held


def _round(level: int, seed: int, last: bool):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "id", "content"], ascending=[False, True, True], kind="stable", ignore_index=True)
        random = np.random.default_rng(xxhash.xxh64_intdigest(f"{level}:{key[1]}:{key[0]}".encode(), seed))
        p, size = rows["p"].tolist(), rows["size"].tolist()
        held = pivotal(p, size, random)
        rows["open"] = False
        if held >= 0:
            if last:
                p[held] = float(random.random() < p[held])
            else:
                rows.loc[held, "open"] = True
        rows["p"] = p
        return rows
    return run


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 7, chunk_rows: int = 4096, fan: int = 1024) -> DataFrame:
    """One row per row of ``df``: id, content (hash of the text), source, size (words),
    source_size, target (of its source), copies and taken (size times copies)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(df.select(F.col(source_col).alias("source"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("content"),
                            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")), "mix-rows")
    targets = stored(source_targets(rows, weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = F.col("source").eqNullSafe(F.col("t_source"))
    t = targets.withColumnRenamed("source", "t_source")
    chunks = F.ceil(F.col("n") / chunk_rows)
    work = rows.join(t, same).select(
        "source", F.pmod(F.xxhash64("id", "content", F.lit(seed)), chunks).alias("chunk"), "id", "content", "size",
        F.floor(rate).cast("int").alias("base"), (rate - F.floor(rate)).alias("p"))
    work = work.withColumn("open", (F.col("size") > 0) & (F.col("p") > 0))
    work = work.withColumn("p", F.when(F.col("open"), F.col("p")).otherwise(F.lit(0.0)))
    most_chunks = int(targets.agg(F.max(F.ceil(F.col("n") / chunk_rows))).first()[0] or 1)
    done, level = [work.where(~F.col("open"))], 0
    work = work.where("open")
    while True:
        after = stored(work.groupBy("source", "chunk").applyInPandas(_round(level, seed, most_chunks == 1), _ROW), f"mix-level{level}")
        done.append(after.where(~F.col("open")))
        if most_chunks == 1:
            break
        work = after.where("open").withColumn("chunk", F.floor(F.col("chunk") / fan))
        most_chunks, level = -(-most_chunks // fan), level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    copies = F.col("base") + F.col("p").cast("int")
    return result.join(t, same).select("id", "content", "source", "size", "source_size", "target",
                                       copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, all columns as they are.

    Rows equal in id and text share their copies: each has the sum divided by their number, and
    the first of them, in an order by all their columns, one of what is left."""
    mid, mcontent, copies, left, place = (unused(df, x) for x in ("mixed_id", "mixed_content", "copies", "left_over", "place"))
    each = mix(df, id_col, text_col, source_col, **options).groupBy(F.col("id").alias(mid), F.col("content").alias(mcontent)).agg(
        F.sum("copies").alias("sum"), F.count(F.lit(1)).alias("n"))
    each = each.where("sum > 0").select(mid, mcontent, F.expr("sum div n").cast("int").alias(copies), F.expr("sum % n").alias(left))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(mid)) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(mcontent))
    out = df.join(each.where(F.col(copies) > 0), same).withColumn(
        copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*df.columns)
    rest = each.where(F.col(left) > 0)
    if not rest.limit(1).count():
        return out
    order = W.partitionBy(mid, mcontent).orderBy(F.xxhash64(*df.columns))
    more = df.join(rest, same).withColumn(place, F.row_number().over(order)).where(F.col(place) <= F.col(left))
    return out.unionByName(more.select(*df.columns))
