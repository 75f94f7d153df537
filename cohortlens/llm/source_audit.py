"""How far the sources of a language differ in their words.

Tokenizer: one ``bytes.translate`` lowers A-Z and blanks every separator, then
``bytes.split`` gives the terms and a Counter per document their counts.  A task adds
them up per (language, source, term) and hands on what it holds whenever that is
``held`` entries, so a hot source or a frequent term is combined before the exchange.

Each language keeps the terms in at least ``least_documents`` of its documents.  A
term's share within a group is smoothed and scaled to a whole number,
``p = 1 + floor(scale * (count + 5) / (N + 5 V))``, in exact decimal arithmetic, as
is all that follows.

* Parts ``term``: per source the kept terms it uses more than its language as a whole,
  the first ``top``; a group limit runs before the exchange.
* Parts ``pair``: per pair of sources the sum of ``|p - q|`` over all kept terms.  A term
  that neither source has adds the same ``|p0 - q0|`` every time, so only the terms
  with a count are visited, and the rest is one product.  Sources are numbered and tiled
  (``tile``), the terms of a language dealt into blocks (``block_terms``): a task holds
  the counts of two tiles of sources in one block, fills small dense matrices of a few
  terms at a time, and returns one sum for each pair of the two tiles.  No task sees a
  whole language, and what a task holds is bounded by the two sizes.

Edge cases: NULL text, language and source are empty strings.  A group without terms has
all counts 0; a language without kept terms gives pairs with value 0 and no terms.
A language with one source has no pairs.  Repeated rows are documents of their own.  Equal
values rank by the item's UTF-8 bytes.  A very long text is one value in one task.
Further columns, whatever their names, are not read; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

#: Letters and everything beyond ASCII stay, A-Z lowered; the rest is a separator.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _emit(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "documents"]
    for (lang, source), (counts, documents) in groups.items():
        found = list(counts)
        # a group without terms leaves a row without term, so that it is known
        columns = [found or [None], [counts[t] for t in found] or [0], [documents[t] for t in found] or [0]]
        size = len(columns[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
             pa.array(columns[0], pa.binary()).cast(pa.string()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int64())], names)


def _count(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, size = {}, 0
        for batch in small_batches(batches, "bytes"):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "bytes"))):
                found = terms(text)
                own = Counter(found)
                if (lang, source) not in groups:
                    groups[lang, source] = (Counter(), Counter())
                    size += 1
                counts, documents = groups[lang, source]
                size -= len(counts)
                counts.update(found)            # counted in C, where adding up a Counter is a Python loop
                documents.update(own.keys())
                size += len(counts)
                if size > held:
                    yield from _emit(groups)
                    groups, size = {}, 0
        yield from _emit(groups)
    return run


def term_counts(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                held: int = 500_000) -> DataFrame:
    """lang, source, term, n (occurrences), documents; a row without term for groups that have none."""
    rows = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    counted = rows.mapInArrow(_count(held), "lang string, source string, term string, n long, documents long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(count: Column, total: Column, kept: Column, scale: int = 1_000_000_000) -> Column:
    """1 + floor(scale * (count + 5) / (total + 5 kept)); 1 + scale * 5 stands above nothing if no term is kept."""
    above = F.lit(scale).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 5)
    below = (total.cast("decimal(20,0)") + 5 * kept.cast("decimal(20,0)")).cast("decimal(24,0)")
    whole = F.call_function("div", above, F.when(kept > 0, below))
    return (whole + 1).cast("long")


def _tile_sums(tile: int, cells: int = 1 << 20):
    """Per pair (s < o) of two tiles of sources the sum of |p - q| - |p0 - q0| over one block of terms.

    Rows without term give the sources and their p0, the share of a term with count 0."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, first, second = (k.as_py() for k in key[:3])
        term = pc.dictionary_encode(table.column("term").combine_chunks())
        index, p = (table.column(c).to_numpy() for c in ("index", "p"))
        head = term.indices.is_null().to_numpy(zero_copy_only=False)
        by = np.argsort(index[head])
        sources, base = index[head][by], p[head][by]
        code = term.indices.filter(pa.array(~head)).to_numpy().astype(np.int64)
        by = np.argsort(code, kind="stable")
        code, row, p = code[by], np.searchsorted(sources, index[~head])[by], p[~head][by]
        sums = np.zeros((len(sources), len(sources)), np.int64)
        width = max(1, cells // max(1, len(sources)))
        for start in range(0, len(term.dictionary), width):
            a, b = np.searchsorted(code, [start, start + width])
            dense = np.repeat(base[:, None], min(width, len(term.dictionary) - start), axis=1)
            dense[row[a:b], code[a:b] - start] = p[a:b]
            for s in range(len(sources) - 1):
                sums[s, s + 1:] += np.abs(dense[s + 1:] - dense[s]).sum(axis=1) - dense.shape[1] * np.abs(base[s + 1:] - base[s])
        s, o = np.triu_indices(len(sources), 1)
        if first != second:                     # pairs within one tile belong to the task of that tile alone
            across = sources[s] // tile != sources[o] // tile
            s, o = s[across], o[across]
        return pa.table({"lang": pa.array([lang] * len(s), pa.string()), "s": pa.array(sources[s], pa.int64()),
                         "o": pa.array(sources[o], pa.int64()), "extra": pa.array(sums[s, o], pa.int64())})
    return run


def pair_sums(shared: DataFrame, groups: DataFrame, tile: int, block_terms: int) -> DataFrame:
    """lang, s, o, extra for all sources s < o (by index) of a language."""
    tiles = groups.groupBy("lang").agg((F.floor(F.max("index") / tile) + 1).alias("tiles"),
                                       F.greatest(F.lit(1), F.ceil(F.max("v") / block_terms)).alias("blocks"))
    own = F.floor(F.col("index") / tile)

    def dealt(rows: DataFrame, block: Column) -> DataFrame:
        """Each row once for every pair of tiles that its source is in."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
        return rows.join(tiles, "lang").withColumn("block", block).withColumn("other", other).select(
            "lang", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "block", "index", "term", "p")
    words = dealt(shared.select("lang", "index", "term", "p"), F.pmod(F.xxhash64("term"), F.col("blocks")))
    heads = dealt(groups.select("lang", "index", F.lit(None).cast("string").alias("term"), F.coalesce("p0", F.lit(0)).alias("p")),
                  F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sums = words.unionByName(heads).groupBy("lang", "first", "second", "block").applyInArrow(
        _tile_sums(tile), "lang string, s long, o long, extra long")
    return sums.groupBy("lang", "s", "o").agg(F.sum("extra").alias("extra"))


def source_divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      least_documents: int = 30, top: int = 50, tile: int = 128, block_terms: int = 1024,
                      held: int = 500_000) -> DataFrame:
    """lang, source, part, item, value, rank as in the module's text."""
    counted = stored(term_counts(df, lang_col, source_col, text_col, held), "audit-terms")
    found = counted.where("term is not null")
    vocabulary = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents")).where(
        F.col("documents") >= least_documents).select("lang", "term", "lang_n")
    vocabulary = stored(vocabulary, "audit-vocabulary")
    kept = stored(found.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "audit-kept")

    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    groups = groups.withColumn("p0", share(F.lit(0), F.col("total"), F.col("v")))
    groups = stored(groups.withColumn("index", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1),
                    "audit-groups")

    shared = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    more = shared.withColumn("value", F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)

    ends = [groups.select("lang", F.col("index").alias(k), F.col("source").alias(f"source_{k}"), F.col("p0").alias(f"p0_{k}"), *more)
            for k, more in (("s", ["v"]), ("o", []))]
    pairs = pair_sums(shared, groups, tile, block_terms).join(ends[0], ["lang", "s"]).join(ends[1], ["lang", "o"])
    value = F.col("extra") + F.coalesce(F.col("v") * F.abs(F.col("p0_s") - F.col("p0_o")), F.lit(0))
    sides = F.explode(F.array(*(F.struct(F.col(f"source_{a}").alias("source"), F.col(f"source_{b}").alias("item")) for a, b in ("so", "os"))))
    of_pairs = pairs.select("lang", value.alias("value"), sides.alias("x")).select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(order))
    return of_pairs.unionByName(of_terms)
