"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Base rules reject short texts and texts that repeat themselves.  Further rules
compare a feature with a cutoff.  Cutoffs are chosen on labelled documents, per
stratum: a cutoff may be used only if the false rejections among the good
documents of the stratum show, by an exact binomial test, that the rate is below
``risk`` (shared evenly by the rules); the level ``delta`` is divided by the
number of all (stratum, rule, cutoff) tests, so that all choices hold together
with probability 1 - delta (Bonferroni).  Rows with the same text in a stratum count
once, as the bound takes observations as independent; near copies count each, so where many
labelled documents are near copies the bound is too hopeful.  Of the cutoffs that pass, a rule takes
the strictest; without one (few labels) it rejects nothing.

The features of a text are computed inside its row; nothing is exploded or
shuffled.  They are stored once (numbers only) and used for the thresholds and
the verdicts.

Edge cases: NULL text has no words and fails; a NULL stratum is a stratum of its
own; documents without labels, NULL labels and NULL ids do not take part in the
choice; empty tables give empty results and no cutoffs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


class Rule(NamedTuple):
    """Rejects where sign * feature > sign * cutoff; cutoffs from the strictest to the mildest."""
    name: str
    sign: int
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbol_share", 1, (0.02, 0.05, 0.1, 0.2, 0.4)),
    Rule("dup_line_share", 1, (0.1, 0.2, 0.3, 0.5)),
    Rule("repeat_share", 1, (0.05, 0.1, 0.2, 0.35)),
    Rule("mean_word", 1, (8.0, 10.0, 12.0, 16.0)),
    Rule("mean_word", -1, (3.5, 3.0, 2.5, 2.0)),
)


def repeat_words(words: Column) -> Column:
    """How many words of an array lie in a window of three that occurs twice or more.

    Windows are sorted by a 64-bit hash; neighbours with equal hashes are the same
    only if their words are.  Arrays used twice are bound as lambda variables, so that they are
    computed once."""
    def bound(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def window(i: Column) -> Column:
        a, b, c = (F.get(words, i + k) for k in range(3))
        return F.xxhash64(a, b, c)

    def covered(hashes: Column) -> Column:
        indexed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(x: Column, y: Column) -> Column:
            equal = [F.get(words, x["i"] + k) == F.get(words, y["i"] + k) for k in range(3)]
            return (x["h"] == y["h"]) & equal[0] & equal[1] & equal[2]

        def starts(s: Column) -> Column:
            return F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        ordered = F.sort_array(F.transform(bound(indexed, starts), lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(ordered, zero, lambda acc, i: F.struct(
            (i + 3).alias("end"), (acc["n"] + 3 - F.greatest(acc["end"] - i, F.lit(0))).alias("n")))["n"]

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(bound(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """id, content (hash of the text), stratum, the counts and base_failed of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = F.translate(text, _SPACES[1:], " " * (len(_SPACES) - 1))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(_SPACES))) > 0)
    first = df.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("content"), F.col(stratum_col).cast("string").alias("stratum"),
        F.array_remove(F.split(plain, " "), "").alias("words"), lines.alias("lines"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"))
    second = first.select(
        "id", "content", "stratum", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))
    return second.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _shares() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "mean_word": share("word_chars", "n_words")}


def _rejects(rule: Rule, cutoff: Column) -> Column:
    return rule.sign * _shares()[rule.name] > rule.sign * cutoff


def below_risk(k: Column, n: Column, risk: float, level: Column) -> Column:
    """Whether at most k of n false rejections rule out a rate of ``risk`` or more: the
    binomial probability of k or fewer at that rate is at most the level (equivalently, the
    exact upper confidence bound is at most ``risk``).  Summed in logarithms."""
    odds = F.lit(risk / (1 - risk))
    zero = F.struct((n * F.log1p(F.lit(-risk))).alias("term"), (n * F.log1p(F.lit(-risk))).alias("total"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))
    # beyond the expected count the probability is far above any level in use
    return F.when((n > 0) & (k < n * risk), F.aggregate(terms, zero, add)["total"] <= F.log(level)).otherwise(F.lit(False))


def cutoffs(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", rules: Sequence[Rule] = RULES,
            risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Per stratum one column for each rule: its cutoff, or NULL where no cutoff passes."""
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).distinct()
    # copies of a text are one observation: the bound takes the rows as independent
    held = rows.where(~F.col("base_failed")).join(good, "id").dropDuplicates(["stratum", "content"])
    counts = [F.sum(_rejects(r, F.lit(c)).cast("long")).alias(f"k{i}_{j}")
              for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs)]
    each = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *counts)
    each = stored(each, "quality-strata")
    level = F.lit(delta / max(1, each.count() * sum(len(r.cutoffs) for r in rules)))
    return each.select(F.col("stratum").alias("of_stratum"), *(
        F.coalesce(*(F.when(below_risk(F.col(f"k{i}_{j}"), F.col("n"), risk / len(rules), level), F.lit(c))
                     for j, c in enumerate(r.cutoffs))).alias(f"cutoff{i}") for i, r in enumerate(rules)))


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
            label_col: str = "quality", rules: Sequence[Rule] = RULES, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """One row per row of ``df``: id, content, the counts, base_failed and kept."""
    rows = stored(features(df, id_col, text_col, stratum_col), "quality-features")
    chosen = cutoffs(rows, labels, id_col, label_col, rules, risk, delta)
    judged = rows.join(chosen, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
    failed = F.col("base_failed")
    for i, rule in enumerate(rules):
        failed = failed | F.coalesce(_rejects(rule, F.col(f"cutoff{i}")), F.lit(False))
    return judged.select("id", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~failed).alias("kept"))


def quality_documents(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that the rules keep, all columns as they are."""
    rid, rcontent = (unused(df, x) for x in ("rejected_id", "rejected_content"))
    out = quality(df, labels, id_col, text_col, **options).where(~F.col("kept")).select(
        F.col("id").alias(rid), F.col("content").alias(rcontent))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(rid)) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(rcontent))
    return df.join(out, same, "left_anti")
