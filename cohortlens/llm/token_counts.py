"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton over the vocabulary lists all pieces that end at each
character; dynamic programming carries the best score and the number of pieces
of the prefix, nothing else, so no path is kept or traced back.  Ties follow the
tokenizer: a later candidate replaces an earlier one only with a greater score,
and candidates come by their start, so of equal scores the longest last piece
wins.  A character that no single piece covers costs the lowest score less ten;
it counts its UTF-8 bytes if the vocabulary has byte pieces (byte fallback), else
a run of such characters counts one piece.

Words are split at white space (space, U+0009 to U+000D) and begin with U+2581 (added
unless it is there), as the tokenizer's word splitter gives them; pieces never reach over a word, so
the counts of a text are sums over its words and words seen lately are kept.

Edge cases: NULL, empty and blank texts have no pieces and score 0; very long
words take time and memory in proportion to their length; repeated rows are
counted one by one; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CACHE = 1_000_000
_START = "▁"
#: Entries below this score stand in the file but are not pieces to choose (runs of white space).
_UNUSED = -1e8


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a sentencepiece file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size()) if model.get_score(i) > _UNUSED]


class Counter:
    """Piece counts and best scores of words."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - 10.0
        names = {piece for piece, _ in vocabulary}
        self.fallback = all(f"<0x{b:02X}>" in names for b in range(256))
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best split of one word."""
        n = len(word)
        score, count, open_run = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, found in self.automaton.iter(word):
            ends[last + 1].append(found)
        for end in range(1, n + 1):
            best, from_start, single = -math.inf, -1, False
            for length, value in sorted(ends[end], reverse=True):       # by start: the longest piece first
                single = single or length == 1
                candidate = value + score[end - length]
                if candidate > best or from_start < 0:
                    best, from_start = candidate, end - length
            if from_start >= 0:
                count[end] = count[from_start] + 1
            if not single:
                candidate = self.unknown + score[end - 1]
                if from_start < 0 or candidate > best:
                    best, open_run[end] = candidate, True
                    if self.fallback:
                        count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        count[end] = count[end - 1] + (not open_run[end - 1])
            score[end] = best
        return count[n], score[n]

    def text(self, text: bytes) -> tuple[int, int, float]:
        """(words, pieces, score) of a text."""
        known, words = self.known, text.split()
        pieces, scores = 0, []
        for w in words:
            found = known.get(w)
            if found is None:
                if len(known) > _CACHE:
                    known.clear()
                word = w.decode("utf-8", "replace")
                found = known[w] = self.word(word if word.startswith(_START) else _START + word)
            pieces += found[0]
            scores.append(found[1])
        return len(words), pieces, math.fsum(scores)


#: The counter of the last vocabulary used in a Python worker, so that later tasks find the words of earlier ones.
_IN_WORKER: dict[int, Counter] = {}


def _count(vocabulary: list[tuple[str, float]]):
    key = hash(tuple(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _IN_WORKER:
            _IN_WORKER.clear()
            _IN_WORKER[key] = Counter(vocabulary)
        counter = _IN_WORKER[key]
        for batch in batches:
            rows = [counter.text(x.as_buffer().to_pybytes()) for x in batch.column(1)]
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64())))],
                ["doc_id", "n_words", "n_tokens", "score"])
    return run


def token_counts(df: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_tokens and the score of the best split."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    return rows.mapInArrow(_count(vocabulary), "doc_id long, n_words long, n_tokens long, score double")
