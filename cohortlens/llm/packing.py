"""Packing documents into fixed-length sequences: shortest pack first over the
histogram of lengths.

1. Each map task tokenizes its documents, adds the end id and cuts them into
   pieces of at most ``longest`` ids; a piece gets its rank among the pieces of
   its length in the task.  The pieces are stored once, no row is shuffled.
2. The histogram has at most ``longest`` rows whatever the size of the corpus.
   Lengths are placed from the longest to the shortest, each into the packs with
   the fewest ids so far; when none has room, new packs are filled one after the
   other.  Packs with equal contents are one pattern with a count, so the work
   depends on the number of lengths, not of pieces.
3. A piece's rank over all tasks (its rank in the task plus the pieces of that
   length in earlier tasks) gives the pattern, the copy of the pattern and the
   slot that hold it.

Tokens are cached by part of a word for this tokenizer: its normalizer maps single
characters and runs of white space, its splitter never joins over white space and
cuts between letters and punctuation, so a text's ids are those of its parts, one
after the other (tested against whole texts).  Words with a letter that the
normalizer turns into letter and mark are not cut: the splitter joins a mark with
the punctuation behind it.  What a worker keeps is bounded (``_HELD``).

Edge cases: NULL and empty texts are one piece with the end id only; very long
texts give many full pieces; repeated rows are packed like any other; empty
tables give empty results.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import expand, small_batches, stored

LONGEST = 2048
END = 1
#: Parts of texts kept in a Python worker: some 100 MB.
_HELD = 400_000


def tokenizer_path(name: str = "word_bpe_49k.json", folder: str | None = None) -> str:
    """A vocabulary file of the public tokenizers: in ``folder``, else where their package says."""
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)


_PRINTABLE = bytes(range(33, 127)) + b"\n"
#: The parts that the tokenizer's splitter makes of lower-case words of printable ASCII, each with a line feed behind it.
_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\n]+|\n")
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


class _Letters(dict):
    """What a character is to the vocabulary's merges, or None unless its normalized form is all letters
    to the splitter.  (Of letters only Hangul jamo join with each other in NFC.)"""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def __missing__(self, character: str) -> str | None:
        form = self.tokenizer.normalizer.normalize_str(character)
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + form)
        alone = character.isalpha() and len(cut) == 1 and not unicodedata.name(character, "").startswith("HANGUL ")
        found = self[character] = cut[0][0][1:] if alone else None
        return found


def _lists(ids: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked ones of adjacent lists, one after the other, and their lengths."""
    starts, own = np.cumsum(lengths) - lengths, lengths[pick]
    return ids[expand(starts[pick], own)], own


class WordTokens:
    """The ids of texts, part by part.

    Arrow cuts the texts at white space and numbers their distinct words.  Only these are cut on,
    where the splitter cuts: between letters, digits and other signs of printable ASCII; words with
    other characters stay whole.  The ids of parts are kept, and when they are more than ``held`` (at some
    two hundred bytes each), those of the last words alone.  A part of letters goes to the vocabulary's
    merges directly, what is neither that nor signs through the whole tokenizer."""

    def __init__(self, path: str, held: int = _HELD):
        from tokenizers import Tokenizer
        self.tokenizer, self.held = Tokenizer.from_file(path), held
        self.merges = self.tokenizer.model
        self.letter = _Letters(self.tokenizer).__getitem__
        self.known, self.ids, self.lengths = {}, array("I"), array("I")

    def _plain(self, part: bytes) -> list[int]:
        return [t.id for t in self.merges.tokenize(part.decode())] if part != b"\n" else []

    def _other(self, word: bytes) -> list[int]:
        """A word with characters beyond printable ASCII, or with what may begin a special token."""
        text = word.decode("utf-8", "replace")
        if b"<|" not in word:
            core = word.strip(_SIGNS)
            letters = list(map(self.letter, core.decode("utf-8", "replace")))
            if None not in letters:
                at = word.index(core)
                return [t.id for x in (word[:at].decode(), "".join(letters), word[at + len(core):].decode()) if x
                        for t in self.merges.tokenize(x)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _parts(self, found: list[bytes], learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers, the ids one after the other and the number of ids of some parts."""
        new = list(filterfalse(self.known.__contains__, dict.fromkeys(found)))
        self.known.update(zip(new, count(len(self.lengths))))
        for part in new:
            ids = learn(part)
            self.ids.extend(ids)
            self.lengths.append(len(ids))
        numbers = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        return numbers, *_lists(*self._held(), numbers)

    def _held(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.ids, np.uint32), np.array(self.lengths, np.int64)

    def _keep(self, numbers: np.ndarray) -> None:
        """Only these parts stay."""
        numbers, parts = np.unique(numbers), list(self.known)
        ids, lengths = _lists(*self._held(), numbers)
        self.known = {parts[n]: i for i, n in enumerate(numbers.tolist())}
        self.ids, self.lengths = array("I", ids.tobytes()), array("I", lengths.astype(np.uint32).tobytes())

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word, one after the other, and how many each has."""
        plain = pc.string_is_ascii(words)
        text = b"\n".join(words.filter(plain).cast(pa.large_binary()).to_pylist())
        if b"<|" in text or text.translate(None, _PRINTABLE):
            plain = pc.and_not(pc.match_substring_regex(words, "^[!-~]*$"), pc.match_substring(words, "<|"))
            text = b"\n".join(words.filter(plain).cast(pa.large_binary()).to_pylist())
        other = words.filter(pc.invert(plain)).cast(pa.large_binary()).to_pylist()
        found = _PARTS.findall(text.lower() + b"\n") if len(other) < len(words) else []
        numbers, ids, own = self._parts(found, self._plain)
        between = numbers == self.known.get(b"\n", -1)
        rest, more, lengths = self._parts(other, self._other)
        if len(self.lengths) > self.held:
            self._keep(np.concatenate([numbers, rest]))
        lengths = np.concatenate([np.diff(np.cumsum(own)[between], prepend=0), lengths])
        place = np.empty(len(words), np.int64)                  # plain words first
        place[np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return _lists(np.concatenate([ids, more]), lengths, place)

    def encode(self, texts: pa.Array, end: int, together: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts (strings without nulls), each with ``end`` behind it, and the n + 1 text offsets."""
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        words = lists.flatten().dictionary_encode()
        found = [self._words(words.dictionary.slice(i, together)) for i in range(0, len(words.dictionary), together)]
        ids, lengths = (np.concatenate([x[k] for x in found] + [np.array([last], np.int64)]) for k, last in ((0, end), (1, 1)))
        numbers = np.insert(words.indices.to_numpy().astype(np.int64), offsets[1:], len(lengths) - 1)
        out, own = _lists(ids.astype(np.uint32), lengths, numbers)
        edges = np.concatenate([[0], np.cumsum(own)])
        return out, edges[offsets + np.arange(len(offsets))]


#: One for each vocabulary in a Python worker, so that later tasks find the words of earlier ones.
_IN_WORKER: dict[tuple[str, int], WordTokens] = {}


_PIECES = ("doc_id long, start long, length int, ids array<int>, ids_crc32 long, doc_tokens long, task int, place long")


def _pieces(path: str, longest: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if (path, end) not in _IN_WORKER:
            _IN_WORKER[path, end] = WordTokens(path)
        tokens, task = _IN_WORKER[path, end], TaskContext.get().partitionId()
        places = np.zeros(longest + 1, np.int64)
        for whole in batches:
            for batch in small_batches([whole], "text", 8 << 20):
                ids, edges = tokens.encode(batch.column("text"), end)
                total = np.diff(edges)
                n = -(-total // longest)
                doc = np.arange(len(total)).repeat(n)
                start = longest * expand(np.zeros(len(n)), n)
                length = np.minimum(total[doc] - start, longest)
                at = edges[:-1][doc] + start
                by = np.argsort(length, kind="stable")
                new = np.ones(len(by), bool)
                new[1:] = length[by][1:] != length[by][:-1]
                first = np.flatnonzero(new)
                run_length = np.diff(np.append(first, len(by)))
                place = np.empty(len(by), np.int64)
                place[by] = np.arange(len(by)) - first.repeat(run_length) + places[length[by]]
                places[length[by][first]] += run_length
                raw = memoryview(np.ascontiguousarray(ids, "<u4"))
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.view(np.int32))) \
                    if with_ids else pa.nulls(len(at), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int32()), lists,
                     pa.array(crc, pa.int64()), pa.array(total[doc], pa.int64()), pa.array(np.full(len(at), task), pa.int32()),
                     pa.array(place, pa.int64())],
                    ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "task", "place"])
    return run


def packing_patterns(histogram: dict[int, int], longest: int = LONGEST) -> list[tuple[int, list[int]]]:
    """(count, lengths) of the packs: shortest pack first, the longest lengths first."""
    packs: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)      # by the room left
    for length in sorted(histogram, reverse=True):
        waiting, room = histogram[length], longest
        while waiting:
            while room >= length and not packs.get(room):
                room -= 1
            if room < length:                                             # no pack has room: new ones, one after the other
                each = longest // length
                for count, pieces in ((waiting // each, each), (1, waiting % each)):
                    if count and pieces:
                        packs[longest - pieces * length].append((count, pieces * [length]))
                break
            if room == longest:
                room -= 1
                continue
            count, pack = packs[room].pop()
            taken = min(count, waiting)
            if taken < count:
                packs[room].append((count - taken, pack))
            packs[room - length].append((taken, pack + [length]))
            waiting -= taken
    return [p for room in sorted(packs) for p in packs[room]]


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset): pieces from that rank
    on lie in the sequences from that number on, at that offset."""
    out, used, sequence = defaultdict(list), defaultdict(int), 0
    for count, pack in patterns:
        offset = 0
        for length in pack:
            out[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def _placed(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length).tolist():
                own, rows = np.flatnonzero(length == value), places[value]
                row = np.searchsorted(rows[:, 0], rank[own], side="right") - 1
                sequence[own] = rows[row, 1] + rank[own] - rows[row, 0]
                offset[own] = rows[row, 2]
            names = batch.schema.names[:-2] + ["sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(batch.columns[:-2] + [pa.array(sequence), pa.array(offset)], names)
    return run


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, end: int = END,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (NULL unless ``with_ids``), ids_crc32,
    doc_tokens, sequence_id and offset."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = stored(rows.mapInArrow(_pieces(path, longest, end, with_ids), _PIECES), "pack-pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= longest rows
    places = slots(packing_patterns(histogram, longest))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = ["doc_id", "start", "length", *(["ids"] if with_ids else []), "ids_crc32", "doc_tokens"]
    # the counts grow with the tasks, so they are never broadcast; a key has at most the rows of its task
    found = pieces.join(before.hint("merge"), ["length", "task"]).select(*kept, "place", "before")
    schema = ", ".join(f"{c} {t}" for c, t in found.select(*kept).dtypes) + ", sequence_id long, offset long"
    return found.mapInArrow(_placed(places), schema.replace("bigint", "long"))
