"""Chat formatting by columnar byte assembly.

The rows of a conversation are brought together by one exchange and sorted by
turn.  A batch of whole conversations is then assembled at once: numpy computes
the length of every segment (header, escaped text, footer), their offsets are
cumulative sums, and headers, texts and footers are scattered into one
preallocated buffer that becomes the Arrow string column; there is no
concatenation per turn.

Template: ``<turn>role\\n`` text ``</turn>\\n``.  Texts (and roles) are escaped
reversibly: a backslash is doubled, ``<turn>`` becomes ``\\o`` and ``</turn>``
``\\c``, a line feed in a role ``\\n``; so the control strings of the output are
those of the template.  The loss spans are the byte ranges of assistant texts.

A conversation is one output value, like a document; conversations are spread
by id.  Edge cases: NULL text and role are empty; turns with the same number are
ordered by role and text; rows with a NULL conversation id are one conversation;
NULL turns come first; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, expand

_OPEN, _CLOSE = "<turn>", "</turn>"
_BACK = {b"\\\\": b"\\", b"\\o": b"<turn>", b"\\c": b"</turn>", b"\\n": b"\n"}
_ESCAPED = re.compile(rb"\\.", re.DOTALL)


def escape(texts: pa.Array) -> pa.Array:
    for old, new in (("\\", "\\\\"), (_OPEN, "\\o"), (_CLOSE, "\\c")):
        texts = pc.replace_substring(texts, old, new)
    return texts


def unescape(text: bytes) -> bytes:
    return _ESCAPED.sub(lambda m: _BACK[m[0]], text) if b"\\" in text else text


def assemble(conv: pa.Array, first: np.ndarray, roles: pa.Array, texts: pa.Array, trained: str) -> pa.RecordBatch:
    """Conversations from their rows; ``first`` has the first row of each and the number of rows at its end."""
    n = len(roles)
    named = roles.dictionary_encode()
    heads = pc.binary_join_element_wise(_OPEN, pc.replace_substring(escape(named.dictionary), "\n", "\\n"), "\n", "")
    head, head_edges = buffer_of(heads.take(named.indices))
    body, body_edges = buffer_of(escape(texts))
    foot = np.frombuffer(f"{_CLOSE}\n".encode(), np.uint8)
    lengths = np.column_stack([np.diff(head_edges), np.diff(body_edges), np.full(n, len(foot), np.int64)])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    starts = edges[:-1].reshape(n, 3)
    out = np.empty(edges[-1], np.uint8)
    out[expand(starts[:, 0], lengths[:, 0])] = head
    out[expand(starts[:, 1], lengths[:, 1])] = body
    out[expand(starts[:, 2], lengths[:, 2])] = np.tile(foot, n)
    begin = np.append(starts[:, 0], edges[-1])[first]
    formatted = pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(out)])
    loss = np.flatnonzero(pc.equal(roles, trained).to_numpy(zero_copy_only=False))
    of = np.searchsorted(first, loss, side="right") - 1
    low = starts[loss, 1] - begin[of]
    lists = np.searchsorted(of, np.arange(len(first)))
    spans = [pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(x, pa.int64())) for x in (low, low + lengths[loss, 1])]
    return pa.RecordBatch.from_arrays([conv, formatted, *spans, pa.array(np.diff(first), pa.int64())],
                                      ["conv_id", "formatted", "loss_starts", "loss_ends", "n_turns"])


def _format(trained: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            conv, roles, texts = (rows.column(i).combine_chunks() for i in range(3))
            new = np.ones(len(conv), bool)
            same = pc.fill_null(pc.equal(conv[1:], conv[:-1]), False).to_numpy(zero_copy_only=False)
            nulls = conv.is_null().to_numpy(zero_copy_only=False)
            new[1:] = ~(same | (nulls[1:] & nulls[:-1]))
            first = np.flatnonzero(new)
            return assemble(conv.take(pa.array(first)), np.append(first, len(conv)), roles, texts.cast(pa.large_string()), trained)

        rest = []
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0)
            last = conv[len(conv) - 1]
            # rows of the last conversation wait for the next batch
            at = len(conv)
            while at and (conv[at - 1] == last if last.is_valid else not conv[at - 1].is_valid):
                at -= 1
            if at:
                whole = pa.Table.from_batches([*rest, batch.slice(0, at)])
                yield done(whole)
                rest = []
            elif rest and rest[-1].column(0)[len(rest[-1]) - 1] != last:
                yield done(pa.Table.from_batches(rest))
                rest = []
            rest.append(batch.slice(at))
        if rest:
            yield done(pa.Table.from_batches(rest))
    return run


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_starts and loss_ends (byte ranges of
    the texts of role ``trained`` in ``formatted``) and n_turns."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(
        _format(trained), "conv_id long, formatted string, loss_starts array<long>, loss_ends array<long>, n_turns long")


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn, read back."""
    turns = []
    for part in formatted.split(f"{_CLOSE}\n".encode())[:-1]:
        role, _, text = part.removeprefix(_OPEN.encode()).partition(b"\n")
        turns.append((unescape(role), unescape(text)))
    return turns


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for formatted, starts, ends in zip(*batch.columns[1:4]):
            raw = formatted.as_buffer().to_pybytes()
            turns = parse(raw)
            said = b"".join(role + b"\n" + text + b"\n" for role, text in turns)
            loss = b"".join(unescape(raw[a:b]) for a, b in zip(starts.as_py(), ends.as_py()))
            rows.append((len(turns), hashlib.sha256(said).hexdigest(), len(loss.decode()), hashlib.sha256(loss).hexdigest(), len(raw.decode())))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are parsed again."""
    return formatted.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
