"""Packing token ids into sequences of bounded size with little padding (operator 13).

Bounded-space best fit: each partition keeps a fixed number of open windows. A piece goes into the open
window it fills best; where none has the room, the fullest window is emitted and a new one opened. The
windows still open at the end of a partition are merged: laid end to end, some partitions at a time, and
cut at the window size, level by level, until one is left, which is cut at powers of two.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import small_batches, stored

#: Ids of a sequence, and open windows of a partition.
WINDOW, OPEN_WINDOWS = 1024, 64
#: The id after each document.
END = 0
#: Partitions, or groups of the level before, whose open windows one task merges.
FAN_IN = 32
#: Bytes of ids handed to Spark at a time.
_BATCH_BYTES = 1 << 21

PIECES = (
    "id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, source long, open boolean"
)


class Piece(NamedTuple):
    """Ids (little-endian, 32 bits) of a document from ``start`` on; ``doc_tokens`` counts all its ids."""

    id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def n(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * at]), self._replace(start=self.start + at, ids=self.ids[4 * at :])


class Encoder:
    """Ids of texts as bytes, by the vocabulary of a byte-level tokenizer file and the pattern of its pre-tokens.

    The file must list its merges in the order of the ids they make. Then the pair to merge next is the one
    whose merged token has the lowest id, which ``tiktoken`` does several times faster than ``tokenizers``.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        model = json.loads(Tokenizer.from_file(path).to_str())["model"]
        vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        if made != sorted(set(made)):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        used = {*made, *(id_ for token, id_ in vocabulary.items() if len(token) == 1)}
        ranks = {bytes(map(_BYTES.get, token)): id_ for token, id_ in vocabulary.items() if id_ in used}
        self._encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return self._encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


#: How byte-level vocabularies write bytes: printable ones as they are, the others from 256 on, in order.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTES = {chr(b): b for b in range(256)} | {chr(256 + n): b for n, b in enumerate(_UNPRINTED)}


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def pieces_of(id_: int | None, ids: bytes, size: int = WINDOW) -> Iterator[Piece]:
    """A document cut at every ``size`` ids."""
    for first in range(0, len(ids), 4 * size):
        yield Piece(id_, first // 4, ids[first : first + 4 * size], len(ids) // 4)


class Packer:
    """Best fit over at most ``windows`` open windows of ``size`` ids."""

    def __init__(self, size: int = WINDOW, windows: int = OPEN_WINDOWS):
        self.size, self.windows = size, windows
        self._spaces: list[tuple[int, int]] = []  # (room, number) of the open windows, sorted
        self._open: dict[int, list[Piece]] = {}
        self._opened = 0

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Windows that are emitted as ``piece`` comes in."""
        at = bisect_left(self._spaces, (piece.n, -1))
        if at < len(self._spaces):
            room, number = self._spaces.pop(at)
        else:
            if len(self._spaces) == self.windows:
                yield self._open.pop(self._spaces.pop(0)[1])
            room, number = self.size, self._opened
            self._open[number] = []
            self._opened += 1
        self._open[number].append(piece)
        room -= piece.n
        if room:
            insort(self._spaces, (room, number))
        else:
            yield self._open.pop(number)

    def left(self) -> Iterator[list[Piece]]:
        yield from self._open.values()


def merge_windows(windows: Iterable[list[Piece]], size: int, last: bool) -> Iterator[tuple[bool, list[Piece]]]:
    """(open, window) of windows laid end to end and cut at ``size``; the last one stays open, or is cut at
    powers of two."""
    window, room = [], size
    for piece in (piece for window in windows for piece in window):
        while piece.n > room:
            head, piece = piece.cut(room)
            yield False, [*window, head]
            window, room = [], size
        window.append(piece)
        room -= piece.n
        if not room:
            yield False, window
            window, room = [], size
    if not last:
        if window:
            yield True, window
        return
    while window:
        n = sum(piece.n for piece in window)
        part, room = [], 1 << (n.bit_length() - 1)
        while room:
            piece = window.pop(0)
            if piece.n > room:
                piece, rest = piece.cut(room)
                window.insert(0, rest)
            part.append(piece)
            room -= piece.n
        yield False, part


def _batches(windows: Iterable[tuple[bool, list[Piece]]], first_id: int, source: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECES``; sequences are numbered from ``first_id`` on."""
    schema = pa.schema([
        ("id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.int64()), ("open", pa.bool_()),
    ])
    rows, size = [], 0
    for number, (open_, window) in enumerate(windows, first_id):
        offset = 0
        for piece in window:
            rows.append((*piece, number, offset, source, open_))
            offset += piece.n
        size += 4 * offset
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    windows: int = OPEN_WINDOWS,
    end: int | None = END,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``id_column, start, ids, doc_tokens, sequence_id, offset``: one row per piece.

    A document is its token ids and ``end`` (none if None); ``ids`` holds those of the piece as unsigned
    little-endian 32-bit numbers, ``start`` counts the document's ids before it, ``doc_tokens`` all of them.
    The pieces of a sequence lie at ``offset`` without gaps, ``size`` ids at most. A document longer than
    ``size`` is cut there; others are cut only where the windows left open by the partitions are merged.
    ``sequence_id`` is unique, not consecutive.

    A null text is empty: it is ``end`` alone (without ``end`` it has no row). Rows that share an id stay
    apart, rows with a null id are packed too, further columns are ignored, and no rows give no rows. A
    task holds one text and ``windows`` open windows. ``path`` names a tokenizer file that every executor
    can open, ``pattern`` the pre-tokens it merges.
    """
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, task = encoder(path, pattern), Packer(size, windows), TaskContext.get().partitionId()

        def emitted() -> Iterator[tuple[bool, list[Piece]]]:
            for batch in batches:
                for id_, value in zip(batch.column(0), batch.column(1), strict=True):
                    for piece in pieces_of(id_.as_py(), coder.encode(value.as_py()) + tail, size):
                        yield from ((False, window) for window in packer.place(piece))
            yield from ((True, window) for window in packer.left())

        yield from _batches(emitted(), task << 32, task)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    packed = stored(small_batches(rows).mapInArrow(pack, PIECES), "packed")
    result, left, level = packed.filter("not open"), packed.filter("open"), 0
    groups = (left.agg(F.max("source")).first()[0] or 0) + 1
    while True:
        level, last = level + 1, groups <= fan_in
        merged = stored(_merged(left, size, fan_in, level, last), f"merged_{level}")
        result, left = result.unionByName(merged.filter("not open")), merged.filter("open")
        if last:
            break
        groups = -(-groups // fan_in)
    return result.select(F.col("id").alias(id_column), "start", "ids", "doc_tokens", "sequence_id", "offset")


def _merged(left: DataFrame, size: int, fan_in: int, level: int, last: bool) -> DataFrame:
    """The open windows of every ``fan_in`` sources merged by one task: a bounded number."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table, open_ = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]), {}
        columns = (table[c].to_pylist() for c in ("sequence_id", *Piece._fields))
        for sequence, *piece in zip(*columns, strict=True):
            open_.setdefault(sequence, []).append(Piece(*piece))
        merged = merge_windows(open_.values(), size, last)
        return pa.Table.from_batches(_batches(merged, (level << 56) + (group << 32), group))

    group = F.floor(F.col("source") / fan_in).alias("group")
    return left.groupBy(group).applyInArrow(merge, PIECES)
