"""Byte-level BPE over overlapping chunks (operator 7).

A long text is cut into overlapping chunks that are pre-tokenised in parallel. A pre-token depends only
on the text from its start on, so two neighbouring chunks agree from the first boundary that both have in
their overlap; there they are stitched. Where an overlap holds no such boundary (one pre-token longer
than the overlap) the text is pre-tokenised on from the last sure boundary until it meets one of the
next chunk. The pieces are then encoded, and decoding concatenates the raw bytes of the tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from itertools import accumulate, chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import map_batches

#: Code points a chunk advances by, and those it shares with the next one.
STRIDE, OVERLAP = 32_768, 512
#: Pieces whose ids are remembered by a worker.
REMEMBERED = 200_000


class _Ids(dict):
    """Token ids by piece, filled as pieces come."""

    def __init__(self, merge):
        super().__init__()
        self._merge = merge

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = tuple(self._merge(piece))
        if len(piece) <= 64:
            self[piece] = found
        return found


class Codec:
    """Ranks of a file in the tiktoken format, and the pattern that splits a text before the merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._bytes = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self._bytes[rank] = token
        self._digits = [str(rank) for rank in range(len(self._bytes))]
        self.pattern = regex.compile(pattern)
        merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self._ids = _Ids(merge._encode_single_piece)

    def ends(self, text: str) -> list[int]:
        """Ends of the pre-tokens of ``text``."""
        return list(accumulate(map(len, self.pieces(text))))

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: Sequence[str]) -> list[int]:
        if len(self._ids) > REMEMBERED:
            self._ids.clear()
        return list(chain.from_iterable(map(self._ids.__getitem__, pieces)))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))

    def digits(self, ids: Sequence[int]) -> str:
        """Decimal ids joined by a space."""
        return " ".join(map(self._digits.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def stitch(codec_: Codec, chunks: Sequence[tuple[int, str, Sequence[int]]]) -> list[str]:
    """Pre-tokens of the whole text from its chunks (offset, text, ends relative to the chunk), in order.

    The last two pre-tokens of a chunk are never trusted, but in the last chunk: the last may end early, and a
    contraction that is cut after its first letter (``'r|e``) is split in two.
    """
    text = chunks[0][1]
    for (at, part, _), (before, previous, _) in zip(chunks[1:], chunks, strict=False):
        text += part[before + len(previous) - at :]
    sure, done = [], 0  # ends that are right; the last of them
    for number, (offset, part, ends) in enumerate(chunks):
        final = number == len(chunks) - 1
        own = [offset + end for end in (ends if final else ends[:-2])]
        starts = {offset, *own} if number == 0 else set(own)
        limit = own[-1] if own else offset
        while done not in starts and done < (len(text) if final else limit):  # not in step yet: go on from here
            match = codec_.pattern.match(text, done)
            done = match.end()
            sure.append(done)
        if done in starts:
            sure.extend(end for end in own if end > done)
            done = sure[-1] if sure else 0
    pieces, start = [], 0
    for end in sure:
        pieces.append(text[start:end])
        start = end
    return pieces


def tokenize(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text: str = "text",
    stride: int = STRIDE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id_column, ids, n_tokens, ids_sha256, decoded_sha256`` of the whole text of every row.

    ``ids_sha256`` is of the decimal ids joined by a space, ``decoded_sha256`` of the bytes that decoding
    the ids gives. A null text is empty, with no id. Rows that share an id stay apart, rows with a null id
    are kept, further columns are ignored. ``path`` names a rank file that every executor can open. A text
    of one chunk is encoded where it is; only the chunks of longer ones are shuffled.
    """

    def encoded(ids_of_rows: list, pieces_of_rows: Iterable[Sequence[str]]) -> pa.RecordBatch:
        c, out = codec(path, pattern), ([], [], [], [])
        for pieces in pieces_of_rows:
            ids = c.encode_pieces(pieces)
            digests = hashlib.sha256(c.digits(ids).encode()), hashlib.sha256(c.decode(ids))
            for column, value in zip(out, (ids, len(ids), *(d.hexdigest() for d in digests)), strict=True):
                column.append(value)
        kinds = pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string()
        arrays = [pa.array(ids_of_rows, pa.int64()), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        yield encoded(batch.column(0).to_pylist(), (c.pieces(t.as_py()) for t in batch.column(1)))

    def chunked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        ends = [c.ends(t.as_py()) for t in batch.column("part")]
        yield batch.append_column("ends", pa.array(ends, pa.list_(pa.int32())))

    def stitched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for id_, chunks in zip(batch.column(0), batch.column(1), strict=True):
            parts = [(x["at"].as_py(), x["part"].as_py(), x["ends"].values.to_numpy().tolist()) for x in chunks]
            yield encoded([id_.as_py()], [stitch(c, parts)])

    schema = "id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    long = F.char_length("text") > stride + overlap
    short = map_batches(rows.filter(~long), whole, schema)
    numbered = rows.filter(long).withColumn("row", F.monotonically_increasing_id())
    cut = numbered.select(
        "id",
        "row",
        F.explode(F.sequence(F.lit(0), F.char_length("text") - 1, F.lit(stride))).alias("at"),
        "text",
    )
    cut = cut.select("id", "row", "at", F.expr(f"substr(text, at + 1, {stride + overlap})").alias("part"))
    parts = map_batches(
        cut.repartition("row", "at"), chunked, "id long, row long, at int, part string, ends array<int>"
    )
    grouped = parts.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("at", "part", "ends"))).alias("chunks"))
    stitched_rows = map_batches(grouped.select("id", "chunks"), stitched, schema)
    return short.unionByName(stitched_rows).withColumnRenamed("id", id_column)
