"""Benchmark decontamination by SimHash of item-sized windows (operator 2).

Windows of about the length of each benchmark item slide over every document. A window lies on a stride,
and an item is fingerprinted at all its offsets, so each whole occurrence of an item holds a window that
equals one of the item's, and so does each run of 0.8 of an item. A 64-bit fingerprint is cut into four blocks of 16 bits: of two fingerprints
within 4 r + 3 bits some block differs in at most r, so tables of all blocks within r bits of an item's
find every pair in the radius. The weighted (multiset) Jaccard similarity of word shingles then decides, over
passages of any length around the windows: one that reaches 0.8 has 0.8 to 1.25 of the item's length.

Such a passage holds at least 0.8 of an item's shingles. Windows are therefore laid only over stretches with that
many shingles of the benchmark, which a hash table of all of them tells; nothing is lost by it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, hashed_words, map_batches, shingled, stored, text_blocks

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Bits by which one of four blocks may differ; the radius is 4 * BLOCK_BITS + 3.
BLOCK_BITS = 2
#: Bytes of benchmark text sent to all tasks at a time; a larger benchmark is searched slice by slice.
SLICE_BYTES = 4 << 20
#: Shingles whose windows are hashed together: 64 bytes each, to stay in the processor's cache.
_WINDOW_BLOCK = 1 << 15
_LEAKS = "array<struct<item_id:bigint,similarity:double,first_word:bigint>>"


def stride_of(window: int) -> int:
    return window // 6 + 1


def window_sizes(longest: int) -> list[int]:
    """Sizes in shingles, each about a tenth larger than the last."""
    sizes = [1]
    while sizes[-1] < longest:
        sizes.append(max(sizes[-1] + 1, sizes[-1] * 11 // 10))
    return sizes


def window_prints(hashes: np.ndarray, size: int, stride: int) -> np.ndarray:
    """SimHash fingerprints of the windows of ``size`` hashes that begin at multiples of ``stride``."""
    return _prints(_running_bits(hashes, size), size, stride, len(hashes))


def _running_bits(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Running counts of each bit. They may wrap around: differences over a window do not."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    kind = np.uint8 if longest < 256 else np.int32
    running = np.zeros((len(hashes) + 1, 64), dtype=kind)
    np.cumsum(bits, axis=0, dtype=kind, out=running[1:])
    return running


def _prints(running: np.ndarray, size: int, stride: int, n: int) -> np.ndarray:
    count = running[size::stride] - running[: n - size + 1 : stride]
    return np.packbits(count > size // 2, axis=1).view(np.uint64).ravel()


@dataclass
class _Size:
    """Everything about the items of one window size."""

    size: int
    prints: np.ndarray  # fingerprints of the windows of its items
    item: np.ndarray  # whose they are
    offset: np.ndarray  # where they begin
    tables: np.ndarray  # four tables of the blocks within reach of any fingerprint


@dataclass
class Benchmark:
    ids: list[int | None]
    hashes: list[np.ndarray]  # the shingles of each item
    sizes: list[_Size]
    k: int
    slots: np.ndarray  # hash table: whether a shingle of any item may have these low bits
    shingles: np.ndarray  # the shingles of all items, sorted
    least: int  # shingles of the benchmark that the shortest passage holds
    reach: int  # how far a passage goes beyond one of them

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Indices of the shingles that are in any item."""
        at = np.flatnonzero(self.slots[h & np.uint64(len(self.slots) - 1)])
        place = np.minimum(np.searchsorted(self.shingles, h[at]), len(self.shingles) - 1)
        return at[self.shingles[place] == h[at]]


def build_benchmark(
    ids: list, texts: list[str], k: int = SHINGLE_WORDS, block_bits: int = BLOCK_BITS, similarity: float = SIMILARITY
) -> Benchmark:
    """Windows of all items of at least ``k`` words."""
    items: list[np.ndarray] = []
    for text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        h, _, _ = shingled(hashed_words(data, np.array([0, len(data)])), k)
        items.append(h)
    flips = [0] + [sum(1 << b for b in c) for w in range(1, block_bits + 1) for c in combinations(range(16), w)]
    flips = np.array(flips, dtype=np.uint16)
    by_size: dict[int, list[int]] = {}
    ladder = window_sizes(max(map(len, items), default=0))
    for number, h in enumerate(items):
        if len(h):
            run = max(1, int(len(h) * similarity))
            by_size.setdefault(max(w for w in ladder if w + stride_of(w) - 1 <= run), []).append(number)
    sizes = []
    for size, numbers in sorted(by_size.items()):
        prints = [window_prints(items[i], size, 1) for i in numbers]
        item = np.repeat(numbers, list(map(len, prints)))
        offset = np.concatenate([np.arange(len(p)) for p in prints])
        prints = np.concatenate(prints)
        tables = np.zeros((4, 1 << 16), dtype=bool)
        for table, block in zip(tables, prints.view(np.uint16).reshape(-1, 4).T, strict=True):
            table[(block[:, None] ^ flips).ravel()] = True
        sizes.append(_Size(size, prints, item, offset, tables))
    lengths = [len(h) for h in items if len(h)]
    shingles = np.unique(np.concatenate(items)) if lengths else np.zeros(0, np.uint64)
    slots = np.zeros(1 << max(10, min(26, (16 * len(shingles)).bit_length())), dtype=bool)
    slots[shingles & np.uint64(len(slots) - 1)] = True
    least = int(np.ceil(similarity * min(lengths, default=0) - 1e-9))
    reach = int(max(lengths, default=0) / similarity) + 1
    return Benchmark(ids, items, sizes, k, slots, shingles, max(1, least), reach)


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of smaller counts by sum of larger counts."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def _stretches(h: np.ndarray, doc: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the shingles within reach of enough shingles of the benchmark, and the stretch each lies in."""
    at = bench.holds(h)
    first = np.maximum(at - bench.reach, np.searchsorted(doc, doc[at]))
    last = np.minimum(at + bench.reach + 1, np.searchsorted(doc, doc[at], "right"))
    new = np.append(True, first[1:] >= last[:-1])[: len(at)]
    number = np.cumsum(new) - 1
    enough = np.bincount(number) >= bench.least if len(at) else np.zeros(0, bool)
    begin, end = first[new][enough], last[np.append(new[1:], True)[: len(at)]][enough]
    length = end - begin
    index = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return index, np.repeat(np.arange(len(length)), length)


def _candidates(h: np.ndarray, doc: np.ndarray, bench: Benchmark, radius: int) -> set[tuple[int, int, int]]:
    """(text, item, index of the shingle the item would begin at) of windows within the radius."""
    found: set[tuple[int, int, int]] = set()
    longest = max(map(len, bench.hashes))
    place, stretch = _stretches(h, doc, bench)
    near_by = h[place]
    for first in range(0, len(near_by), _WINDOW_BLOCK):
        part = near_by[first : first + _WINDOW_BLOCK + longest]
        running = _running_bits(part, longest)
        for s in bench.sizes:
            if s.size > len(part):
                continue
            stride = stride_of(s.size)
            prints = _prints(running, s.size, stride, len(part))
            blocks = prints.view(np.uint16).reshape(-1, 4)
            near = s.tables[0][blocks[:, 0]]
            for b in (1, 2, 3):
                near |= s.tables[b][blocks[:, b]]
            at = np.flatnonzero(near)
            for lot in range(0, len(at), 4096):
                w, q = np.nonzero(np.bitwise_count(prints[at[lot : lot + 4096], None] ^ s.prints) <= radius)
                begin = first + at[lot + w] * stride
                inside = stretch[begin] == stretch[np.minimum(begin + s.size - 1, len(stretch) - 1)]
                begin, q = place[begin[inside]], q[inside]
                hits = doc[begin], s.item[q], begin - s.offset[q]
                found.update(zip(*(x.tolist() for x in hits), strict=True))
    return found


def best_passage(h: np.ndarray, item: Counter, similarity: float) -> tuple[float, int] | None:
    """Highest similarity of a passage of ``h`` to the item and where it begins, if it reaches ``similarity``.

    Shingles that are not in the item never stand at the ends of the best passage, and a passage that
    reaches the similarity has at most 1 / similarity times the item's shingles.
    """
    size, values = sum(item.values()), h.tolist()
    longest, least = int(size / similarity + 1e-9), similarity * size - 1e-9
    own = [i for i, value in enumerate(values) if value in item]
    best, last = None, 0
    for number, a in enumerate(own):
        while last < len(own) and own[last] < a + longest:
            last += 1
        if last - number < least:
            continue
        left, both = dict(item), 0
        for z in own[number:last]:
            value = values[z]
            if left[value]:
                left[value] -= 1
                both += 1
                reached = both / (z + 1 - a + size - both)
                if reached >= similarity and (best is None or reached > best[0]):
                    best = reached, a
    return best


def _regions(found: set[tuple[int, int, int]], bench: Benchmark, similarity: float) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, last + 1 shingle) around candidates; those of an item that overlap are one."""
    now = None
    for d, item, begin in sorted(found):
        size = len(bench.hashes[item])
        reach = int(size / similarity) - size + 5
        a, z = begin - reach, begin + size + reach
        if now and now[:2] == (d, item) and a <= now[3]:
            now = d, item, now[2], z
        else:
            if now:
                yield now
            now = d, item, a, z
    if now:
        yield now


def leaks_of(
    texts: pa.Array, bench: Benchmark, similarity: float, radius: int, any_length: bool = False
) -> list[list[dict]]:
    """For each text: its best passage for every item that reaches the similarity.

    Passages are as long as the item, or of ``any_length``, as the operator asks for.
    """
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    if not bench.sizes:
        return out
    counts = {i: Counter(bench.hashes[i].tolist()) for s in bench.sizes for i in s.item.tolist()}
    for first, _, data, offsets in text_blocks(texts):
        words = hashed_words(data, offsets)
        h, doc, word = shingled(words, bench.k)
        if not len(h):
            continue
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        found = _candidates(h, doc, bench, radius)
        for d, item, begin in () if any_length else found:
            for start in range(begin - 4, begin + 5):
                a, z = max(start, int(bounds[d])), min(start + len(bench.hashes[item]), int(bounds[d + 1]))
                if a >= z:
                    continue
                value = weighted_similarity(Counter(h[a:z].tolist()), counts[item])
                if value >= similarity and (value, -a) > best.get((d, item), (0.0, 0)):
                    best[d, item] = (value, -a)
        for d, item, a, z in _regions(found, bench, similarity) if any_length else ():
            a, z = max(a, int(bounds[d])), min(z, int(bounds[d + 1]))
            reached = best_passage(h[a:z], counts[item], similarity) if a < z else None
            if reached and (reached[0], -a - reached[1]) > best.get((d, item), (0.0, 0)):
                best[d, item] = reached[0], -a - reached[1]
        starts = np.searchsorted(words.doc, np.arange(len(offsets)))
        for (d, item), (value, a) in sorted(best.items()):
            leak = {"item_id": bench.ids[item], "similarity": value, "first_word": int(word[-a] - starts[d])}
            out[first + d].append(leak)
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    k: int = SHINGLE_WORDS,
    block_bits: int = BLOCK_BITS,
    slice_bytes: int = SLICE_BYTES,
    leaks: str = "leaks",
) -> DataFrame:
    """``docs`` with a further column ``leaks``: the items found in the text, each with its best passage.

    Words are runs of ASCII letters and digits (case-insensitive) and of other non-ASCII characters. Items
    of fewer than ``k`` words are too short to be told from chance and match nothing; null texts are empty.
    Every item row counts for itself, repeated ones too. Documents without a leak have an empty list. All
    columns of ``docs`` pass through; if ``leaks`` is taken, leaks_2 is used. No rows give no rows. A benchmark of
    more than ``slice_bytes`` is searched slice by slice, with the table written in between.
    """
    name = free_name(docs.columns, leaks)
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.coalesce(item_text, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    slices = max(1, -(-size // slice_bytes))
    found, columns = docs, docs.columns
    for number in range(slices):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == number).collect()
        bench = build_benchmark([row["id"] for row in part], [row["text"] for row in part], k, block_bits, similarity)
        shared = docs.sparkSession.sparkContext.broadcast(bench)
        found = _with_leaks(found, shared, text, columns, name, similarity, 4 * block_bits + 3)
        if number < slices - 1:  # a job for each slice, so that no task holds two of them
            found = stored(found, f"leaks_{number}")
            shared.unpersist()
    return found


def _with_leaks(
    docs: DataFrame, shared: Broadcast, text: str, columns: list[str], name: str, similarity: float, radius: int
) -> DataFrame:
    at = [c.lower() for c in columns].index(text.lower())
    again = name in docs.columns
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = leaks_of(batch.column(at), shared.value, similarity, radius, any_length=True)
        if again:
            found = [[*old, *new] for old, new in zip(batch.column(len(columns)).to_pylist(), found, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(found, kind)], [*columns, name])

    schema = docs.select(*columns, F.lit(None).cast(_LEAKS).alias(name)).schema
    return map_batches(docs, search, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    found = find_leaks(docs, benchmark, text, **options)
    return found.filter(F.size(found.columns[-1]) == 0).select(*docs.columns)
