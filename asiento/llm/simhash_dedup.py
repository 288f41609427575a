"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 10).

A fingerprint of 64 bits is cut into three segments, each padded with zeros to the 23 bits of the
perfect Golay code. Every 23-bit word lies within three bits of exactly one codeword; its keys are all
codewords within four bits: one, or six for words at distance three. Two words at most two bits apart
share a key: the codeword nearest to a word half way between them is within four bits of both. Of four
differing bits, at most one segment can hold three or more, so two segments differ by two bits at most
and share a key each. Joining on pairs of keys therefore finds every pair of fingerprints within four
bits; the exact bit distance then decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import components, map_batches, stored
from asiento.operators.joins import dimension_join, exclude_in_place, heavy_key_join

#: Words of a shingle, and the largest number of differing bits of a link.
SHINGLE_WORDS, MAX_BITS = 4, 4
SEED = 42
#: Bits of the three segments of a fingerprint.
SEGMENTS = (22, 21, 21)
#: Fingerprints of a block of a key; a key with more is cut into blocks.
KEY_BLOCK = 4096
#: Runs of equal keys up to this length are compared together, row by shifted row.
_FEW = 16
#: Sorted rows that are looked through together.
_ROWS_AT_ONCE = 1 << 15
#: Shingles hashed at a time.
_HASH_BLOCK = 1 << 16
#: Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GENERATOR = 0b110001110101
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of 23-bit polynomials by the generator."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, _GENERATOR << (bit - 11), 0)
    return words


def _error_patterns() -> np.ndarray:
    """By syndrome: the error patterns of up to four bits, six at most, filled up with -1."""
    table = np.full((2048, 6), -1, dtype=np.int64)
    filled = np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << bit for bit in bits) for bits in combinations(range(23), weight)])
        for pattern, syndrome in zip(patterns.tolist(), _remainder(patterns).tolist(), strict=True):
            table[syndrome, filled[syndrome]] = pattern
            filled[syndrome] += 1
    return table


_PATTERNS = _error_patterns()
_SYNDROME_LOW, _SYNDROME_HIGH = _remainder(np.arange(1 << 12)), _remainder(np.arange(1 << 11) << 12)


def codeword_keys(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of all codewords within four bits of each 23-bit word; -1 fills up to six."""
    errors = _PATTERNS[_SYNDROME_LOW[words & 0xFFF] ^ _SYNDROME_HIGH[words >> 12]]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of fingerprints, and the index of the fingerprint of each."""
    keys, shift = [], 0
    for bits in SEGMENTS:
        segment = (prints >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
        keys.append(codeword_keys(segment))
        shift += bits
    found, owners = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = (keys[i][:, :, None] << 12) | keys[j][:, None, :]
        valid = (keys[i][:, :, None] >= 0) & (keys[j][:, None, :] >= 0)
        found.append(both[valid] | (pair << 24))
        owners.append(np.nonzero(valid)[0])
    return np.concatenate(found), np.concatenate(owners)


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a UTF-8 text: bits set in over half of their XXH64 values."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts, n = np.zeros(64, np.int64), len(last)
    digest = xxhash.xxh64_intdigest
    for first in range(0, n, _HASH_BLOCK):
        s, e = starts[first : first + _HASH_BLOCK].tolist(), last[first : first + _HASH_BLOCK].tolist()
        hashes = np.fromiter([digest(joined[i:j], SEED) for i, j in zip(s, e, strict=False)], np.uint64)
        lanes = hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8, dtype=np.int64) << 8)
        counts += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``id_column, print`` (a signed long) of every row. A null text is empty: fingerprint 0."""

    def prints(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).cast(pa.binary())
        values = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "print"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return map_batches(rows, prints, "id long, print long")


def _link_block(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= max_bits


def _roots(prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is connected among these fingerprints, no more than one for each.

    Every fingerprint still apart is compared with all others still apart, breadth first.
    """
    apart = np.unique(prints)
    while len(apart) > 1:
        root, frontier, apart = apart[0], apart[:1], apart[1:]
        while len(frontier) and len(apart):
            near = np.zeros(len(apart), dtype=bool)
            for i in range(0, len(frontier), 256):
                near |= _link_block(frontier[i : i + 256], apart, max_bits).any(axis=0)
            frontier, apart = apart[near], apart[~near]
            if len(frontier):
                yield np.full(len(frontier), root), frontier


def _grouped(schema_names: list[str], block, width: int, few=None):
    """Batches of rows sorted by their first ``width`` columns to ``block(rows)`` for each run of equal keys.

    Runs of up to ``_FEW`` rows are instead given to ``few(rows, sizes)``, all those of a batch at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: np.ndarray | None = None
        out: list[np.ndarray] = []

        def flush(rows: np.ndarray, everything: bool) -> np.ndarray:
            change = np.flatnonzero((rows[1:, :width] != rows[:-1, :width]).any(axis=1)) + 1
            bounds = np.concatenate([[0], change, [len(rows)]])
            last = len(bounds) - 1 if everything else len(bounds) - 2
            sizes = np.diff(bounds)[:last]
            if few is not None:
                out.extend(few(rows[: bounds[last]], np.repeat(sizes, sizes)))
            for i in np.flatnonzero(sizes > (1 if few is None else _FEW)):
                out.extend(block(rows[bounds[i] : bounds[i + 1]]))
            return rows[bounds[last] :]

        waiting, n = [], 0
        for batch in batches:
            waiting.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            n += batch.num_rows
            if n < _ROWS_AT_ONCE:
                continue
            carried = flush(np.concatenate([*([] if carried is None else [carried]), *waiting]), False)
            waiting, n = [], 0
            if out:
                yield _batch(np.concatenate(out), schema_names)
                out.clear()
        if carried is not None:
            waiting.insert(0, carried)
        if waiting and sum(map(len, waiting)):
            flush(np.concatenate(waiting), True)
            if out:
                yield _batch(np.concatenate(out), schema_names)

    return run


def _batch(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names)


def print_links(prints: DataFrame, max_bits: int = MAX_BITS, key_block: int = KEY_BLOCK) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (column ``print``) within ``max_bits`` bits.

    Not every pair is returned, but what is connected by pairs is connected by these links. Within a key
    as many links as fingerprints leave at most. Fingerprints are counted by key first; those of a key with more
    than ``key_block`` go to pairs of blocks, each compared by a task of its own, so no task sees such a key whole.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys hold for at most {MAX_BITS} differing bits")

    def keyed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, len(values), 4096):
            part = values[i : i + 4096]
            keys, owner = golay_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[owner])], ["key", "print"])

    def of_run(rows: np.ndarray) -> Iterator[np.ndarray]:
        for a, b in _roots(np.ascontiguousarray(rows[:, 1]).view(np.uint64), max_bits):
            yield np.column_stack([a.view(np.int64), b.view(np.int64)])

    def of_few(rows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        rows = rows[(sizes > 1) & (sizes <= _FEW)]
        keys, values = np.ascontiguousarray(rows[:, 0]), np.ascontiguousarray(rows[:, 1]).view(np.uint64)
        for step in range(1, min(_FEW, len(rows))):
            at = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(at):
                break
            at = at[np.bitwise_count(values[at] ^ values[at + step]) <= max_bits]
            yield np.column_stack([rows[at, 1], rows[at + step, 1]])

    # A fingerprint gives about 85 keys: a small table of them is worth all cores.
    session = prints.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    keys = map_batches(prints.select("print").repartition(tasks, "print"), keyed, "key long, print long")
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > key_block)
    heavy = stored(counts.select("key", F.ceil(F.col("n") / key_block).alias("parts")), "heavy_keys")
    block = F.pmod(F.xxhash64("print"), F.col("parts"))
    marked = dimension_join(keys, heavy, ["key"], ["print"], "left").withColumn("block", block)
    pairs = F.expr("transform(sequence(0L, parts - 1), p -> xxhash64(key, least(p, block), greatest(p, block)))")
    # Should two runs get the same number, they are compared as one: every link is still a link.
    run = F.explode(F.when(F.col("parts").isNull(), F.array("key")).otherwise(pairs))
    runs = marked.select(run.alias("run"), "print").repartition("run").sortWithinPartitions("run")
    return runs.mapInArrow(_grouped(["a", "b"], of_run, 1, of_few), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``id_column, fingerprint, component_id`` for every row of ``docs``.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into ``shingle``-word shingles,
    repeats included; fewer words make one shingle, no word fingerprint 0, which links like any other.
    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the
    smallest id that links reach. Null texts are empty. A row with a null id is returned with its
    fingerprint, and with the component of the rows it is linked to, null if none has an id. Rows that
    share an id each get a row. No rows give no rows; further columns of ``docs`` are ignored.
    """
    prints = stored(fingerprints(docs, id_column, text, shingle), "prints")
    distinct = prints.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    distinct = stored(distinct, "classes")
    roots = components(print_links(distinct, max_bits))
    placed = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "rep", F.coalesce("component", "print").alias("component")
    )
    least = stored(placed.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n")), "components")
    named = heavy_key_join(placed, least.select("component", "component_id"), ["component"], least.select("component", "n"))
    classes = named.select("print", "component_id")
    # One print may hold a third of all documents; such prints are joined by broadcast.
    rows = heavy_key_join(prints, classes, ["print"], distinct)
    return rows.select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id.

    Of rows that share an id one stays. Rows with a null id are kept: they cannot be told apart. Texts are filtered
    where they lie; only rows of ids that repeat are shuffled.
    """
    found = near_duplicates(docs, id_column, text, **options).filter(F.col(id_column).isNotNull())
    kept = F.max(F.col(id_column) == F.col("component_id")).alias("kept")
    ids = stored(found.groupBy(id_column).agg(F.count("*").alias("n"), kept), "ids")
    # Ids are longs here, as they are compared; the column itself stays as it is.
    ids = ids.withColumn(id_column, F.col(id_column).cast(docs.schema[id_column].dataType))
    left = exclude_in_place(docs, ids.filter("not kept").select(id_column), [id_column])
    repeated = ids.filter("kept and n > 1").select(id_column)
    if repeated.isEmpty():
        return left
    once = dimension_join(left, repeated, [id_column], [text], "left_semi").select(*docs.columns).dropDuplicates([id_column])
    return exclude_in_place(left, repeated, [id_column]).unionByName(once)
