"""What several operators share: Arrow batches as byte arrays, hashed words, stored steps, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handled by one call of the array code, in bytes; one longer text is handled alone.
BLOCK_BYTES = 1 << 18
#: Rows of an Arrow batch, in place of Spark's 10,000: texts are long, and two batches a task are held at once.
BATCH_ROWS = 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters and digits of ASCII, and every byte of a longer UTF-8 sequence.
_IS_WORD = np.zeros(256, dtype=bool)
for _first, _last in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _IS_WORD[_first:_last] = True
_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, dtype=np.uint64))


class Words(NamedTuple):
    """Words of several texts, in order: hash, index of the text, and the hashes of leading bytes."""

    hash: np.ndarray
    doc: np.ndarray
    prefixes: tuple[np.ndarray, ...]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``BLOCK_BYTES``: first and last + 1 index, bytes, offsets from 0."""
    data, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def hashed_words(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()) -> Words:
    """Words are runs of ASCII letters and digits (capitals as small letters) and non-ASCII characters.

    ``prefixes`` asks for hashes of the first k bytes; they are 0 for a word of at most k bytes.
    """
    word = _IS_WORD[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] |= word[inner]
    at = np.flatnonzero(word)
    starts = np.flatnonzero(begins[at])
    if not len(starts):
        nothing = np.zeros(0, np.uint64)
        return Words(nothing, np.zeros(0, np.int64), tuple(nothing for _ in prefixes))
    lengths = np.diff(np.append(starts, len(at)))
    within = np.arange(len(at)) - np.repeat(starts, lengths)
    values = (_LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * _POWERS[within & 1023]
    leading = []
    for k in prefixes:
        h = mix(np.add.reduceat(np.where(within < k, values, np.uint64(0)), starts) + np.uint64(k))
        leading.append(np.where(lengths > k, h, np.uint64(0)))
    whole = mix(np.add.reduceat(values, starts))
    doc = np.searchsorted(offsets, at[starts], "right") - 1
    return Words(whole, doc, tuple(leading))


def shingled(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, the text of each, and the index of its first word."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = words.hash[:n].copy()
    for i in range(1, k):
        h = h * np.uint64(0x100000001B3) + words.hash[i : i + n]
    at = np.flatnonzero(words.doc[:n] == words.doc[k - 1 :])
    return mix(h[at]), words.doc[at], at


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """Apply a generator to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return small_batches(df).mapInArrow(run, schema)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after making the session's Arrow batches small unless their size was set by hand."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
    return df


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, or the first of wanted_2, wanted_3 ... that no column has (case does not count)."""
    taken, name, n = {c.lower() for c in columns}, wanted, 1
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where that is unset (local tests) a temporary folder, set from then on."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = getattr(shared_folder, "own", None) or tempfile.mkdtemp(prefix="asiento-")
        shared_folder.own = folder
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back; the files go when the application ends."""
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(target)
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(target).getParent()
    path.getFileSystem(context).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(target)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of an undirected graph: the smallest node that can be reached.

    Alternating large and small stars: every round links the neighbours of a node to its smallest one,
    until nothing changes, in about log rounds for any shape of graph. Nodes that are their own smallest
    are left out. Each round is written, so a lost executor costs one round.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.filter("u > v").distinct(), "edges")
