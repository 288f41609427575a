"""Joins that hold when one key owns a large share of the rows.

Four situations, four ways:

* a side given from outside that should be small (a registry, a dictionary): it is measured, and
  broadcast only if it fits -> :func:`dimension_join`;
* a side that is small next to the other but not known to fit: each of its rows is repeated over a few
  salts, so a hot key is spread over as many tasks -> :func:`spread_join`;
* a side whose rows are too wide to move (stored pages): its rows are filtered in place by a bounded table
  of key bits, made narrow, and only then joined -> :func:`prefilter`;
* a side about as large as the other, with the number of rows per key at hand: the few heavy keys are
  joined by broadcast, the rest by a plain shuffle -> :func:`heavy_key_join`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest side sent to every executor, in bytes of text and fixed-width values.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Most bits of a table that filters keys: 2^20 words of 64 bits, 16 MB.
FILTER_SLOTS = 1 << 26
#: Tasks a hot key is spread over by a salted join.
SALTS = 16
#: A key with more rows than this, which one task takes easily, is heavy.
HEAVY_ROWS = 1_000_000


def value_bytes(df: DataFrame) -> Column:
    """Size of the values of a row."""

    def width(name: str, kind: str) -> Column:
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 16
        return F.lit(16)

    return reduce(add, [width(*field) for field in df.dtypes])


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values: one small aggregation job."""
    return df.agg(F.sum(value_bytes(df)).alias("bytes")).first()["bytes"] or 0


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join with the rows of each left key spread over ``salts`` tasks.

    ``spread_by`` names left columns that differ within a key. Right rows are repeated ``salts`` times.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def dimension_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join to a side from outside: broadcast if its measured size allows, a spread join otherwise."""
    if measured_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), list(keys), how)
    return spread_join(left, right, keys, spread_by, how)


def _with_bits(left: DataFrame, right: DataFrame, keys: Sequence[str], max_slots: int, how: str) -> DataFrame:
    """``left`` with ``_found``: whether the bit of its key is set in a table of the keys of ``right``.

    The table has about 16 bits to a key, and never more than ``max_slots``.
    """
    slots = 1 << 10
    while slots < min(max_slots, 16 * right.count()):
        slots *= 2
    slot = F.xxhash64(*keys).bitwiseAND(F.lit(slots - 1))
    bit = F.expr("shiftleft(1L, cast(_slot & 63 as int))")
    marked = right.select(slot.alias("_slot")).select(word_of("_slot").alias("_word"), bit.alias("_bit"))
    words = marked.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    probed = left.withColumn("_slot", slot).withColumn("_word", word_of("_slot"))
    found = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)).alias("_found")
    return probed.join(F.broadcast(words), "_word", how).select(*left.columns, found)


def prefilter(left: DataFrame, right: DataFrame, keys: Sequence[str], max_slots: int = FILTER_SLOTS) -> DataFrame:
    """Rows of ``left`` whose key may be among those of ``right``, without a shuffle of ``left``.

    The keys of ``right`` are hashed to the bits of a bounded table that is sent to every executor: with more
    keys than it has room for, more rows pass. Those that pass by chance fall out of the exact join that follows.
    """
    return _with_bits(left, right, keys, max_slots, "inner").filter("_found").drop("_found")


def exclude_in_place(
    left: DataFrame, right: DataFrame, keys: Sequence[str], max_bytes: int = BROADCAST_BYTES, max_slots: int = FILTER_SLOTS
) -> DataFrame:
    """Rows of ``left`` whose key is not among the distinct ones of ``right``; no key is null.

    ``right`` is broadcast if its measured size allows. Otherwise only rows whose key may be there are
    shuffled, those of one key over several tasks.
    """
    if measured_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right.select(*keys)), list(keys), "left_anti").select(*left.columns)
    probed = _with_bits(left, right, keys, max_slots, "left").withColumn("_task", F.spark_partition_id())
    maybe = spread_join(probed.filter("_found"), right.select(*keys), keys, ["_task"], "left_anti")
    return probed.filter("not _found").unionByName(maybe).select(*left.columns)


def word_of(slot: str) -> Column:
    return F.shiftright(slot, 6)


def heavy_keys(
    weights: DataFrame, keys: Sequence[str], weight: str = "n", min_rows: int = HEAVY_ROWS
) -> DataFrame | None:
    """Keys of more than ``min_rows`` rows, or None if there are none (one job, on the counts).

    There is at most one for every ``min_rows`` rows, so the table is small next to what it counts.
    """
    heavy = weights.filter(F.col(weight) > min_rows).select(*keys)
    return None if heavy.isEmpty() else heavy


def split_heavy(
    df: DataFrame, heavy: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows of the heavy keys, and all others."""
    few = F.broadcast(heavy)
    return df.join(few, list(keys), "left_semi"), df.join(few, list(keys), "left_anti")


def heavy_key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    weights: DataFrame,
    how: str = "inner",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Equi-join to a side with at most one row per key; ``weights`` holds the left row count per key."""
    keys = list(keys)
    heavy = heavy_keys(weights, keys, min_rows=min_rows)
    if heavy is None:
        return left.join(right, keys, how)
    hot, light = split_heavy(left, heavy, keys)
    few = right.join(F.broadcast(heavy), keys, "left_semi")
    return light.join(right, keys, how).unionByName(hot.join(F.broadcast(few), keys, how))
