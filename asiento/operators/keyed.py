"""Keyed upsert: the last row of a key wins, the key keeps its first position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(
    df: DataFrame, keys: Sequence[str], pos: str, first_pos: str = "first_pos"
) -> DataFrame:
    """One row per key: the one at the highest ``pos``, plus the lowest ``pos`` as ``first_pos``.

    A null key is a key like any other. The aggregation combines before it shuffles, so a key that owns
    most of the rows arrives as one row per task.
    """
    rest = [name for name in df.columns if name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), pos).alias("_last"), F.min(pos).alias(first_pos))
        .select(*keys, "_last.*", first_pos)
    )
