"""Counters of a run, per company."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_report(**stages: DataFrame) -> DataFrame:
    """One row per company with the number of its rows in each named table (zero if it has none).

    Each table is counted before it is put together with the others, so only counts are shuffled.
    """
    names = list(stages)
    counted = [
        table.groupBy("company_id")
        .agg(F.count("*").alias("_count"))
        .select(
            "company_id",
            *[(F.col("_count") if name == stage else F.lit(0).cast("bigint")).alias(name) for name in names],
        )
        for stage, table in stages.items()
    ]
    return (
        reduce(DataFrame.unionByName, counted)
        .groupBy("company_id")
        .agg(*[F.sum(name).alias(name) for name in names])
    )
