"""Line-item labels to concepts of a taxonomy supplied by the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.operators.joins import dimension_join
from asiento.schemas import TAXONOMY
from asiento.sources.tables import scan


def taxonomy_table(spark: SparkSession, pairs: Mapping[str, str]) -> DataFrame:
    """A taxonomy from a dictionary ``label in capitals -> concept``."""
    return spark.createDataFrame(list(pairs.items()), TAXONOMY)


def read_taxonomy(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A taxonomy from a table with the columns ``source_label`` and ``concept``, found by their headers."""
    source, names = scan(spark, path, fmt)
    missing = set(TAXONOMY.names) - set(names)
    if missing:
        raise ValueError(f"columns missing from the taxonomy: {sorted(missing)}; it has: {sorted(names)}")
    taxonomy = source.select(*[F.col(f"`{names[name]}`").cast("string").alias(name) for name in TAXONOMY.names])
    check_taxonomy(taxonomy)
    return taxonomy


def check_taxonomy(taxonomy: DataFrame) -> None:
    """A label listed twice would double every line it maps, so it is an error."""
    doubled = taxonomy.groupBy("source_label").count().filter("count > 1").limit(10).collect()
    if doubled:
        raise ValueError(f"labels listed more than once: {[row.source_label for row in doubled]}")


def map_labels(
    lines: DataFrame,
    taxonomy: DataFrame,
    spread_by: tuple[str, ...] = ("company_id", "filing_pos", "pos"),
) -> DataFrame:
    """Add ``concept``: the taxonomy's entry for the label in capitals, or the label as it is."""
    dimension = taxonomy.select(
        F.col("source_label").alias("_label"), F.col("concept").alias("_concept")
    )
    probed = lines.withColumn("_label", F.upper("label"))
    joined = dimension_join(probed, dimension, ["_label"], spread_by, how="left")
    return joined.withColumn("concept", F.coalesce("_concept", "label")).drop("_label", "_concept")


def unmapped_labels(lines: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Labels the taxonomy misses, with the number of lines that carry each."""
    # Counted first: the join then sees one row per label, however often a label occurs.
    counts = lines.groupBy("label").agg(F.count("*").alias("n_lines"))
    known = taxonomy.select(F.col("source_label").alias("_label"))
    return (
        counts.withColumn("_label", F.upper("label"))
        .join(known, "_label", "left_anti")
        .select("label", "n_lines")
    )
