"""Upserts into a table that earlier runs have written.

The table lies in folders by a hash of the key. A run reads and rewrites only the folders its keys fall into, so
adding a few filings to a large table costs what those folders hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.operators.keyed import keep_last
from asiento.sinks.bundle import write_partitions
from asiento.storage import stored

#: Folders of a table; fixed when it is first written.
BUCKETS = 64
BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _exists(df: DataFrame, path: str) -> bool:
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def read_merged(df: DataFrame, path: str) -> DataFrame:
    """The table, without its bucket column: the columns of ``df``, and no rows if it is not written yet."""
    if not _exists(df, path):
        return df.limit(0)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def last_position(df: DataFrame, path: str, pos: str) -> int:
    """The highest stored position, -1 if there is none: later captures are numbered on from there."""
    found = read_merged(df, path).agg(F.max(pos)).first()[0]
    return -1 if found is None else found


def merge_last(
    new: DataFrame, path: str, keys: Sequence[str], pos: str, first_pos: str = "first_pos", buckets: int = BUCKETS
) -> None:
    """Upsert: of all rows of a key, stored or new, the one at the highest ``pos`` stays.

    ``first_pos`` keeps the lowest ``pos`` a key ever had, so runs over parts of the rows, in any order, leave
    the table that one run over all of them leaves. A null key is a key like any other. Positions must go on
    from run to run (:func:`last_position`); of equal ones any row stays.
    """
    keys = list(keys)
    latest = stored(keep_last(new, keys, pos, first_pos).withColumn(BUCKET, bucket_of(keys, buckets)), "latest")
    touched = [r[0] for r in latest.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
    if not touched:
        return
    if _exists(new, path):
        # ``buckets`` names folders: the filter is on partitions, and no other file is opened.
        old = new.sparkSession.read.schema(latest.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        rest = [name for name in new.columns if name not in keys]
        both = old.select(latest.columns).unionByName(latest)
        both = both.groupBy(BUCKET, *keys).agg(F.max_by(F.struct(*rest), pos).alias("_last"), F.min(first_pos).alias(first_pos))
        latest = both.select(*keys, "_last.*", first_pos, BUCKET)
    _replace(latest, path, touched)


def merge_groups(new: DataFrame, path: str, keys: Sequence[str], pos: str, buckets: int = BUCKETS) -> None:
    """Upsert of whole groups: of all rows of a key, stored or new, those at the highest ``pos`` stay.

    The values of a statement are such a group: a later filing of the statement replaces all of them, also
    those of concepts it no longer has.
    """
    keys = list(keys)
    rows = stored(new.withColumn(BUCKET, bucket_of(keys, buckets)), "rows")
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    if not touched:
        return
    if _exists(new, path):
        old = new.sparkSession.read.schema(rows.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        rows = old.select(rows.columns).unionByName(rows)
    last = rows.groupBy(*keys).agg(F.max(pos).alias("_last"))  # combined before it is shuffled
    same = F.col(f"r.{pos}") == F.col("l._last")
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"l.{key}"))
    _replace(rows.alias("r").join(last.alias("l"), same, "left_semi").select("r.*"), path, touched)


def _replace(rows: DataFrame, path: str, touched: Sequence[int]) -> None:
    """The folders of ``touched`` buckets hold ``rows`` afterwards; what is read is stored before it is replaced."""
    rows = stored(rows, "merged")
    replaced = rows.sparkSession.createDataFrame([(str(b),) for b in touched], f"{BUCKET} string")
    write_partitions(rows.withColumn(BUCKET, F.col(BUCKET).cast("string")), path, BUCKET, replaced)
