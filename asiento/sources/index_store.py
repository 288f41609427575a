"""Captured index rows, stored so that a run opens only the files of its companies and days.

Folders are months of submission and, within them, buckets of companies. Rows whose submission date cannot be
read have a month of their own, as a date filter must see them; rows that hold only a header have another.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asiento.functions import es_timestamp
from asiento.operators.joins import dimension_join
from asiento.schemas import INDEX_ROWS
from asiento.sources.index import submission_text

#: Folders of a month. A stored index is read with the number it was written with.
BUCKETS = 16
#: Months of rows without a readable submission date, and of headers.
UNREADABLE, HEADERS = 0, -1

_STORED = T.StructType(
    [
        *INDEX_ROWS.fields,
        T.StructField("day", T.DateType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("company_id"), F.lit(buckets)).cast("int")


def write_index(rows: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Store index rows (schema ``INDEX_ROWS``); ``mode`` may be ``append``.

    A folder is about one file, or several where a company has very many rows in a month: AQE splits it.
    Within a file rows are in order of company and day, so row groups of other companies are skipped too.
    """
    month = F.when(F.col("row_no") > 0, F.coalesce(F.year("day") * 100 + F.month("day"), F.lit(UNREADABLE)))
    dated = rows.select(*INDEX_ROWS.names, es_timestamp(submission_text()).cast("date").alias("day"))
    dated = dated.withColumn("month", F.coalesce(month, F.lit(HEADERS))).withColumn("bucket", _bucket(buckets))
    (
        dated.hint("rebalance", F.col("month"), F.col("bucket"))
        .sortWithinPartitions("month", "bucket", "company_id", "day")
        .write.mode(mode)
        .partitionBy("month", "bucket")
        .parquet(path)
    )


def read_index(
    spark: SparkSession,
    path: str,
    date_from: date,
    date_to: date,
    companies: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of a stored index as ``parse_index`` takes them: those submitted in the range of days (both days
    included), and those whose date cannot be read; of ``companies`` (column ``company_id``) if given.

    Months and buckets are filters on folders. Headers are not read: see :func:`captured_companies`.
    """
    first, last = (day.year * 100 + day.month for day in (date_from, date_to))
    month, day = F.col("month"), F.col("day")
    dated = month.between(first, last) & day.between(F.lit(date_from), F.lit(date_to))
    rows = spark.read.schema(_STORED).parquet(path).filter((month == UNREADABLE) | dated)
    if companies is not None:
        registered = companies.select("company_id").distinct()
        found = registered.select(_bucket(buckets).alias("bucket")).distinct().collect()  # at most ``buckets`` rows
        rows = rows.filter(F.col("bucket").isin([row["bucket"] for row in found]))
        rows = dimension_join(rows, registered, ["company_id"], ["page_no", "row_no"], "left_semi")
    return rows.select(*INDEX_ROWS.names)


def captured_companies(spark: SparkSession, path: str) -> DataFrame:
    """``company_id`` of every stored row, whatever its day: one narrow column of all files."""
    return spark.read.schema(_STORED).parquet(path).select("company_id")
