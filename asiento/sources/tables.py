"""Tables from outside whose columns are bound by their headers, read as text."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """A source and, for each header, the column that holds it (the first, if it is repeated).

    The columns carry ``_metadata``. CSV: quotes are doubled within quotes; ``multi_line`` allows line ends
    within them. Files with different headers are each bound by their own. JSON: numbers stay as written.
    """
    if fmt != "csv":
        reader = spark.read.format(fmt)
        source = (reader.option("primitivesAsString", True) if fmt == "json" else reader).load(path)
        return source.select("*", "_metadata"), {name: name for name in source.columns}
    first = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start")
    # The first line of each file, taken by the task that reads its first block: one row per file.
    tops = first.withColumn("line", F.monotonically_increasing_id()).filter("file_block_start = 0")
    tops = tops.groupBy("file").agg(F.min_by("value", "line").alias("header")).collect()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(tops, key=lambda row: row.file):
        header = tuple(next(csv.reader([row.header.lstrip("\ufeff")]), ()))
        by_header.setdefault(header, []).append(row.file)
    by_header.pop((), None)
    if not by_header:
        raise ValueError(f"no header in {path}")
    names = sorted({name for header in by_header for name in header})
    parts = []
    for header, files in by_header.items():
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
        at = dict(zip(reversed(header), reversed(schema.names), strict=True))
        # A header that other files have and these lack is null in them.
        columns = [F.col(at[name]) if name in at else F.lit(None).cast("string") for name in names]
        numbered = [column.alias(f"c{i}") for i, column in enumerate(columns)]
        parts.append(reader.csv(files).select(*numbered, "_metadata"))
    return reduce(DataFrame.unionByName, parts), {name: f"c{i}" for i, name in enumerate(names)}
