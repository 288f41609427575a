"""Run registered queries on Spark and their SQL in DuckDB, and compare the results as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def differences(spark: SparkSession, db: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """Nothing if both engines agree on columns, types of value and rows."""
    df = QUERIES[name](spark, sf_dir)
    relation = db.sql(ORACLE[name])
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} against {sorted(relation.columns)}"]
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    order = ", ".join(f'"{column}"' for column in columns)
    theirs = Counter(db.sql(f"SELECT {order} FROM ({ORACLE[name]})").fetchall())
    if ours == theirs:
        kinds = {tuple(type(value) for value in row) for row in ours}
        other = {tuple(type(value) for value in row) for row in theirs}
        return [] if kinds == other else [f"types {kinds} against {other}"]
    only_ours, only_theirs = ours - theirs, theirs - ours
    return [
        f"{sum(ours.values())} rows against {sum(theirs.values())}",
        f"only Spark ({len(only_ours)}): {list(only_ours)[:3]}",
        f"only SQL ({len(only_theirs)}): {list(only_theirs)[:3]}",
    ]


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            found = differences(spark, db, name, sf_dir)
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)


if __name__ == "__main__":
    main()
