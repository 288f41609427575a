"""Upserts over several runs against one run over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from asiento.operators.keyed import keep_last
from asiento.sinks.merge import BUCKET, last_position, merge_groups, merge_last, read_merged

SCHEMA = "company string, doc long, value string, pos long"


def rows_of(rng, n):
    return [(rng.choice(["a", "b", None]), rng.randrange(40), f"v{i}" if i % 9 else None, i) for i in range(n)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_runs_over_parts_leave_the_table_of_one_run(spark, tmp_path, order):
    rows = rows_of(random.Random(1), 300)
    path = str(tmp_path / "merged")
    for k in order:
        merge_last(spark.createDataFrame(rows[100 * k : 100 * k + 100], SCHEMA), path, ["company", "doc"], "pos", buckets=5)
    whole = keep_last(spark.createDataFrame(rows, SCHEMA), ["company", "doc"], "pos")
    found = read_merged(whole, path)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert last_position(whole, path, "pos") == max(r.pos for r in whole.collect())


def test_groups_are_replaced_whole(spark, tmp_path):
    schema = "doc long, concept string, value double, pos long"
    path = str(tmp_path / "values")
    first = [(1, "Cash", 1.0, 0), (1, "Sales", 2.0, 0), (2, "Cash", 3.0, 1), (None, "x", 0.0, 2)]
    merge_groups(spark.createDataFrame(first, schema), path, ["doc"], "pos", buckets=3)
    merge_groups(spark.createDataFrame([(1, "Cash", 9.0, 7), (None, "y", 1.0, 8), (3, "Cash", 4.0, 9)], schema), path, ["doc"], "pos", buckets=3)
    merge_groups(spark.createDataFrame([(2, "Late", 0.0, 0)], schema), path, ["doc"], "pos", buckets=3)  # an older filing
    found = read_merged(spark.createDataFrame([], schema), path).collect()
    assert sorted((r.doc or 0, r.concept, r.value) for r in found) == [(0, "y", 1.0), (1, "Cash", 9.0), (2, "Cash", 3.0), (3, "Cash", 4.0)]


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    path = tmp_path / "merged"
    rows = [("a", i, "v", i) for i in range(200)]
    merge_last(spark.createDataFrame(rows, SCHEMA), str(path), ["company", "doc"], "pos", buckets=8)
    before = {f: f.stat().st_mtime_ns for f in path.glob("bucket=*/*.parquet")}
    merge_last(spark.createDataFrame([("a", 3, "new", 500)], SCHEMA), str(path), ["company", "doc"], "pos", buckets=8)
    after = {f: f.stat().st_mtime_ns for f in path.glob("bucket=*/*.parquet")}
    changed = {f.parent for f in set(before) ^ set(after)} | {f.parent for f in before if f in after and before[f] != after[f]}
    assert len({f.parent for f in after}) == 8 and len(changed) == 1
    table = read_merged(spark.createDataFrame([], SCHEMA + ", first_pos long"), str(path))
    assert table.filter("doc = 3").first()[2:] == ("new", 500, 3) and table.count() == 200 and BUCKET not in table.columns


def test_empty_runs(spark, tmp_path):
    path = str(tmp_path / "none")
    empty = spark.createDataFrame([], SCHEMA)
    merge_last(empty, path, ["doc"], "pos")
    merge_groups(empty, path, ["doc"], "pos")
    assert read_merged(empty, path).collect() == [] and last_position(empty, path, "pos") == -1
    merge_last(empty.unionByName(spark.createDataFrame([("a", 1, None, 4)], SCHEMA)), path, ["doc"], "pos")
    merge_last(empty, path, ["doc"], "pos")
    assert spark.read.parquet(path).select(F.max("pos")).first()[0] == 4
