import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import asiento as A
from asiento.operators.duplicates import flag_separate_duplicates
from asiento.operators.joins import measured_bytes
from asiento.schemas import FILINGS_RAW


def filings(spark, descriptions, company="c1"):
    rows = [(company, str(i), text, f"l{i}", "", i) for i, text in enumerate(descriptions)]
    return spark.createDataFrame(rows, FILINGS_RAW)


EXAMPLE = [
    "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: CONSOLIDADO",
    "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: INDIVIDUAL",
    "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: INDIVIDUAL",
    "FECHA CIERRE: 2025-06-30 - TIPO BALANCE: INDIVIDUAL",
    "TIPO BALANCE: INDIVIDUAL",
    "FECHA CIERRE: 2025-06-30 - otros idiomas",
]


def positions(df):
    return sorted(row.filing_pos for row in df.collect())


def test_exclusion_and_duplicates(spark):
    kept = A.exclude_phrases(filings(spark, EXAMPLE), ["OTROS IDIOMAS"])
    assert positions(kept) == [0, 1, 2, 3, 4]
    assert positions(A.exclude_phrases(filings(spark, EXAMPLE), [])) == [0, 1, 2, 3, 4, 5]
    assert positions(A.drop_separate_duplicates(kept)) == [0, 3, 4]
    assert positions(A.drop_separate_duplicates(kept, "sequential")) == [0, 2, 3, 4]
    with pytest.raises(ValueError):
        A.drop_separate_duplicates(kept, "other")


def test_a_period_of_separate_filings_only_loses_all(spark):
    texts = ["FECHA CIERRE: 2025-03-31 - TIPO BALANCE: INDIVIDUAL"] * 2
    assert positions(A.drop_separate_duplicates(filings(spark, texts))) == []


def walk(items):
    """The rule read as a walk: what follows a dropped filing is not looked at."""
    counts = defaultdict(int)
    for _, period, _ in items:
        counts[period] += 1
    kept, skip = [], False
    for pos, period, kind in items:
        droppable = period is not None and counts[period] > 1 and kind == "INDIVIDUAL"
        drop = droppable and not skip
        skip = drop
        if not drop:
            kept.append(pos)
    return kept


def test_sequential_against_a_walk_over_blocks(spark, monkeypatch):
    monkeypatch.setattr("asiento.operators.duplicates._BLOCK_BITS", 2)
    rng = random.Random(7)
    rows, expected = [], []
    for company in range(120):
        share = rng.choice([0.3, 0.9, 1.0])
        items, pos = [], rng.randrange(4)
        for _ in range(rng.randrange(1, 40)):
            period = rng.choice([None, "2025-03-31", "2025-06-30"] if rng.random() < 0.2 else ["2025-03-31"])
            items.append((pos, period, "INDIVIDUAL" if rng.random() < share else "CONSOLIDADO"))
            pos += rng.choice([1, 1, 1, 2, 9])
        for pos, period, kind in items:
            stated = f"FECHA CIERRE: {period} - " if period else ""
            rows.append((f"c{company}", "d", f"{stated}TIPO BALANCE: {kind}", "l", "", pos))
        expected += [(f"c{company}", pos) for pos in walk(items)]
    df = spark.createDataFrame(rows, FILINGS_RAW)
    found = A.drop_separate_duplicates(df, "sequential").select("company_id", "filing_pos").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_flags_do_not_drop(spark):
    flags = {row.filing_pos: row.is_flagged for row in flag_separate_duplicates(filings(spark, EXAMPLE)).collect()}
    assert flags == {0: False, 1: True, 2: True, 3: True, 4: False, 5: False}


def test_date_range_is_inclusive_and_keeps_the_unreadable(spark):
    from datetime import date

    rows = [("c", "d", "", "l", text, i) for i, text in enumerate(
        ["31 dic. 2024 23:59", "1 ene. 2025 00:00", "1 mar. 2026 23:59", "2 mar. 2026 00:00", "?"])]
    df = spark.createDataFrame(rows, FILINGS_RAW)
    assert positions(A.filter_by_date(df, date(2025, 1, 1), date(2026, 3, 1))) == [1, 2, 4]


def test_keep_last(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("k", 2, "b"), (None, 3, "c"), ("k", 4, None)], "k string, pos int, v string")
    found = {row.k: (row.v, row.pos, row.first_pos) for row in A.keep_last(df, ["k"], "pos").collect()}
    assert found == {None: ("c", 3, 1), "k": (None, 4, 2)}


def hot_table(spark, n=400):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("pos")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_a_join(spark, how):
    left = hot_table(spark)
    right = spark.range(0, 60, 2).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    plain = left.join(right, "k", how)
    spread = A.spread_join(left, right, ["k"], ["pos"], how, salts=5)
    assert spread.columns == plain.columns
    assert sorted(spread.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_keys_are_found_and_joined(spark, how):
    left = hot_table(spark)
    right = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    weights = left.groupBy("k").agg(F.count("*").alias("n"))
    assert [row.k for row in A.heavy_keys(weights, ["k"], min_rows=100).collect()] == [0]
    assert A.heavy_keys(weights, ["k"]) is None
    joined = A.heavy_key_join(left, right, ["k"], weights, how, min_rows=100)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(joined.collect()) == order(left.join(right, "k", how).collect())


def test_dimension_join_broadcasts_only_what_fits(spark, plan):
    left = hot_table(spark)
    right = spark.createDataFrame([(i, "x" * 100) for i in range(60)], "k long, v string")
    small = A.dimension_join(left, right, ["k"], ["pos"])
    large = A.dimension_join(left, right, ["k"], ["pos"], max_bytes=1000)
    assert "BroadcastHashJoin" in plan(small)
    assert "_salt" in plan(large)
    assert sorted(small.collect()) == sorted(large.collect())


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1, ["xy"]), (None, None, None)], "s string, n int, a array<string>")
    assert measured_bytes(df) == 2 * 3 * 16 + 3 + len('["xy"]')
    assert measured_bytes(df.limit(0)) == 0


TAXONOMY = {"VENTAS": "Sales", "CAJA": "Cash"}


def test_labels(spark):
    rows = [("c", 0, i, label) for i, label in enumerate(["Ventas", "CAJA", "caja", "otra cosa", "Otra"])]
    lines = spark.createDataFrame(rows, "company_id string, filing_pos long, pos long, label string")
    taxonomy = A.taxonomy_table(spark, TAXONOMY)
    mapped = {row.label: row.concept for row in A.map_labels(lines, taxonomy).collect()}
    assert mapped == {"Ventas": "Sales", "CAJA": "Cash", "caja": "Cash", "otra cosa": "otra cosa", "Otra": "Otra"}
    missed = {row.label: row.n_lines for row in A.unmapped_labels(lines.union(lines), taxonomy).collect()}
    assert missed == {"otra cosa": 2, "Otra": 2}


def test_taxonomy_from_a_table(spark, tmp_path):
    path = tmp_path / "taxonomy.csv"
    path.write_text("source_label,concept\nVENTAS,Sales\nCAJA,Cash\n")
    assert dict(map(tuple, A.read_taxonomy(spark, str(path)).collect())) == TAXONOMY
    path.write_text("source_label,concept\nVENTAS,Sales\nVENTAS,Other\n")
    with pytest.raises(ValueError, match="VENTAS"):
        A.read_taxonomy(spark, str(path))
