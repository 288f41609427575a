"""An index stored by month and company against the same index read whole."""

from datetime import date

import pytest

import asiento as A
from asiento.schemas import INDEX_ROWS

HEADER = ["FECHA", "HORA", "DESCRIPCIÓN", "DOCUMENTO", "VER"]
FROM, TO = date(2024, 2, 10), date(2024, 3, 5)


def row(company, number, day, link="https://h/x"):
    cells = [day, "10:00", "Balance", str(number), "Ver"]
    return (company, 0, number, HEADER, cells, [None, None, None, None, link])


def captured():
    rows = [(f"c{i}", 0, 0, HEADER, HEADER, [None] * 5) for i in range(12)]
    days = ["9 feb. 2024", "10 feb. 2024", "29 feb. 2024", "1 mar. 2024", "5 mar. 2024", "6 mar. 2024", "5 mar. 2023", "soon", None]
    for i in range(12):
        rows += [row(f"c{i}", n + 1, day) for n, day in enumerate(days)]
    rows += [row("c3", 40, "1 mar. 2024", None), row("c4", 41, "1 mar. 2020", None)]  # only the first fails its company
    rows += [("c5", None, None, HEADER, None, None), ("late", 1, 3, None, None, None)]
    return rows


@pytest.fixture
def index(spark, tmp_path):
    rows = spark.createDataFrame(captured(), INDEX_ROWS)
    path = str(tmp_path / "index")
    A.write_index(rows, path, buckets=4)
    return rows, path


def texts(df):
    return sorted(map(str, df.collect()))


def got_filings(spark, path):
    one = spark.createDataFrame([("c1",)], "company_id string")
    return A.read_index(spark, path, FROM, TO, one, 4).selectExpr("concat(cells[0], ' ', cells[1]) submission_date").filter("submission_date is not null").collect()


def files_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numFiles").value()


def test_same_filings_as_the_whole_index(spark, index):
    rows, path = index
    for companies in (None, spark.createDataFrame([("c1",), ("c3",), ("c1",), ("none",)], "company_id string")):
        whole = rows if companies is None else rows.join(companies.distinct(), "company_id", "left_semi")
        for wanted, got in zip(A.parse_index(whole, FROM, TO), A.parse_index(A.read_index(spark, path, FROM, TO, companies, 4), FROM, TO), strict=True):
            assert texts(got) == texts(wanted)
    assert {r.submission_date.split(" 10:")[0] for r in got_filings(spark, path)} == {"10 feb. 2024", "29 feb. 2024", "1 mar. 2024", "5 mar. 2024", "soon"}
    assert {r.company_id for r in A.captured_companies(spark, path).collect()} == {r[0] for r in captured()}


def test_only_the_folders_of_the_range_and_the_companies_are_read(spark, index, plan):
    _, path = index
    everything = files_read(spark.read.parquet(path))
    ranged = A.read_index(spark, path, FROM, TO, buckets=4)
    one = A.read_index(spark, path, FROM, TO, spark.createDataFrame([("c1",)], "company_id string"), 4)
    months = {f.split("month=")[1].split("/")[0] for f in spark.read.parquet(path).inputFiles()}
    assert {"-1", "0", "202402", "202403"} < months and "PartitionFilters: [(" in plan(ranged)
    assert files_read(ranged) == len({f for f in spark.read.parquet(path).inputFiles() if "month=0/" in f or "month=20240" in f}) < everything
    assert "bucket" in plan(one).split("PartitionFilters")[1].split("PushedFilters")[0]


def test_append_and_empty(spark, tmp_path):
    path = str(tmp_path / "index")
    A.write_index(spark.createDataFrame([row("a", 1, "1 mar. 2024")], INDEX_ROWS), path)
    A.write_index(spark.createDataFrame([row("b", 1, "2 mar. 2024")], INDEX_ROWS), path, mode="append")
    A.write_index(spark.createDataFrame([], INDEX_ROWS), path, mode="append")
    found = A.read_index(spark, path, FROM, TO)
    assert found.columns == INDEX_ROWS.names and sorted(r.company_id for r in found.collect()) == ["a", "b"]
    assert A.read_index(spark, path, FROM, TO, spark.createDataFrame([], "company_id string")).collect() == []


def test_captures_are_ranked_without_their_content(spark, plan):
    schema = (
        "company_id string, filing_pos long, page_no int, first_page int, last_page int, "
        "controls array<struct<element_id:string,kind:string,value:string>>, rows array<struct<shape:string,cells:array<string>>>"
    )
    one, two, other = ("s", ["a"]), ("s", ["b"]), ("s", ["c"])
    control = ("i", "value", "x")
    items = spark.createDataFrame(
        [
            ("c", 0, 1, 1, 1, [], [one]), ("c", 0, 1, 1, 1, [], [one, two]), ("c", 0, 1, 1, 1, [control] * 3, []),
            ("c", 0, 2, 1, 1, [control], [one]), ("c", 0, 2, 1, 1, [], [one]),
            ("c", 1, None, 1, 1, [], [one]), ("c", 1, None, 1, 1, [], [one]),
            ("c", 2, 1, 1, 1, [], [other]), ("c", 2, 1, 1, 1, [], [two]), ("c", 3, 1, 1, 1, [], []),
        ],
        schema,
    )
    kept = A.one_capture(items)
    rows = {(r.filing_pos, r.page_no): (len(r.rows), len(r.controls)) for r in kept.collect()}
    assert rows == {(0, 1): (2, 0), (0, 2): (1, 1), (1, None): (1, 0), (2, 1): (1, 0), (3, 1): (0, 0)}
    assert kept.count() == 5 and kept.columns == items.columns and "Window" not in plan(kept)
    again = A.one_capture(items.repartition(3))  # which of two alike counts does not depend on where they lie
    assert texts(again) == texts(kept)
