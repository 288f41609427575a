from datetime import date

import pytest

import asiento as A
from asiento.schemas import FILING_PAGES, INDEX_ROWS
from asiento.sinks.bundle import write_partitions
from tests.test_clean import clean
from tests.test_sources import registry, values_page

FORM = {
    "1select18889": "Trimestral", "1select36921": "Consolidado", "1select22363": "Pesos",
    "1select111599": "Miles de $", "1select34258": "NIIF", "1select99591": "No", "1select21271": "No",
    "1select18901": "No", "1select496788": "Si",
}
VALUES = {
    "1date17466": "31/03/2025", "1decimal21466": "1.000", "1decimal61378": "1,5", "1decimal46286": "10",
    "1textbox16696": "", "1decimal20806": "12",
}
HEADER = ["FECHA", "HORA", "DESCRIPCIÓN", "DOCUMENTO", "VER"]


def form(**changes):
    selects = "".join(f'<select id="{i}"><option>{text}</option></select>' for i, text in FORM.items())
    return selects + "".join(f'<input id="{i}" value="{text}">' for i, text in (VALUES | changes).items())


def index_row(company, row, description, document, link, day="13 oct. 2025"):
    cells = [day, "14:20", description, document, "Ver"]
    return company, 0, row, HEADER, cells, [None, None, None, None, link]


CONSOLIDATED = "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: CONSOLIDADO"
SEPARATE = "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: INDIVIDUAL"


def run(spark, tmp_path, **options):
    companies, registry_rejects = A.read_registry(spark, registry(tmp_path))
    alfa, epsilon, beta = "30444444444", "0012", "30222222222"
    index = [
        index_row(alfa, 1, CONSOLIDATED, "1.001", "u1"),
        index_row(alfa, 2, SEPARATE, "1.002", "u2"),
        index_row(alfa, 3, "FECHA CIERRE: 2025-06-30", "1.003", "u3"),
        index_row(alfa, 4, "FECHA CIERRE: 2025-09-30 - otros idiomas", "1.004", "u4"),
        index_row(alfa, 5, "FECHA CIERRE: 2024-09-30", "1.005", "u5", "13 oct. 2024"),
        index_row(epsilon, 1, CONSOLIDATED, "2.001", "u6"),
        index_row(epsilon, 2, "FECHA CIERRE: 2025-06-30", "2.002", "u7"),
        index_row(beta, 1, CONSOLIDATED, "3.001", None),
        index_row("unknown", 1, CONSOLIDATED, "4.001", "u9"),
    ]
    pages = [
        (alfa, "u1", 1, form() + values_page(1, 2, ["1", "Ventas", "10"], ["2", "Otra", "20"])),
        (alfa, "u1", 2, values_page(1, 2, ["3", "VENTAS", "30"])),
        (alfa, "u2", 1, form() + values_page(1, 1, ["1", "Ventas", "1"])),
        (alfa, "u3", 1, form()),
        (epsilon, "u6", 1, form(**{"1decimal61378": ""})),
    ]
    config = A.RunConfig(date(2025, 1, 1), date(2026, 3, 1), **options)
    report = A.run(
        companies,
        spark.createDataFrame(index, INDEX_ROWS),
        spark.createDataFrame([(c, link, page, f"https://f/{link}", html) for c, link, page, html in pages], FILING_PAGES),
        A.taxonomy_table(spark, {"VENTAS": "Sales"}),
        str(tmp_path / "out"),
        config,
        registry_rejects,
    )
    return report, str(tmp_path / "out")


def test_run(spark, tmp_path):
    report, out = run(spark, tmp_path)
    counts = {row.company_id: row for row in report.collect()}
    alfa = counts["30444444444"]
    assert (alfa.filings_found, alfa.filings_kept, alfa.filings_removed) == (3, 2, 1)
    assert (alfa.statements_exported, alfa.values_exported, alfa.filings_fetched) == (2, 2, 2)
    epsilon = counts["0012"]
    assert (epsilon.fetches_failed, epsilon.statements_rejected, epsilon.statements_exported) == (1, 1, 0)
    beta = counts["30222222222"]
    assert (beta.companies_loaded, beta.filings_found, beta.duplicates) == (1, 0, "set")
    assert set(counts) == {"30444444444", "0012", "30222222222"}
    assert not (tmp_path / "out" / "_staging").exists() and not list((tmp_path / "out").glob("asiento-*"))

    values = spark.read.parquet(f"{out}/statement_values")
    rows = values.orderBy("statement_pos", "pos").collect()
    assert [(row.ticker, row.document_id, row.order, row.concept, row.value) for row in rows] == [
        ("ALFA", 1001, 3, "Sales", 30000.0), ("ALFA", 1001, 2, "Otra", 20000.0),
    ]
    statements = spark.read.parquet(f"{out}/statement_metadata").orderBy("statement_pos").collect()
    assert [(row.document_id, row.number_of_employees, row.currency) for row in statements] == [
        (1001, 12, "Pesos"), (1003, 12, "Pesos"),
    ]
    fields = spark.read.parquet(f"{out}/company_metadata").orderBy("field_pos").collect()
    assert [row.field for row in fields] == [
        "id", "name", "ticker", "description", "sector", "industry_group", "industry", "sub_industry",
        "sub_industry_description",
    ]
    assert {row.ticker for row in fields} == {"ALFA"}
    rejects = {(row.company_id, row.stage) for row in spark.read.parquet(f"{out}/rejects").collect()}
    assert rejects == {
        (None, "registry"), ("30333333333", "registry"), ("30222222222", "listing"), ("0012", "extract"),
        ("0012", "clean"),
    }


def test_run_with_other_options(spark, tmp_path):
    _, out = run(spark, tmp_path, duplicates="sequential", exclude=(), fmt="csv", unscaled_concepts=("Sales",))
    values = spark.read.option("header", True).csv(f"{out}/statement_values").orderBy("pos").collect()
    assert [(row.concept, row.value) for row in values if row.document_id == "1001"] == [
        ("Sales", "30.0"), ("Otra", "20000.0"),
    ]


def test_bundle_replaces_its_tickers_only(spark, tmp_path):
    tables = [
        A.sinks.bundle.ExportTables(
            spark.createDataFrame([("c", ticker, 0, "id", value)], "company_id string, ticker string, field_pos int, field string, value string"),
            spark.createDataFrame([("c", ticker, 1)], "company_id string, ticker string, statement_pos long"),
            spark.createDataFrame([("c", ticker, 1, 1, value)], "company_id string, ticker string, statement_pos long, pos long, value string"),
        )
        for ticker, value in (("A", "old"), ("B", "kept"), ("A", "new"))
    ]
    for fmt in ("parquet", "csv"):
        out = str(tmp_path / fmt)
        for bundle in tables:
            A.write_bundle(bundle, out, fmt)
        found = spark.read.format(fmt).option("header", True).load(f"{out}/statement_values")
        assert {(row.ticker, row.value) for row in found.collect()} == {("A", "new"), ("B", "kept")}


def test_export_of_one_company(spark, tmp_path):
    mapping = {"id": "company_id", "name": "name", "ticker": "ticker"}
    registered = spark.createDataFrame([("c1", "One", "A", 1), ("c2", "Two", "B", 2)], "id string, name string, ticker string, line int")
    companies, _ = A.load_registry(registered, "line", mapping)
    tables = clean(spark, [{}, {"company_id": "c3"}], [(0, "Ventas", "1", "1")])
    args = (companies, tables.statements, tables.statement_values)
    out = str(tmp_path / "one")
    A.export_company(*args, "A", out)
    assert [row.ticker for row in spark.read.parquet(f"{out}/statement_metadata").collect()] == ["A"]
    assert [row.value for row in spark.read.parquet(f"{out}/statement_values").collect()] == [1000.0]
    with pytest.raises(ValueError, match="no statements"):
        A.export_company(*args, "B", out)
    with pytest.raises(ValueError, match="no ticker"):
        A.export_company(*args, "Z", out)


def test_display(spark):
    df = spark.sql(
        "select timestamp_ntz'2025-01-02 03:04:05' t, date'2025-01-02' d, 1234567 i, 1234.5D f, true b, 'x' s, "
        "cast(null as int) n"
    )
    assert tuple(A.display(df).first()) == ("2025-01-02 03:04", "2025-01-02", "1,234,567", "1,234.50", "TRUE", "x", None)


def test_company_without_any_listing_is_rejected(spark, tmp_path):
    companies, _ = A.read_registry(spark, registry(tmp_path))
    rows = spark.createDataFrame([index_row("0012", 0, "x", "1", "u")], INDEX_ROWS)
    missing = {row.company_id: row.errors for row in A.missing_listings(companies, rows).collect()}
    assert missing == {"30444444444": ["index: missing"], "30222222222": ["index: missing"]}


def tables_of(spark, *rows):
    """A bundle of (ticker, value of its values table or None)."""
    values = [(f"c{t}", t, 1, 1, v) for t, v in rows if v is not None]
    return A.sinks.bundle.ExportTables(
        spark.createDataFrame([(f"c{t}", t, 0, "id", "x") for t, _ in rows], "company_id string, ticker string, field_pos int, field string, value string"),
        spark.createDataFrame([(f"c{t}", t, 1) for t, _ in rows], "company_id string, ticker string, statement_pos long"),
        spark.createDataFrame(values, "company_id string, ticker string, statement_pos long, pos long, value string"),
    )


def test_bundle_leaves_no_stale_rows(spark, tmp_path):
    out = str(tmp_path / "stale")
    odd = "B/1 %="
    A.write_bundle(tables_of(spark, ("A", "old"), (odd, "old"), ("C", "kept"), (None, "nameless")), out)
    A.write_bundle(tables_of(spark, ("A", None), (odd, None), (None, None)), out)
    found = spark.read.parquet(f"{out}/statement_values").collect()
    assert [(row.ticker, row.value) for row in found] == [("C", "kept")]
    assert spark.read.parquet(f"{out}/statement_metadata").count() == 4


def test_a_table_that_cannot_be_written_does_not_stop_the_others(spark, tmp_path):
    tables = tables_of(spark, ("A", "v"))
    broken = tables._replace(statement_metadata=tables.statement_metadata.selectExpr("company_id", "ticker", "raise_error('bad') as statement_pos"))
    with pytest.raises(Exception, match="bad") as problem:
        A.write_bundle(broken, str(tmp_path / "partly"))
    assert problem.value.__notes__ == ["table statement_metadata"]
    assert spark.read.parquet(str(tmp_path / "partly" / "statement_values")).count() == 1


def test_run_names_the_table_that_failed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("asiento.plans.batch.write_bundle", lambda *args: 1 / 0)
    with pytest.raises(A.plans.ExportError, match="bundle: division"):
        run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/out/rejects").count() > 0 and spark.read.parquet(f"{tmp_path}/out/report").count() == 3


def test_partitions_are_written_from_one_reading_of_the_table(spark, tmp_path):
    """The table is not computed again to find what it has no rows for: here its files are gone by then."""
    out = str(tmp_path / "once")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "ticker string, value long")
    write_partitions(rows, out, "ticker", rows)
    table = spark.read.schema(rows.schema).parquet(out).filter("ticker = 'a' or value = 4")
    write_partitions(table, out, "ticker", rows.filter("ticker is null or ticker <> 'c'"))
    found = spark.read.schema(rows.schema).parquet(out).collect()
    assert sorted((row.value, row.ticker) for row in found) == [(1, "a"), (3, "c"), (4, None)]
