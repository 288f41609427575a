from datetime import date, datetime

import pytest

import asiento as A
from asiento.schemas import CONCEPTS_RAW

GOOD = {
    "company_id": "c1",
    "filing_pos": 0,
    "document_id": "1.234",
    "document_description": "FECHA CIERRE: 2025-03-31 - TIPO BALANCE: INDIVIDUAL",
    "document_link": "https://filings.example.com/1",
    "submission_date": "13 oct. 2025 14:20",
    "reporting_period": "Trimestral",
    "period_end_date": "",
    "financial_statements_type": "Consolidado",
    "presentation_currency": "Pesos",
    "unit_of_measure": "Miles de $",
    "accounting_standards_applied": "NIIF",
    "merger_or_demerger_in_process": "No",
    "treasury_shares": "Sí",
    "insolvency_proceedings": "No",
    "public_offering_of_equity_instruments": "Si",
    "subscribed_shares_at_period_end": "1.000.000",
    "equity_share_price_at_period_end": "12,50",
    "price_earnings_ratio": "",
    "market_capitalization": "x",
    "free_float_percentage": "33,3",
    "number_of_employees": "250",
}
SCHEMA = ", ".join(f"{name} {'long' if name == 'filing_pos' else 'string'}" for name in GOOD)


def clean(spark, statements, lines, **options):
    raw = spark.createDataFrame([tuple((GOOD | change).values()) for change in statements], SCHEMA)
    rows = [("c1", pos, 1, i, label, value, order) for i, (pos, label, value, order) in enumerate(lines)]
    concepts = spark.createDataFrame(rows, CONCEPTS_RAW)
    return A.clean_statements(raw, concepts, A.taxonomy_table(spark, {"VENTAS": "Sales", "CAJA": "Cash"}), **options)


def test_typed_statement(spark):
    tables = clean(spark, [{}], [(0, "Ventas", "1.234,5", "1"), (0, "Otra", "-2", "1.002")])
    (row,) = tables.statements.collect()
    assert tuple(row) == (
        "c1", 1234, GOOD["document_description"], GOOD["document_link"], datetime(2025, 10, 13, 14, 20),
        "Quarter", date(2025, 3, 31), "Consolidated", "Pesos", "IFRS", False, True, False, True,
        1000000, 12.5, 33.3, 250, 0, 0,
    )
    kinds = dict(tables.statements.dtypes)
    assert kinds["submission_date"] == "timestamp_ntz" and kinds["period_end_date"] == "date"
    found = [tuple(row)[1:5] for row in tables.statement_values.orderBy("pos").collect()]
    assert found == [(1234, 1, "Sales", 1234500.0), (1234, 1002, "Otra", -2000.0)]
    assert tables.rejects.count() == 0


def test_repeated_concept_keeps_last_value_at_first_place(spark):
    lines = [(0, "VENTAS", "1", "1"), (0, "CAJA", "2", "2"), (0, "ventas", "3", "9")]
    rows = clean(spark, [{}], lines).statement_values.orderBy("statement_pos", "pos").collect()
    assert [(row.concept, row.value, row.order) for row in rows] == [("Sales", 3000.0, 9), ("Cash", 2000.0, 2)]


@pytest.mark.parametrize(
    "change",
    [
        {"equity_share_price_at_period_end": " "},
        {"number_of_employees": "1,5"},
        {"free_float_percentage": ""},
        {"subscribed_shares_at_period_end": None},
        {"unit_of_measure": "miles de $"},
        {"treasury_shares": "SI"},
        {"submission_date": "30 feb. 2025 10:00"},
        {"document_description": "", "period_end_date": ""},
        {"reporting_period": "x"},
        {"accounting_standards_applied": ""},
        {"document_id": "A1"},
    ],
)
def test_one_bad_field_rejects_the_statement(spark, change):
    tables = clean(spark, [change], [(0, "Ventas", "1", "1")])
    assert tables.statements.count() == 0
    assert tables.statement_values.count() == 0
    (reject,) = tables.rejects.collect()
    assert len(reject.errors) >= 1 and reject.stage == "clean"


def test_currency_may_be_missing(spark):
    assert clean(spark, [{"presentation_currency": None}], []).statements.count() == 1


def test_one_bad_line_rejects_its_statement_only(spark):
    statements = [{}, {"filing_pos": 1, "document_id": "2"}]
    lines = [(0, "Ventas", "1", "1"), (0, "Caja", "", "2"), (1, "Ventas", "5", "1"), (1, "Caja", "6", "2")]
    tables = clean(spark, statements, lines)
    assert {row.document_id for row in tables.statement_values.collect()} == {2}
    (reject,) = tables.rejects.collect()
    assert reject.document_id == "1.234" and reject.errors == ["value: unreadable lines: 1"]


def test_all_errors_are_kept(spark):
    tables = clean(spark, [{"treasury_shares": "", "document_id": None}], [(0, "x", "?", "?")])
    (reject,) = tables.rejects.collect()
    assert reject.errors == [
        "document_id: missing", "treasury_shares: ", "value: unreadable lines: 1", "id: unreadable lines: 1",
    ]


def test_statement_without_lines_is_valid(spark):
    tables = clean(spark, [{}], [])
    assert tables.statements.count() == 1 and tables.statement_values.count() == 0


def test_same_document_id_last_clean_filing_wins(spark):
    statements = [
        {"document_id": "1.234"},
        {"filing_pos": 1, "document_id": "7"},
        {"filing_pos": 2, "document_id": "1234"},
        {"filing_pos": 3, "document_id": "1234", "treasury_shares": "?"},
    ]
    lines = [(0, "Ventas", "1", "1"), (0, "Caja", "1", "2"), (2, "Ventas", "2", "1"), (3, "Ventas", "3", "1")]
    tables = clean(spark, statements, lines)
    found = {(row.document_id, row.filing_pos, row.statement_pos) for row in tables.statements.collect()}
    assert found == {(1234, 2, 0), (7, 1, 1)}
    assert [(row.concept, row.value) for row in tables.statement_values.collect()] == [("Sales", 2000.0)]


def test_unscaled_concepts(spark):
    lines = [(0, "Ventas", "2", "1"), (0, "Liquidez", "2", "2")]
    tables = clean(spark, [{}], lines, unscaled_concepts=["Liquidez"])
    assert {row.concept: row.value for row in tables.statement_values.collect()} == {"Sales": 2000.0, "Liquidez": 2.0}


def test_heavy_filings_give_the_same_values(spark, monkeypatch):
    statements = [{"filing_pos": i, "document_id": str(i)} for i in range(6)]
    lines = [(i % 6, f"label {j % 7}", str(j), str(j)) for i in range(6) for j in range(10)]
    lines += [(0, f"label {j % 11}", str(j), str(j)) for j in range(200)]
    plain = sorted(clean(spark, statements, lines).statement_values.collect())
    monkeypatch.setattr("asiento.operators.clean.heavy_keys.__defaults__", ("n", 100))
    split = clean(spark, statements, lines).statement_values
    assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(split.collect()) == plain
