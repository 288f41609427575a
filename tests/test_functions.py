from datetime import date, datetime

from asiento import functions as C


def check(evaluate, function, cases):
    assert evaluate(function, list(cases)) == list(cases.values())


def test_number(evaluate):
    check(evaluate, C.es_number, {
        "1.234,56": 1234.56, "-5": -5.0, ",5": 0.5, "5,": 5.0, "": None, "  ": None, None: None,
        "(1.234)": None, "1d": None, "1f": None, "nan": None, "inf": None, "1.234": 1234.0, " 7 ": 7.0,
        "\xa07\t": 7.0, "1e5": 100000.0, "+5": 5.0, "1,2,3": None, ".": None, "1 2": None, "0x10": None,
        ". 5": 5.0,
    })


def test_int(evaluate):
    check(evaluate, C.es_int, {
        "1.234": 1234, "1.234,00": None, "12,5": None, " 7 ": 7, " 7\x1f": 7, "-3": -3, "+3": 3,
        "": None, None: None, "30.111.111.111": 30111111111, "99999999999999999999": None, "1e3": None,
        "5,": None, "7L": None,
    })


def test_flag(evaluate):
    check(evaluate, C.es_bool, {
        "Si": True, "Sí": True, "No": False, "SI": None, "no": None, "": None, " Si": None, None: None,
    })


def test_timestamp(evaluate):
    check(evaluate, C.es_timestamp, {
        "13 oct. 2025 14:20": datetime(2025, 10, 13, 14, 20),
        " 1 ene. 2025 1:02\n": datetime(2025, 1, 1, 1, 2),
        "13 10 2025 14:20": datetime(2025, 10, 13, 14, 20),
        "13 oct. 2025 14 20": datetime(2025, 10, 13, 14, 20),
        "13 oct. 24 00:00": datetime(24, 10, 13),
        "1 sept. 2025 1:02": None,
        "1 Oct. 2025 1:02": None,
        "1  oct. 2025 1:02": None,
        "30 feb. 2025 01:02": None,
        "1 oct. 2025 25:00": None,
        "1 oct. 2025 10:60": None,
        "1 oct. 2025 10:20:30": None,
        "1 oct. 2025": None,
        "1 oct. 0 10:00": None,
        "1 oct. 12025 10:00": None,
        "2025-10-13 14:20:00": None,
        "": None,
        None: None,
    })


def test_every_month(evaluate):
    names = "ene feb mar abr may jun jul ago sep oct nov dic".split()
    found = evaluate(C.es_timestamp, [f"2 {name}. 2025 03:04" for name in names])
    assert found == [datetime(2025, month, 2, 3, 4) for month in range(1, 13)]


def test_form_date(evaluate):
    check(evaluate, C.dmy_date, {
        "31/12/2024": date(2024, 12, 31), "01/01/2023": date(2023, 1, 1), "31/ 12/2024": date(2024, 12, 31),
        "1/1/24": date(24, 1, 1), "31/2/2024": None, "1/1/0": None, "1/1/99999": None, "2024-12-31": None,
        "1/1": None, "1/1/2024/1": None, "a/b/c": None, "": None, None: None,
    })


def test_description_date(evaluate):
    check(evaluate, C.description_date, {
        "X - FECHA CIERRE: 2025-11-30 - Y": date(2025, 11, 30),
        "FECHA  CIERRE :2024-12-31": date(2024, 12, 31),
        "FECHA\xa0CIERRE: 2024-12-31": date(2024, 12, 31),
        "fecha cierre: 2025-11-30": None,
        "FECHA CIERRE: 2025-02-30": None,
        "FECHA CIERRE: 0000-01-01 FECHA CIERRE: 2025-01-01": None,
        "FECHA CIERRE: 2025-02-30 FECHA CIERRE: 2025-01-01": None,
        "FECHA CIERRE: 2025-1-1": None,
        "": None,
        None: None,
    })


def test_resolved_date(evaluate):
    text = "FECHA CIERRE: 2025-11-30"
    assert evaluate(C.period_end_date, [(text, "31/12/2024"), (text, "x"), ("", "1/2/2024"), ("", "")]) == [
        date(2024, 12, 31), date(2025, 11, 30), date(2024, 2, 1), None,
    ]


def test_period(evaluate):
    check(evaluate, C.period_from_metadata, {
        "trimestral": "Quarter", "ANUAL": "Annual", "Semestral": "Semester", "1": "Annual", "2": "Semester",
        "3": "Quarter", "irregular": "Irregular", "": None, " anual": None, None: None,
    })
    check(evaluate, C.period_from_description, {
        "PERIODICIDAD: 3": "Quarter", "PERIODICIDAD :ANUAL - X": "Annual", "PERIODICIDAD: anual": None,
        "PERIODICIDAD: ANUALÍSIMO": None, "x": None, None: None,
    })
    assert evaluate(C.reporting_period, [("PERIODICIDAD: 3", "Anual"), ("PERIODICIDAD: 3", "x")]) == [
        "Annual", "Quarter",
    ]


def test_type(evaluate):
    check(evaluate, C.type_from_metadata, {
        "Consolidado": "Consolidated", "individual": "Separate", "x": None, None: None,
    })
    check(evaluate, C.type_from_description, {
        "TIPO BALANCE: INDIVIDUAL": "Separate", "TIPO  BALANCE:CONSOLIDADO - X": "Consolidated",
        "TIPO BALANCE: CONSOLIDADÓ": None, "TIPO BALANCE: individual": None, None: None,
    })
    assert evaluate(C.statement_type, [("TIPO BALANCE: INDIVIDUAL", "Consolidado"), ("", "")]) == [
        "Consolidated", None,
    ]


def test_standard(evaluate):
    check(evaluate, C.standard_from_description, {
        "NORMA CONTABLE: NIIF - X": "IFRS",
        "NORMA CONTABLE: RT": "Argentine GAAP (RT)",
        "NORMA CONTABLE: RT\n": "Argentine GAAP (RT)",
        "NORMA CONTABLE: NORMAS CONTABLES PROFESIONALES-": "Argentine GAAP",
        "NORMA CONTABLE: NIIF PERIODICIDAD: 3": None,
        "NORMA CONTABLE: niif": None,
        "NORMA CONTABLE: -": None,
        None: None,
    })
    assert evaluate(C.accounting_standard, [("NORMA CONTABLE: NIIF", "rt"), ("NORMA CONTABLE: NIIF", "")]) == [
        "Argentine GAAP (RT)", "IFRS",
    ]


def test_unit(evaluate):
    check(evaluate, C.unit_multiplier, {
        "Unit": 1.0, "$": 1.0, "Thousands": 1e3, "Miles de $": 1e3, "Millions": 1e6, "Millones de $": 1e6,
        "miles de $": None, "": None, None: None,
    })


def test_text(evaluate):
    everything = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"
    assert evaluate(C.strip, [f"{everything}a b{everything}", everything, None]) == ["a b", "", None]
    assert evaluate(C.first_non_empty, [(None, " x "), ("\xa0", None), ("a", "b")]) == ["x", "", "a"]
    contains = lambda c: C.contains_any(c, ["OTROS (idiomas)", "A.b"])
    assert evaluate(contains, ["otros (IDIOMAS) x", "a.B", "aXb", "", None]) == [True, True, False, False, False]
    assert evaluate(lambda c: C.contains_any(c, []), ["x"]) == [False]
    assert evaluate(lambda c: C.contains_ignore_case(c, "Ñu"), ["xñUx", "x"]) == [True, False]
