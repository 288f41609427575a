import duckdb
import pytest

from asiento.llm import line_dedup as L
from asiento.llm.queries import ORACLE

ROWS = (
    [(i, f"Menu\nline {i}\n\n  Menu \nend {i}", "a") for i in range(20)]
    + [(100 + i, f"Menu\nother {i}", "b") for i in range(4)]
    + [(200 + i, f"own {i}" + ("\nrare" if i < 5 else "\nMENU"), "c") for i in range(60)]
    + [(300, None, "a"), (301, "", "a"), (302, "Menu", "a"), (302, "Menu", "a"), (303, "Menu\nfree", None)]
    + [(304, "x" * 300_000 + "\nMenu\n" + "y\n" * 20_000, "a")]
)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


def slow(rows, ratio=0.1, least=2):
    pages, lines = {}, {}
    for _, text, host in rows:
        if host is not None:
            pages[host] = pages.get(host, 0) + 1
            for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
                lines[host, line] = lines.get((host, line), 0) + 1
    out = []
    for i, text, host in rows:
        parts = [] if text is None else text.split("\n")
        kept = [x for x in parts if not ((n := lines.get((host, x.strip(" ")), 0)) >= least and n > ratio * pages[host])]
        out.append((i, None if text is None else "\n".join(kept), len(parts) - len(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.dropped_lines) for r in df.collect()), key=str)


def test_against_brute_force(docs):
    got = rows_of(L.drop_boilerplate(docs))
    assert got == slow(ROWS)
    assert (302, "", 1) in got and (303, "Menu\nfree", 0) in got and (100, "other 0", 1) in got


def test_salted_path(docs, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", -1)
    assert rows_of(L.drop_boilerplate(docs)) == slow(ROWS)


def test_a_caller_may_ask_for_more_pages(docs):
    assert rows_of(L.drop_boilerplate(docs, least_pages=5)) == slow(ROWS, least=5) != slow(ROWS)


def test_sql(docs):
    documents = docs.toPandas()  # noqa: F841  read by DuckDB by its name
    wanted = duckdb.sql(ORACLE["op6_line_dedup"]).fetchall()
    got = L.drop_boilerplate(docs).select("doc_id", "source", "text", "dropped_lines").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_clashing_columns_and_empty_table(spark, docs):
    odd = docs.selectExpr("*", "1 as host", "2 as line", "'h' as host_key", "3 as dropped_lines", "4 as salt", "5 as left_lines")
    out = L.drop_boilerplate(odd)
    assert out.columns == [*odd.columns, "dropped_lines_2"] and out.count() == len(ROWS)
    assert L.drop_boilerplate(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(docs, plan):
    assert "Python" not in plan(L.drop_boilerplate(docs)) and "Python" not in plan(L.boilerplate(docs))


def test_copies_of_a_document_keep_its_lines_in_the_pipeline(spark):
    import corpus_pipeline

    rows = [(i, f"Menu\nown {i}", "a", 0) for i in range(20)] + [(100 + i, "Menu\nfirst\nsecond", "a", 0) for i in range(10)]
    rows += [(200 + i, "short\ncopy", "b", 0) for i in range(5)] + [(300, None, "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert all(got[100 + i] == ("first\nsecond", 12) for i in range(10)) and got[3] == ("own 3", 5)
    assert all(got[200 + i] == ("short\ncopy", 10) for i in range(5)) and got[300] == (None, None)


def test_copies_once_without_copies(spark):
    rows = [(i, text and f"{text}\n#{i}", host) for i, (_, text, host) in enumerate(ROWS) if text]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert rows_of(L.drop_boilerplate(docs, copies_once=True)) == rows_of(L.drop_boilerplate(docs)) == slow(rows)
