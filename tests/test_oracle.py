"""Every registered query against its SQL."""

import pytest

from workload import shapes
from workload.compare import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    assert differences(spark, db, name, SF) == []


def test_stored_tables_hold_what_is_rendered(spark):
    for table in (shapes.filings, shapes.raw_lines, shapes.registry, shapes.value_pages):
        rendered, stored = table.__wrapped__(spark, SF), table(spark, SF)
        assert rendered.columns == stored.columns
        assert rendered.exceptAll(stored).isEmpty() and stored.exceptAll(rendered).isEmpty()
