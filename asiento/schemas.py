"""Schemas of the stored zones and the names of the shared key columns.

Raw zones are all text: nothing is inferred, so identifiers such as ``0012`` keep their zeros.
Row order is data (``page_no``, ``row_no`` or a position built from them), never a by-product of a scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One filing of one company: the position of the filing in the company's index.
FILING_KEY = ["company_id", "filing_pos"]

COMPANY_FIELDS = [
    "company_id", "name", "ticker", "description", "sector", "industry_group", "industry",
    "sub_industry", "sub_industry_description",
]

DOCUMENT_FIELDS = ["document_id", "document_description", "document_link", "submission_date"]

_ROW_BITS = 40


def position(page_no: Column | str, row_no: Column | str) -> Column:
    """Order of a row over all pages of its list, as one BIGINT (2^23 pages of 2^40 rows)."""
    page = F.col(page_no) if isinstance(page_no, str) else page_no
    row = F.col(row_no) if isinstance(row_no, str) else row_no
    return F.shiftleft(page.cast("bigint"), _ROW_BITS) + row.cast("bigint")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


INDEX_ROWS = T.StructType(
    [
        T.StructField("company_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("hrefs", T.ArrayType(T.StringType())),
    ]
)

#: Rendered captures of the pages of a filing; ``page_no`` is the page of the value table it shows.
FILING_PAGES = T.StructType(
    _strings("company_id", "document_link")
    + [T.StructField("page_no", T.IntegerType())]
    + _strings("url", "html")
)

FILINGS_RAW = T.StructType(
    _strings("company_id", *DOCUMENT_FIELDS) + [T.StructField("filing_pos", T.LongType())]
)

CONCEPTS_RAW = T.StructType(
    [
        T.StructField("company_id", T.StringType()),
        T.StructField("filing_pos", T.LongType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)

TAXONOMY = T.StructType(_strings("source_label", "concept"))
