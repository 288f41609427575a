"""Filing indexes: captured table rows to filings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.functions import blank_to_null, dmy_text
from asiento.operators.filters import filter_by_date
from asiento.operators.joins import spread_join
from asiento.schemas import position

# Headers of the index columns that are read.
DATE_HEADER = "FECHA"
TIME_HEADER = "HORA"
DESCRIPTION_HEADER = "DESCRIPCIÓN"
DOCUMENT_HEADER = "DOCUMENTO"
LINK_HEADER = "VER"


def listing_request(company_id: Column | str, date_from: date, date_to: date) -> Column:
    """Path and query of a company's listing of filings in a range of days, below the site's address."""
    company = F.col(company_id) if isinstance(company_id, str) else company_id
    return F.concat(
        F.lit("Empresa/"), company, F.lit("?formType=INFOFI&fdesde="), dmy_text(F.lit(date_from)),
        F.lit("&fhasta="), dmy_text(F.lit(date_to)),
    )


def _bound_header() -> Column:
    return F.transform("header", lambda text: F.coalesce(blank_to_null(text), F.lit("column")))


def _cell(values: str, header: str, headers: Column | str = "_header") -> Column:
    # A header that is absent has position 0, and there is no value at -1.
    return F.get(values, F.array_position(headers, header).cast("int") - 1)


def submission_text() -> Column:
    """Date and time of an index row as they are written there; null if one of them is absent."""
    headers = _bound_header()
    return F.concat(_cell("cells", DATE_HEADER, headers), F.lit(" "), _cell("cells", TIME_HEADER, headers))


def parse_index(
    rows: DataFrame, date_from: date | None = None, date_to: date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Index rows (schema ``INDEX_ROWS``) to ``(filings, failed_companies)``.

    Cells are bound by header. The first row of a page is the header's own. One row without a link or
    without one of the columns fails its whole company, whatever the other rows hold; rows submitted
    outside the range of days, if one is given, do not count.
    """
    bound = (
        rows.filter("row_no > 0")
        .withColumn("_header", _bound_header())
        .select(
            "company_id",
            position("page_no", "row_no").alias("filing_pos"),
            _cell("cells", DOCUMENT_HEADER).alias("document_id"),
            _cell("cells", DESCRIPTION_HEADER).alias("document_description"),
            _cell("hrefs", LINK_HEADER).alias("document_link"),
            _cell("cells", DATE_HEADER).alias("_date"),
            _cell("cells", TIME_HEADER).alias("_time"),
        )
    )
    bound = bound.withColumn("submission_date", F.concat("_date", F.lit(" "), "_time"))
    if date_from is not None and date_to is not None:
        bound = filter_by_date(bound, date_from, date_to)
    needed = ["document_id", "document_description", "submission_date"]
    unreadable = F.lit(False)
    for name in needed:
        unreadable = unreadable | F.col(name).isNull()
    linkless = F.col("document_link").isNull()

    failed = (
        bound.filter(unreadable | linkless)
        .groupBy("company_id")
        .agg(F.bool_or(unreadable).alias("_cells"), F.bool_or(linkless).alias("_links"))
        .select(
            "company_id",
            F.lit(None).cast("string").alias("document_id"),
            F.lit("listing").alias("stage"),
            F.array_compact(
                F.array(
                    F.when(F.col("_cells"), F.lit("index: column missing")),
                    F.when(F.col("_links"), F.lit("index: link missing")),
                )
            ).alias("errors"),
        )
    )
    filings = spread_join(
        bound.filter(~unreadable & ~linkless),
        failed.select("company_id"),
        ["company_id"],
        ["filing_pos"],
        "left_anti",
    ).select(
        "company_id",
        "document_id",
        "document_description",
        "document_link",
        "submission_date",
        "filing_pos",
    )
    return filings, failed


def missing_listings(companies: DataFrame, rows: DataFrame) -> DataFrame:
    """Companies of which no index row was captured, not even a header: their listing failed."""
    return (
        companies.select("company_id")
        .distinct()
        .join(rows.select("company_id").distinct(), "company_id", "left_anti")
        .select(
            "company_id",
            F.lit(None).cast("string").alias("document_id"),
            F.lit("listing").alias("stage"),
            F.array(F.lit("index: missing")).alias("errors"),
        )
    )
