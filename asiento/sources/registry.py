"""The company registry: a table bound by header names, read as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.functions import blank_to_null
from asiento.operators.keyed import keep_last
from asiento.schemas import COMPANY_FIELDS
from asiento.sources.tables import scan

# Column of the source -> company field.
COLUMN_MAPPING = {
    "cuit": "company_id",
    "company_name": "name",
    "ticker": "ticker",
    "company_description": "description",
    "sector": "sector",
    "industry_group": "industry_group",
    "industry": "industry",
    "subindustry": "sub_industry",
    "subindustry_definition": "sub_industry_description",
}


def read_registry(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    column_mapping: Mapping[str, str] | None = None,
    row_position: str | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Read a registry; returns ``(companies, rejects)``.

    Columns are bound by the header of each file. ``multi_line`` allows line ends within quoted CSV fields.

    ``row_position`` names a source column that orders the rows. Without it their order in the file
    counts: file, block of the file, and row within the block.
    """
    try:
        source, names = scan(spark, path, fmt, multi_line)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no registry at {path}") from problem
        raise
    if row_position is not None and row_position not in names:
        raise ValueError(f"no column {row_position!r} to order the registry by; it has: {sorted(names)}")
    order = F.col(f"`{names[row_position]}`") if row_position else _order_in_files()
    return load_registry(source, order, column_mapping, names)


def _order_in_files() -> Column:
    # The running number only orders rows of one block, which one task reads from top to bottom.
    return F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )


def load_registry(
    source: DataFrame,
    row_position: Column | str,
    column_mapping: Mapping[str, str] | None = None,
    headers: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Companies of a source table: one per ticker, the last row of a ticker at the place of its first.

    Rows without id or name are set aside; rows with nothing in them are skipped.
    """
    mapping = dict(COLUMN_MAPPING if column_mapping is None else column_mapping)
    headers = {name: name for name in source.columns} if headers is None else headers
    missing = set(mapping) - set(headers)
    if missing:
        raise ValueError(
            f"columns missing from the registry: {sorted(missing)}; it has: {sorted(headers)}"
        )

    order = F.col(row_position) if isinstance(row_position, str) else row_position
    fields = {field: blank_to_null(F.col(f"`{headers[name]}`").cast("string")) for name, field in mapping.items()}
    absent = [field for field in COMPANY_FIELDS if field not in fields]
    nothing = F.lit(True)
    for column in headers.values():
        nothing = nothing & (F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")) == "")

    rows = source.filter(~nothing).select(
        *[value.alias(field) for field, value in fields.items()],
        *[F.lit(None).cast("string").alias(field) for field in absent],
        order.alias("registry_row"),
    )
    complete = F.col("company_id").isNotNull() & F.col("name").isNotNull()
    companies = keep_last(rows.filter(complete), ["ticker"], "registry_row", "registry_pos")
    rejects = rows.filter(~complete).select(
        "company_id",
        F.lit(None).cast("string").alias("document_id"),
        F.lit("registry").alias("stage"),
        F.array_compact(
            F.array(
                F.when(F.col("company_id").isNull(), F.lit("company_id: missing")),
                F.when(F.col("name").isNull(), F.lit("name: missing")),
            )
        ).alias("errors"),
    )
    return companies.select(*COMPANY_FIELDS, "registry_pos"), rejects


def get_company(companies: DataFrame, ticker: str) -> DataFrame:
    """The row of one ticker; an error naming some that exist if there is none."""
    found = companies.filter(F.col("ticker") == ticker)
    if found.isEmpty():
        some = [row.ticker for row in companies.select("ticker").limit(20).collect()]
        raise ValueError(f"no ticker {ticker!r}; the registry has, among others: {some}")
    return found
