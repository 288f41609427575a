"""The three tables exported per company, partitioned by ticker."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.operators.clean import FLAGS
from asiento.operators.joins import dimension_join
from asiento.sources.registry import get_company

# Names of the exported company fields, in order.
COMPANY_EXPORT = {
    "id": "company_id",
    "name": "name",
    "ticker": "ticker",
    "description": "description",
    "sector": "sector",
    "industry_group": "industry_group",
    "industry": "industry",
    "sub_industry": "sub_industry",
    "sub_industry_description": "sub_industry_description",
}

# Names of the exported statement columns, in order.
STATEMENT_EXPORT = {
    "document_id": "document_id",
    "document_description": "document_description",
    "submission_date": "submission_date",
    "period_end_date": "period_end_date",
    "reporting_period": "reporting_period",
    "financial_statements_type": "financial_statements_type",
    "currency": "presentation_currency",
    "accounting_standards": "accounting_standards_applied",
    **{flag: flag for flag in FLAGS},
    "subscribed_shares": "subscribed_shares_at_period_end",
    "share_price": "equity_share_price_at_period_end",
    "free_float_percentage": "free_float_percentage",
    "number_of_employees": "number_of_employees",
}

#: Rows per written file; a ticker with more gets several files.
FILE_ROWS = 5_000_000
#: Keys that a write may fail for; with more the trouble is not with the keys.
MOST_FAILURES = 100
_HASHES = 1 << 30


class ExportTables(NamedTuple):
    company_metadata: DataFrame
    statement_metadata: DataFrame
    statement_values: DataFrame


def company_metadata(companies: DataFrame, statements: DataFrame) -> DataFrame:
    """Nine rows ``field, value`` per company; companies without a statement are left out."""
    exported = companies.join(statements.select("company_id").distinct(), "company_id", "left_semi")
    pairs = F.array(
        *[
            F.struct(F.lit(field).alias("field"), F.col(source).cast("string").alias("value"))
            for field, source in COMPANY_EXPORT.items()
        ]
    )
    return exported.select(
        "company_id", "ticker", F.posexplode(pairs).alias("field_pos", "_pair")
    ).select("company_id", "ticker", "field_pos", "_pair.*")


def statement_metadata(statements: DataFrame) -> DataFrame:
    """The exported columns of the statements, with the company and the place in its list."""
    return statements.select(
        "company_id",
        *[F.col(source).alias(name) for name, source in STATEMENT_EXPORT.items()],
        "statement_pos",
    )


def statement_values_export(values: DataFrame) -> DataFrame:
    """The exported columns of the values, with the company and the places that order them."""
    return values.select(
        "company_id", "document_id", "order", "concept", "value", "statement_pos", "pos"
    )


def export_tables(companies: DataFrame, statements: DataFrame, values: DataFrame) -> ExportTables:
    """The three tables with a ``ticker`` each; a company under two tickers is exported under both."""
    tickers = companies.select("company_id", "ticker")
    by_ticker = [
        dimension_join(table, tickers, ["company_id"], spread_by)
        for table, spread_by in (
            (statement_metadata(statements), ["statement_pos"]),
            (statement_values_export(values), ["statement_pos", "pos"]),
        )
    ]
    return ExportTables(company_metadata(companies, statements), *by_ticker)


def write_bundle(tables: ExportTables, path: str, fmt: str = "parquet") -> None:
    """Write the tables below ``path``, replacing the tickers of ``company_metadata`` and no others.

    A ticker without rows in one of the tables has none there afterwards, whatever was written before.
    Rows are in order: statements as first listed, values as first listed in their statement. Ranges
    of that order, not whole tickers, are distributed, so a large ticker is written by many tasks. A table
    that cannot be written does not keep the others from being written; the first problem is raised then.
    """
    orders = {
        "company_metadata": ["field_pos"],
        "statement_metadata": ["statement_pos"],
        "statement_values": ["statement_pos", "pos"],
    }
    tickers, problem = tables.company_metadata.select("ticker").distinct(), None
    for name, table in tables._asdict().items():
        order = ["ticker", "company_id", *orders[name]]
        try:
            write_partitions(table, f"{path}/{name}", "ticker", tickers, order, fmt)
        except Exception as failed:  # the other tables are written before it is raised
            failed.add_note(f"table {name}")
            problem = problem or failed
    if problem is not None:
        raise problem


class FailedKey(NamedTuple):
    """A key whose rows could not be written, and why."""

    key: str | None
    reason: str


def write_apart(
    write: Callable[[Callable[[DataFrame], DataFrame]], None], keys: DataFrame, by: str, most: int = MOST_FAILURES
) -> list[FailedKey]:
    """Write all that can be written; the keys that cannot be, with the reasons.

    ``write`` is given a function that restricts a table to the rows of some keys, by its column ``by``, and
    writes the tables so restricted; ``keys`` has the keys in a column of that name. All keys are written
    together. Where that fails they are halved by their hashes, until a bad one stands alone: a bad key
    among n costs about 2 log2(n) more writes. Beyond ``most`` failures, and if no key can be written, the last
    problem is raised.
    """
    failed: list[FailedKey] = []
    problems: list[Exception] = []

    def attempt(low: int, high: int, one: FailedKey | None = None) -> None:
        def part(table: DataFrame) -> DataFrame:
            if one:
                return table.filter(F.col(by).eqNullSafe(F.lit(one.key)))
            number = F.pmod(F.xxhash64(by), F.lit(_HASHES))
            return table if (low, high) == (0, _HASHES) else table.filter((number >= low) & (number < high))

        try:
            write(part)
            return
        except Exception as problem:  # whatever it is, it must not keep the other keys from being written
            inside = [FailedKey(row[0], reason_of(problem)) for row in part(keys).select(by).distinct().limit(2).collect()]
            if not inside or len(failed) >= most:
                raise
            if len(inside) == 1:
                failed.append(inside[0])
                problems[:] = [problem]
                return
        if high - low > 1:
            attempt(low, (low + high) // 2)
            attempt((low + high) // 2, high)
        else:  # different keys of one hash
            for row in part(keys).select(by).distinct().limit(most + 1).collect():
                attempt(low, high, FailedKey(row[0], ""))

    attempt(0, _HASHES)
    if failed and keys.select(by).distinct().limit(len(failed) + 1).count() == len(failed):
        raise problems[0]
    return failed


def reason_of(problem: Exception) -> str:
    """The first line of what caused a failure."""
    reason, cause = str(problem), getattr(problem, "_origin", None)
    while cause is not None:
        reason, cause = cause.getMessage() or reason, cause.getCause()
    return (reason.strip().splitlines() or [type(problem).__name__])[0][:500]


def write_bundle_apart(
    tables: ExportTables, path: str, fmt: str = "parquet", write: Callable[[ExportTables, str, str], None] = write_bundle
) -> DataFrame:
    """``write`` the tables of all tickers that can be written; ``ticker, reason`` of the others.

    A ticker that fails may have those of its tables that could be written.
    """
    keys = tables.company_metadata.select("ticker")
    failed = write_apart(lambda part: write(ExportTables(*map(part, tables)), path, fmt), keys, "ticker")
    return keys.sparkSession.createDataFrame(failed, "ticker string, reason string")


def write_partitions(
    table: DataFrame, path: str, by: str, replaced: DataFrame, order: list[str] | None = None, fmt: str = "parquet"
) -> None:
    """Write a table partitioned by a column, so that the values in ``replaced`` have its rows and no others.

    Values outside ``replaced`` are replaced where the table has rows of them, and kept otherwise.
    """
    order = order or [by]
    context = table.sparkSession.sparkContext
    jvm = context._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())

    def stored_files() -> dict[str, set[str]]:
        """The names of the files in each folder of a value."""
        found: dict[str, set[str]] = {}
        top = files.makeQualified(folder).toString().rstrip("/")
        if files.exists(folder):
            listed = files.listFiles(folder, True)
            while listed.hasNext():
                above, parent, name = listed.next().getPath().toString().rsplit("/", 2)
                if above == top and parent.startswith(f"{by}="):
                    found.setdefault(parent, set()).add(name)
        return found

    before = stored_files()
    (
        table.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("header", True)
        .partitionBy(by)
        .save(path)
    )
    # A write names its files anew: folders with the files of before got no rows. So the table is computed once.
    after = stored_files() if before else {}
    stale = {name for name, held in before.items() if held == after.get(name)}
    if not stale:
        return
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in replaced.select(by).distinct().toLocalIterator():
        name = f"{by}={'__HIVE_DEFAULT_PARTITION__' if row[0] is None or row[0] == '' else escape(row[0])}"
        if name in stale:
            files.delete(jvm.org.apache.hadoop.fs.Path(folder, name), True)


def export_company(
    companies: DataFrame,
    statements: DataFrame,
    values: DataFrame,
    ticker: str,
    path: str,
    fmt: str = "parquet",
) -> None:
    """Write the bundle of one ticker; an error if it is unknown or has no statement."""
    tables = export_tables(get_company(companies, ticker), statements, values)
    if tables.company_metadata.isEmpty():
        raise ValueError(f"{ticker}: no statements to export")
    write_bundle(tables, path, fmt)


def display(df: DataFrame) -> DataFrame:
    """Every column as the text a reader is shown; the stored tables stay typed."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm")
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd")
        if kind in ("tinyint", "smallint", "int", "bigint"):
            return F.format_number(column, 0)
        if kind in ("float", "double"):
            return F.format_number(column, 2)
        if kind == "boolean":
            return F.upper(column.cast("string"))
        return column

    return df.select(*[shown(name, kind).alias(name) for name, kind in df.dtypes])
