"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import asiento as A
from asiento import functions as C
from asiento.functions.text import blank_to_null
from asiento.operators import clean
from asiento.operators.clean import accepted_statements, judge_statements, last_lines, line_counts
from asiento.schemas import FILING_KEY, position
from asiento.plans.batch import page_items
from asiento.plans.staging import Staging
from asiento.sinks.bundle import export_tables, write_partitions
from asiento.sources.pages import parse_pages, wanted_ids
from asiento.storage import shared_folder
from workload import shapes
from workload.oracle import NULL

#: Listing range of the dated queries.
DATE_FROM, DATE_TO = date(1996, 1, 1), date(1998, 6, 30)
#: Phrases looked for in whole documents.
DOCUMENT_PHRASES = ["ERTION", "Eaux", "und d", "entre"]

Query = Callable[[SparkSession, str], DataFrame]


def as_text(df: DataFrame) -> DataFrame:
    """Dates, times and flags as ISO text and missing text as empty, for comparison across engines."""

    def shown(name: str, kind: str):
        if kind in ("date", "boolean") or kind.startswith("timestamp"):
            return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
        return F.coalesce(name, F.lit("")).alias(name) if kind == "string" else F.col(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.filings(spark, sf_dir).select(
        "company_id", "document_id", "document_description", "document_link", "submission_date", "filing_pos"
    )


# -- scalar parsers


def es_number_parse(spark, sf_dir):
    return shapes.raw_lines(spark, sf_dir).select(
        position("page_no", "row_no").alias("pos"),
        C.es_int("order_text").alias("order_key"),
        F.coalesce(C.es_number("value"), F.lit(-1.0)).alias("price"),
        C.es_number("quantity_text").alias("returned"),
    )


def es_datetime_parse(spark, sf_dir):
    rows = shapes.filings(spark, sf_dir)
    return as_text(rows.select("orderkey", C.es_timestamp("submission_date").alias("submitted")))


def metadata_date_parse(spark, sf_dir):
    return as_text(
        shapes.filings(spark, sf_dir).select(
            "orderkey",
            C.dmy_date("period_end_date").alias("form_date"),
            C.description_date("document_description").alias("stated_date"),
            C.period_end_date("document_description", "period_end_date").alias("period_end"),
        )
    )


def description_fields(spark, sf_dir):
    text = "document_description"
    return as_text(
        shapes.filings(spark, sf_dir).select(
            "orderkey",
            C.description_date(text).alias("period_end"),
            C.period_from_description(text).alias("period"),
            C.type_from_description(text).alias("type"),
            C.standard_from_description(text).alias("standard"),
        )
    )


def resolved_fields(spark, sf_dir):
    text = "document_description"
    return as_text(
        shapes.filings(spark, sf_dir).select(
            "orderkey",
            C.period_from_metadata("reporting_period").alias("form_period"),
            C.type_from_metadata("financial_statements_type").alias("form_type"),
            C.standard_from_metadata("accounting_standards_applied").alias("form_standard"),
            C.reporting_period(text, "reporting_period").alias("period"),
            C.statement_type(text, "financial_statements_type").alias("type"),
            C.accounting_standard(text, "accounting_standards_applied").alias("standard"),
        )
    )


def flag_parse(spark, sf_dir):
    rows = shapes.filings(spark, sf_dir)
    return as_text(
        rows.select(
            "orderkey",
            C.es_bool("merger_or_demerger_in_process").alias("merger"),
            C.es_bool("treasury_shares").alias("treasury"),
        )
    )


def first_non_empty(spark, sf_dir):
    key = F.col("c_custkey")
    first = F.when(key % 3 == 0, F.lit(" \t  ")).when(key % 3 == 1, F.col("c_mktsegment"))
    second = F.when(key % 5 > 0, F.concat(F.lit(" "), "c_name"))
    return shapes.table(spark, sf_dir, "customer").select(
        "c_custkey", C.first_non_empty(first, second).alias("found")
    )


# -- filters on filings


def exclude_filings(spark, sf_dir):
    return A.exclude_phrases(_filings(spark, sf_dir), A.EXCLUDED_PHRASES)


def exclude_documents(spark, sf_dir):
    documents = shapes.table(spark, sf_dir, "documents")
    return A.exclude_phrases(documents, DOCUMENT_PHRASES, "text").select("doc_id", "lang", "source")


def three_words(spark, sf_dir):
    """All runs of three words of the conversations and the benchmark, as ``phrase``."""
    texts = shapes.table(spark, sf_dir, "conversations").select("text").unionByName(shapes.table(spark, sf_dir, "benchmark").select("text"))
    words = texts.select(F.split(F.lower("text"), " ").alias("w")).filter(F.size("w") > 2)
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, F.lit(3)), " "))
    return words.select(F.explode(runs).alias("phrase")).distinct()


def exclude_many_phrases(spark, sf_dir):
    """Documents without any of tens of thousands of phrases."""
    documents = shapes.table(spark, sf_dir, "documents")
    return A.exclude_phrases(documents, three_words(spark, sf_dir), "text").select("doc_id", "lang", "source")


def date_bounded_filings(spark, sf_dir):
    kept = A.filter_by_date(_filings(spark, sf_dir), DATE_FROM, DATE_TO)
    day = C.es_timestamp("submission_date")
    return as_text(kept.select("company_id", "filing_pos", C.dmy_text(day).alias("submitted")))


def listing_requests(spark, sf_dir):
    companies, _ = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    request = A.listing_request("company_id", DATE_FROM, DATE_TO)
    return companies.select("company_id", request.alias("request"))


def index_rows(spark, sf_dir):
    filings, _ = A.parse_index(shapes.index_rows(spark, sf_dir))
    return filings


def stored_index_filings(spark, sf_dir):
    """Filings of the registered companies in the listing range, from an index stored by month and company."""
    companies, _ = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    target = _written(spark, "index")
    A.write_index(shapes.index_rows(spark, sf_dir), target, buckets=4)
    filings, _ = A.parse_index(A.read_index(spark, target, DATE_FROM, DATE_TO, companies, buckets=4), DATE_FROM, DATE_TO)
    return filings


def failed_listings(spark, sf_dir):
    _, failed = A.parse_index(shapes.index_rows(spark, sf_dir))
    return failed.select("company_id", "stage", F.concat_ws("; ", "errors").alias("errors"))


def drop_separate_set(spark, sf_dir):
    return A.drop_separate_duplicates(_filings(spark, sf_dir))


def drop_separate_sequential(spark, sf_dir):
    return A.drop_separate_duplicates(_filings(spark, sf_dir), mode="sequential")


# -- lines


def _parsed_lines(spark, sf_dir):
    lines = A.parse_lines(shapes.concepts(spark, sf_dir))
    return A.map_labels(lines, shapes.taxonomy(spark))


def map_concepts(spark, sf_dir):
    raw = shapes.raw_lines(spark, sf_dir)
    lines = raw.select("orderkey", position("page_no", "row_no").alias("pos"), "label", C.es_int("id").alias("order"))
    mapped = A.map_labels(lines, shapes.taxonomy(spark), ("orderkey", "pos"))
    return mapped.select("orderkey", "pos", "label", "concept", F.coalesce("order", F.lit(-1)).alias("order"))


def unmapped_labels(spark, sf_dir):
    return A.unmapped_labels(shapes.raw_lines(spark, sf_dir), shapes.taxonomy(spark))


def scaled_values(spark, sf_dir):
    units = shapes.filings(spark, sf_dir).select(
        "orderkey", C.unit_multiplier("unit_of_measure").alias("factor")
    )
    lines = shapes.raw_lines(spark, sf_dir).select(
        "orderkey", position("page_no", "row_no").alias("pos"), C.es_number("value").alias("amount")
    )
    scaled = lines.join(units, "orderkey").withColumn("value", F.col("factor") * F.col("amount"))
    return scaled.filter("value is not null").select("orderkey", "pos", "value")


def concept_last_wins(spark, sf_dir):
    last = last_lines(_parsed_lines(spark, sf_dir))
    return last.select(
        *FILING_KEY,
        "concept",
        F.coalesce("amount", F.lit(-1.0)).alias("amount"),
        F.coalesce("order", F.lit(-1)).alias("order"),
        "pos",
    )


def statement_last_wins(spark, sf_dir):
    numbered = _filings(spark, sf_dir).withColumn("document_id", C.es_int("document_id"))
    return A.keep_last(numbered, ["company_id", "document_id"], "filing_pos", "statement_pos")


# -- registry


def registry_load(spark, sf_dir):
    companies, _ = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    return as_text(companies)


def registry_rejects(spark, sf_dir):
    _, rejects = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    rejects = rejects.select("company_id", "stage", F.concat_ws("; ", "errors").alias("errors"))
    return as_text(rejects)


# -- cleaning and export


def _clean(spark, sf_dir):
    return A.clean_statements(
        shapes.filings(spark, sf_dir), shapes.concepts(spark, sf_dir), shapes.taxonomy(spark)
    )


def clean_statements(spark, sf_dir):
    return as_text(_clean(spark, sf_dir).statements)


def clean_values(spark, sf_dir):
    return _clean(spark, sf_dir).statement_values


def rejected_statements(spark, sf_dir):
    rejects = _clean(spark, sf_dir).rejects
    return rejects.withColumn("errors", F.concat_ws("; ", "errors"))


def rejected_lines(spark, sf_dir):
    found = A.rejected_lines(shapes.concepts(spark, sf_dir))
    return found.withColumn("errors", F.concat_ws("; ", "errors"))


def company_metadata_kv(spark, sf_dir):
    companies, _ = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    return as_text(A.company_metadata(companies, _clean(spark, sf_dir).statements))


def statement_metadata_export(spark, sf_dir):
    return as_text(A.statement_metadata(_clean(spark, sf_dir).statements))


def statement_values_export(spark, sf_dir):
    """Flagship: excluded phrases and duplicate filings out, statements cleaned, values exported."""
    chosen = A.drop_separate_duplicates(
        A.exclude_phrases(shapes.filings(spark, sf_dir), A.EXCLUDED_PHRASES)
    )
    clean = A.clean_statements(chosen, shapes.concepts(spark, sf_dir), shapes.taxonomy(spark))
    return A.statement_values_export(clean.statement_values)


def display_format(spark, sf_dir):
    lines = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_extendedprice",
        F.col("l_shipdate"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
    )
    return A.display(lines)


def run_report(spark, sf_dir):
    """Counters of a run, over steps that are stored as a run stores them."""
    staging = Staging(spark, shared_folder(spark))
    found = staging.store(A.exclude_phrases(shapes.filings(spark, sf_dir), A.EXCLUDED_PHRASES), "found")
    chosen = staging.store(A.drop_separate_duplicates(found), "chosen")
    lines = shapes.concepts(spark, sf_dir)
    counts = staging.store(line_counts(lines), "line_counts")
    judged = staging.store(judge_statements(chosen, counts), "judged")
    accepted = staging.store(accepted_statements(judged), "accepted")
    return A.run_report(
        filings_found=found,
        filings_kept=chosen,
        statements_rejected=clean.rejected_statements(judged),
        statements_exported=accepted,
        values_exported=clean.statement_values(lines, counts, accepted, shapes.taxonomy(spark)),
    )


# -- stored pages


def page_links(spark, sf_dir):
    return A.extract_links(shapes.table(spark, sf_dir, "pages"), ["page_id"])


def page_links_absolute(spark, sf_dir):
    pages = shapes.table(spark, sf_dir, "pages")
    return A.extract_links(pages, ["page_id"], absolute=True).select("page_id", "link_no", "href")


def page_table_rows(spark, sf_dir):
    lists = A.RowShape("links", container="ul", row="li", cell="a")
    rows = A.extract_rows(shapes.table(spark, sf_dir, "pages"), [lists], ["page_id"])
    return rows.select("page_id", "container_no", "row_no", F.get("cells", F.lit(0)).alias("cell"))


def page_controls(spark, sf_dir):
    keys = [*FILING_KEY, "page_no"]
    return A.pivot_items(parse_pages(shapes.form_pages(spark, sf_dir), keys, wanted_ids()))


def _chosen_links(spark, sf_dir):
    return _filings(spark, sf_dir).select("company_id", "document_link", "filing_pos", "document_id")


def page_items_joined(spark, sf_dir):
    """Pages of the filings without an excluded phrase, read in place and joined to their filings."""
    chosen = A.exclude_phrases(_filings(spark, sf_dir), A.EXCLUDED_PHRASES)
    items = page_items(shapes.value_pages(spark, sf_dir), chosen)
    return items.select(*FILING_KEY, "page_no", F.size("rows").alias("n_rows"), F.size("controls").alias("n_controls"))


def value_page_rows(spark, sf_dir):
    filings = _chosen_links(spark, sf_dir)
    items = page_items(shapes.value_pages(spark, sf_dir), filings)
    failed = A.failed_captures(filings, items).select(*FILING_KEY)
    return A.value_rows(items).join(failed, FILING_KEY, "left_anti")


def failed_captures(spark, sf_dir):
    filings = _chosen_links(spark, sf_dir)
    failed = A.failed_captures(filings, page_items(shapes.value_pages(spark, sf_dir), filings))
    return failed.withColumn("errors", F.concat_ws("; ", "errors"))


def _written(spark, name):
    """A new folder for what a query writes and reads again: below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def registry_csv(spark, sf_dir):
    """The registry written as CSV, with quotes, line ends and an empty row, and read by its headers."""
    sheet = shapes.registry(spark, sf_dir)
    name = F.concat(blank_to_null("company_name"), F.lit(' "SA", \nx'))
    # The column that orders the sheet is text in a CSV file.
    sheet = sheet.withColumn("company_name", name).withColumn("sheet_row", F.lpad(F.col("sheet_row").cast("string"), 12, "0"))
    texts = [F.lit(None).cast("string").alias(column) for column in sheet.columns]
    sheet = sheet.select(*[F.col(column).cast("string") for column in sheet.columns]).unionByName(spark.range(3).select(*texts))
    target = _written(spark, "registry")
    sheet.write.option("header", True).option("escape", '"').csv(target)
    companies, _ = A.read_registry(spark, target, row_position="sheet_row", multi_line=True)
    ticker = F.coalesce("ticker", F.lit(NULL)).alias("ticker")
    return companies.select("company_id", "name", ticker, "sector", F.col("registry_pos").cast("bigint").alias("registry_pos"))


def bundle_round_trip(spark, sf_dir):
    """Values written by industry, then again for a quarter of the industries without any value."""
    companies, _ = A.load_registry(shapes.registry(spark, sf_dir), "sheet_row")
    companies, clean_tables = companies.filter("ticker is not null"), _clean(spark, sf_dir)
    values = export_tables(companies, clean_tables.statements, clean_tables.statement_values).statement_values
    values = values.join(companies.select("ticker", "company_id", "industry"), ["ticker", "company_id"])
    # By industry, not by ticker: a test need not make a folder for each of thousands of companies.
    target = _written(spark, "bundle")
    write_partitions(values, target, "industry", companies.select("industry").distinct())
    quarter = companies.filter("cast(industry as bigint) % 4 = 0").select("industry").distinct()
    write_partitions(values.limit(0), target, "industry", quarter)
    return spark.read.parquet(target).select("ticker", "company_id", "document_id", "concept", "value")


def merged_statements(spark, sf_dir):
    """Statements by document: two runs, the later half of the filings first, into one stored table."""
    numbered = _filings(spark, sf_dir).withColumn("document_id", C.es_int("document_id"))
    later = F.col("filing_pos") % 2 == 1
    target = _written(spark, "merged")
    for part in (later, ~later):
        A.merge_last(numbered.filter(part), target, ["company_id", "document_id"], "filing_pos", "statement_pos")
    return A.read_merged(numbered.withColumn("statement_pos", F.col("filing_pos")), target)


def export_failures(spark, sf_dir):
    """Line items written by supplier nation, of which two cannot be written: rows read back, and who failed."""
    nation = shapes.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("nation"))
    lines = shapes.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    lines = lines.join(F.broadcast(nation), "l_suppkey")
    spoiled = F.when(F.col("nation").isin("7", "18"), F.raise_error(F.concat(F.lit("no room for "), "nation")).cast("double"))
    lines = lines.withColumn("price", spoiled.otherwise(F.col("l_extendedprice"))).drop("l_extendedprice")
    target = _written(spark, "apart")
    failed = A.write_apart(lambda part: write_partitions(part(lines), target, "nation", part(nation)), nation, "nation")
    reasons = spark.createDataFrame([(f.key, "no room for" in f.reason) for f in failed], "nation string, failed boolean")
    read = spark.read.parquet(target).withColumn("nation", F.col("nation").cast("string"))
    totals = read.groupBy("nation").agg(F.count("*").alias("n_lines"), F.sum("l_orderkey").alias("orders"))
    both = nation.select("nation").distinct().join(totals, "nation", "left").join(reasons, "nation", "left")
    return both.select("nation", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce(F.col("failed"), F.lit(False)).cast("int").alias("failed"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        es_number_parse,
        es_datetime_parse,
        metadata_date_parse,
        description_fields,
        resolved_fields,
        flag_parse,
        first_non_empty,
        exclude_filings,
        exclude_documents,
        exclude_many_phrases,
        date_bounded_filings,
        listing_requests,
        index_rows,
        stored_index_filings,
        failed_listings,
        drop_separate_set,
        drop_separate_sequential,
        map_concepts,
        unmapped_labels,
        scaled_values,
        concept_last_wins,
        statement_last_wins,
        registry_load,
        registry_rejects,
        clean_statements,
        clean_values,
        rejected_statements,
        rejected_lines,
        company_metadata_kv,
        statement_metadata_export,
        statement_values_export,
        display_format,
        run_report,
        page_links,
        page_links_absolute,
        page_table_rows,
        page_controls,
        page_items_joined,
        value_page_rows,
        failed_captures,
        registry_csv,
        bundle_round_trip,
        export_failures,
        merged_statements,
    )
}
