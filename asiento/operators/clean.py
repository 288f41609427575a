"""Raw statements and their lines to typed tables; a statement is taken whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento import functions as A
from asiento.operators.concepts import map_labels
from asiento.operators.joins import heavy_keys, split_heavy
from asiento.operators.keyed import keep_last
from asiento.schemas import FILING_KEY, position

FLAGS = [
    "merger_or_demerger_in_process",
    "treasury_shares",
    "insolvency_proceedings",
    "public_offering_of_equity_instruments",
]

STATEMENT_COLUMNS = [
    "company_id",
    "document_id",
    "document_description",
    "document_link",
    "submission_date",
    "reporting_period",
    "period_end_date",
    "financial_statements_type",
    "presentation_currency",
    "accounting_standards_applied",
    *FLAGS,
    "subscribed_shares_at_period_end",
    "equity_share_price_at_period_end",
    "free_float_percentage",
    "number_of_employees",
]

#: Unreadable lines of a filing that are reported one by one: the first ones.
REPORTED_LINES = 10

VALUE_COLUMNS = ["company_id", "document_id", "order", "concept", "value"]


class CleanTables:
    """``statements``, ``statement_values`` and ``rejects`` of a set of raw statements.

    Each table is planned when it is first asked for: planning the values runs small jobs that measure
    the taxonomy and look for heavy filings.
    """

    def __init__(
        self,
        statements_raw: DataFrame,
        concepts_raw: DataFrame,
        taxonomy: DataFrame,
        unscaled_concepts: Sequence[str] = (),
    ):
        self._concepts_raw, self._taxonomy, self._unscaled = concepts_raw, taxonomy, unscaled_concepts
        self._counts = line_counts(concepts_raw)
        self._judged = judge_statements(statements_raw, self._counts)
        self._accepted = accepted_statements(self._judged)

    @cached_property
    def statements(self) -> DataFrame:
        return self._accepted.select(*STATEMENT_COLUMNS, "filing_pos", "statement_pos")

    @cached_property
    def statement_values(self) -> DataFrame:
        return statement_values(
            self._concepts_raw, self._counts, self._accepted, self._taxonomy, self._unscaled
        )

    @cached_property
    def rejects(self) -> DataFrame:
        return rejected_statements(self._judged)


def _required_fields() -> dict[str, Column]:
    """Typed form of every field a statement cannot do without; null where it cannot be read."""
    text = "document_description"
    return {
        "document_id": A.es_int("document_id"),
        "submission_date": A.es_timestamp("submission_date"),
        "reporting_period": A.reporting_period(text, "reporting_period"),
        "period_end_date": A.period_end_date(text, "period_end_date"),
        "financial_statements_type": A.statement_type(text, "financial_statements_type"),
        "accounting_standards_applied": A.accounting_standard(text, "accounting_standards_applied"),
        **{flag: A.es_bool(flag) for flag in FLAGS},
        "subscribed_shares_at_period_end": A.es_int("subscribed_shares_at_period_end"),
        "equity_share_price_at_period_end": A.es_number("equity_share_price_at_period_end"),
        "free_float_percentage": A.es_number("free_float_percentage"),
        "number_of_employees": A.es_int("number_of_employees"),
        "unit_of_measure": A.unit_multiplier("unit_of_measure"),
    }


def parse_statements(statements_raw: DataFrame) -> DataFrame:
    """Typed statement fields, ``unit_multiplier`` and ``errors``, one message per unreadable field."""
    required = _required_fields()
    parsed = statements_raw.select(
        *FILING_KEY,
        "document_description",
        "document_link",
        "presentation_currency",
        *[F.col(name).alias(f"_raw_{name}") for name in required],
        *[typed.alias(name) for name, typed in required.items()],
    )
    messages = [
        F.when(
            F.col(name).isNull(),
            F.concat(F.lit(f"{name}: "), F.coalesce(f"_raw_{name}", F.lit("missing"))),
        )
        for name in required
    ]
    return parsed.select(
        *[name for name in STATEMENT_COLUMNS],
        "filing_pos",
        F.col("unit_of_measure").alias("unit_multiplier"),
        F.col("_raw_document_id").alias("raw_document_id"),
        F.array_compact(F.array(*messages)).alias("errors"),
    )


def parse_lines(concepts_raw: DataFrame) -> DataFrame:
    """Lines with their amount and order as numbers, null where unreadable."""
    return concepts_raw.select(
        *FILING_KEY,
        position("page_no", "row_no").alias("pos"),
        "label",
        A.es_number("value").alias("amount"),
        A.es_int("id").alias("order"),
    )


def line_counts(concepts_raw: DataFrame) -> DataFrame:
    """Per filing: number of lines, and of lines with an unreadable amount or order."""
    return (
        parse_lines(concepts_raw)
        .groupBy(*FILING_KEY)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("amount").isNull()).alias("bad_amounts"),
            F.count_if(F.col("order").isNull()).alias("bad_orders"),
        )
    )


def rejected_lines(concepts_raw: DataFrame, most: int = REPORTED_LINES) -> DataFrame:
    """The first unreadable lines of each filing, with what could not be read and the number of all of them.

    ``line`` numbers a filing's unreadable lines from 1 to ``most``, ``bad_lines`` is how many there are in all.
    Every task passes on at most ``most`` lines of a filing, and counts before it shuffles.
    """

    def unreadable(name: str, typed: Column) -> Column:
        return F.when(typed.isNull(), F.concat(F.lit(f"{name}: "), F.coalesce(name, F.lit("missing"))))

    errors = F.array_compact(F.array(unreadable("value", A.es_number("value")), unreadable("id", A.es_int("id"))))
    bad = concepts_raw.select(*FILING_KEY, "page_no", "row_no", "label", errors.alias("errors")).filter(F.size("errors") > 0)
    totals = bad.groupBy(*FILING_KEY).agg(F.count("*").alias("bad_lines"))
    in_order = Window.partitionBy(*FILING_KEY).orderBy("page_no", "row_no", "label", "errors")
    first = bad.withColumn("line", F.row_number().over(in_order)).filter(F.col("line") <= most)
    return first.join(totals, FILING_KEY, "left")


def judge_statements(statements_raw: DataFrame, counts: DataFrame) -> DataFrame:
    """Parsed statements with all their errors, those of their lines (``line_counts``) included."""

    def line_error(name: str, count: str) -> Column:
        return F.when(
            F.col(count) > 0, F.concat(F.lit(f"{name}: unreadable lines: "), F.col(count).cast("string"))
        )

    judged = parse_statements(statements_raw).join(counts, FILING_KEY, "left")
    of_lines = F.array(line_error("value", "bad_amounts"), line_error("id", "bad_orders"))
    return judged.withColumn("errors", F.concat("errors", F.array_compact(of_lines))).drop(
        "n", "bad_amounts", "bad_orders"
    )


def accepted_statements(judged: DataFrame) -> DataFrame:
    """Statements without errors, the last filing of each document id at the place of the first.

    ``filing_pos`` is the filing kept, ``statement_pos`` the place of the statement in its company.
    """
    clean = judged.filter(F.size("errors") == 0).drop("errors", "raw_document_id")
    return keep_last(clean, ["company_id", "document_id"], "filing_pos", "statement_pos")


def rejected_statements(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") > 0).select(
        "company_id",
        F.col("raw_document_id").alias("document_id"),
        "filing_pos",
        F.lit("clean").alias("stage"),
        "errors",
    )


def last_lines(lines: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Of the lines of a filing with one concept the last wins, at the position of the first."""
    return lines.groupBy(*FILING_KEY, *extra_keys, "concept").agg(
        F.max_by("amount", "pos").alias("amount"),
        F.max_by("order", "pos").alias("order"),
        F.min("pos").alias("pos"),
    )


def statement_values(
    concepts_raw: DataFrame,
    counts: DataFrame,
    accepted: DataFrame,
    taxonomy: DataFrame,
    unscaled_concepts: Sequence[str] = (),
) -> DataFrame:
    """Scaled values of the accepted statements, one row per statement and concept.

    Lines are shuffled once, by filing: the aggregation reuses the partitioning of the join. A filing
    with more lines than a task takes easily would then be one task's work, so such filings (looked for in
    ``counts``; usually there are none) go the other way round: aggregated first, with a combine before
    the shuffle, and joined by broadcast.
    """
    of_statement = ["document_id", "statement_pos", "unit_multiplier"]
    # One narrow row per filing: hashed per partition, so that the lines need not be sorted for the join.
    kept = accepted.select(*FILING_KEY, *of_statement).hint("shuffle_hash")
    lines = map_labels(parse_lines(concepts_raw), taxonomy)
    heavy = heavy_keys(counts, FILING_KEY)
    if heavy is None:
        last = last_lines(lines.join(kept, FILING_KEY), of_statement)
    else:
        hot, light = split_heavy(lines, heavy, FILING_KEY)
        few = F.broadcast(kept.join(F.broadcast(heavy), FILING_KEY, "left_semi"))
        last = last_lines(light.join(kept, FILING_KEY), of_statement).unionByName(
            last_lines(hot).join(few, FILING_KEY)
        )
    scaled = F.col("unit_multiplier") * F.col("amount")
    if unscaled_concepts:
        scaled = F.when(F.col("concept").isin(*unscaled_concepts), F.col("amount")).otherwise(scaled)
    return last.select(
        "company_id",
        "document_id",
        "order",
        "concept",
        scaled.alias("value"),
        "statement_pos",
        "pos",
    )


def clean_statements(
    statements_raw: DataFrame,
    concepts_raw: DataFrame,
    taxonomy: DataFrame,
    unscaled_concepts: Sequence[str] = (),
) -> CleanTables:
    """Typed statements, their values, and the statements set aside with the reasons.

    One unreadable field or line sets the whole statement aside; a statement without lines is valid.
    """
    return CleanTables(statements_raw, concepts_raw, taxonomy, unscaled_concepts)
