"""Filing-shaped raw tables derived from the test tables.

The test data holds no filings, so their raw text is rendered from whole tables: customers become a
registry, orders become filings with their form fields, line items become statement lines. Some texts
are spoiled on purpose, by remainders of the keys, so that every way of setting a row aside occurs.

Rendered tables are stored once per application in the shared ``spark.checkpoint.dir``: queries then
read raw text from files, as they would in use, and their plans hold no rendering. Without such a folder
they are rendered within each query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.functions.dates import MONTHS
from asiento.operators import taxonomy_table
from asiento.schemas import FILING_KEY
from asiento.sources.pages import FORM_FIELDS

#: A small invented taxonomy; real ones are supplied by the user of the library.
TAXONOMY = {
    "CAJA Y BANCOS": "Cash",
    "VENTAS": "Sales",
    "COSTO DE LO VENDIDO": "CostOfGoods",
    "RESULTADO DEL AÑO": "YearResult",
}

#: Label of a line by its number; 2 and 5 name one concept, 6 and 7 none.
LABELS = {
    1: "CAJA Y BANCOS",
    2: "VENTAS",
    3: "Costo de lo Vendido",
    4: "resultado del año",
    5: "Ventas",
    6: "Otras partidas",
    7: "NOTA",
}


#: Columns whose values spread the rows of a table evenly.
KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "pages": "page_id", "documents": "doc_id", "customer": "c_custkey"}


_STORED: dict[tuple[str, ...], str] = {}


def stored(render: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Render a table on its first use in an application, and read it from then on."""

    @wraps(render)
    def read(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            return render(spark, sf_dir, *names)
        key = (spark.sparkContext.applicationId, sf_dir, render.__name__, *names)
        if key not in _STORED:
            target = f"{shared.rstrip('/')}/rendered-{uuid.uuid4().hex}/{render.__name__}"
            render(spark, sf_dir, *names).write.option("compression", "zstd").parquet(target)
            _STORED[key] = target
        return spark.read.parquet(_STORED[key])

    return read


@stored
def _spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A copy of a test table in as many files as there are cores; the tests' tables are one file each."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(spark.sparkContext.defaultParallelism, KEYS[name])


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is given, for renderings that shuffle it themselves."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; with a shared folder, its spread copy, made once."""
    if name in KEYS and spark.conf.get("spark.checkpoint.dir", None):
        return _spread(spark, sf_dir, name)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def es_whole(c: Column) -> Column:
    """1234 -> ``1.234``"""
    return F.translate(F.format_number(c, 0), ",", ".")


def es_decimal(c: Column) -> Column:
    """1234.5 -> ``1.234,50``"""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def _choose(*texts: str) -> str:
    """One of the texts, by the remainder of the order's key."""
    choices = ", ".join(f"'{text}'" for text in texts)
    return f"element_at(array({choices}), cast(k % {len(texts)} as int) + 1)"


_MONTHS = ", ".join(f"'{name}'" for name in MONTHS)

#: Filing fields as SQL over the order: k its key, d its day, m its day and minute, q its quarter's end,
#: n the number of the document.
FILING_FIELDS = {
    "orderkey": "k",
    "company_id": "cast(o_custkey as string)",
    "filing_pos": "shiftleft(k div 50, 40) + k % 50 + 1",
    "document_id": "if(k % 2 = 0, translate(format_number(n, 0), ',', '.'), cast(n as string))",
    "document_description": f"""concat(
        if(k % 11 = 0, 'SIN FECHA', concat('FECHA CIERRE: ', cast(q as string))),
        ' - PERIODICIDAD: ', {_choose("TRIMESTRAL", "3", "ANUAL", "IRREGULAR", "anual")},
        ' - TIPO BALANCE: ', {_choose("CONSOLIDADO", "INDIVIDUAL", "INDIVIDUAL")},
        ' - NORMA CONTABLE: ', {_choose("NIIF", "RT", "NORMAS CONTABLES PROFESIONALES", "XX")},
        case when k % 13 = 0 then ' - otros idiomas' when k % 17 = 0 then ' - Relac.: Controlada' else '' end)""",
    "document_link": "concat('https://filings.example.com/d/', k)",
    "submission_date": f"""if(k % 37 = 0, '30 feb. 2025 01:02',
        concat_ws(' ', dayofmonth(m), element_at(array({_MONTHS}), month(m)), date_format(m, 'yyyy HH:mm')))""",
    "reporting_period": _choose("Trimestral", "anual", "SEMESTRAL", "", "Otro", "irregular"),
    "period_end_date": """case when k % 7 = 0 then '' when k % 7 = 1 then '31/2/2024'
        else concat_ws('/', dayofmonth(last_day(d)), month(d), year(d)) end""",
    "financial_statements_type": _choose("", "Consolidado", "individual", "Combinado"),
    "presentation_currency": "if(k % 19 > 0, 'Pesos', null)",
    "unit_of_measure": f"""if(k % 41 = 0, 'miles de $',
        {_choose("Unit", "$", "Thousands", "Miles de $", "Millions", "Millones de $")})""",
    "accounting_standards_applied": _choose("NIIF", "rt", ""),
    "merger_or_demerger_in_process": f"if(k % 43 = 0, 'SI', {_choose('Si', 'Sí', 'No')})",
    "treasury_shares": _choose("Si", "No"),
    "insolvency_proceedings": "'No'",
    "public_offering_of_equity_instruments": "'Sí'",
    "subscribed_shares_at_period_end": "translate(format_number(floor(o_totalprice), 0), ',', '.')",
    "equity_share_price_at_period_end": "if(k % 47 = 0, ' ', translate(format_number(o_totalprice, 2), ',.', '.,'))",
    "price_earnings_ratio": "''",
    "market_capitalization": "''",
    "free_float_percentage": "translate(format_number(k % 10000 / 100, 2), ',.', '.,')",
    "number_of_employees": "if(k % 53 = 0, '12,5', translate(format_number(k % 5000, 0), ',', '.'))",
}


@stored
def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``FILINGS_RAW`` plus the 16 form fields, one row per order; ``orderkey`` names the order."""
    orders = _given(spark, sf_dir, "orders")
    if spark.conf.get("spark.checkpoint.dir", None):
        orders = orders.repartition(spark.sparkContext.defaultParallelism, KEYS["orders"])
    return _facts(orders).selectExpr(*[f"{field} as {name}" for name, field in FILING_FIELDS.items()])


def _facts(orders: DataFrame, *others: str) -> DataFrame:
    """What the fields of a filing are rendered from, and other columns."""
    return orders.selectExpr(
        "o_custkey",
        "o_totalprice",
        "o_orderkey as k",
        "o_orderdate as d",
        "timestampadd(MINUTE, cast(o_orderkey % 1440 as int), o_orderdate) as m",
        "last_day(add_months(date_trunc('quarter', o_orderdate), 2)) as q",
        "o_custkey * 8 + o_orderkey % 8 as n",
        *others,
    )


@stored
def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CONCEPTS_RAW`` of all line items under the filing of their order, with two more numbers as text."""
    # Joined as the numbers they are: text is several times as wide.
    orders = _given(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey")
    numbers = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    joined = _given(spark, sf_dir, "lineitem").select(*numbers).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    return joined.select(
        F.col("l_orderkey").alias("orderkey"),
        # Together unique within an order, and within their bits for a million suppliers and 30 million parts.
        (F.col("l_suppkey") * 8 + line).cast("int").alias("page_no"),
        (part * 64 + F.col("l_quantity").cast("bigint")).cast("int").alias("row_no"),
        F.element_at(F.array(*[F.lit(label) for label in LABELS.values()]), line).alias("label"),
        F.when(part % 997 == 0, F.lit("n/d"))
        .otherwise(es_decimal(F.col("l_extendedprice")))
        .alias("value"),
        F.when((line == 7) & (F.col("l_suppkey") % 89 == 0), F.lit("7,5"))
        .otherwise(line.cast("string"))
        .alias("id"),
        es_whole(F.col("l_orderkey")).alias("order_text"),
        es_decimal(-F.col("l_quantity")).alias("quantity_text"),
        *[F.expr(f"{FILING_FIELDS[name].replace('k ', 'o_orderkey ')} as {name}") for name in FILING_KEY],
    )


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CONCEPTS_RAW`` of all line items."""
    return raw_lines(spark, sf_dir).select(*FILING_KEY, "page_no", "row_no", "label", "value", "id")


def taxonomy(spark: SparkSession) -> DataFrame:
    return taxonomy_table(spark, TAXONOMY)


@stored
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry sheet, one row per customer, ordered by ``sheet_row``."""
    key = F.col("c_custkey")
    ticker = F.concat(F.lit(" T"), (key - F.when(key % 10 == 9, 1).otherwise(0)).cast("string"))
    return table(spark, sf_dir, "customer").select(
        key.alias("sheet_row"),
        F.when(key % 23 > 0, key.cast("string")).alias("cuit"),
        F.when(key % 29 == 0, F.lit(" \t ")).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("company_name"),
        F.when(key % 31 > 0, ticker).alias("ticker"),
        F.lit(None).cast("string").alias("company_description"),
        F.col("c_mktsegment").alias("sector"),
        F.lit("").alias("industry_group"),
        F.col("c_nationkey").cast("string").alias("industry"),
        F.lit(None).cast("string").alias("subindustry"),
        F.lit(None).cast("string").alias("subindustry_definition"),
        F.col("c_acctbal").alias("balance"),
    )


#: Headers of the rendered index, with the blanks and the extra column a real one has.
INDEX_HEADER: Sequence[str] = (" FECHA", "HORA ", "", "DESCRIPCIÓN", "DOCUMENTO", "VER")


@stored
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured index rows; one row in 101 has no link, which fails its company."""
    source = filings(spark, sf_dir)
    parts = F.split("submission_date", " ")
    nothing = F.lit(None).cast("string")
    link = F.when(F.col("orderkey") % 101 > 0, F.col("document_link"))
    return source.select(
        "company_id",
        F.floor(F.col("orderkey") / 50).cast("int").alias("page_no"),
        (F.col("orderkey") % 50 + 1).cast("int").alias("row_no"),
        F.array(*[F.lit(text) for text in INDEX_HEADER]).alias("header"),
        F.array(
            F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))),
            F.get(parts, F.lit(3)),
            F.lit("-"),
            "document_description",
            "document_id",
            F.lit("Ver"),
        ).alias("cells"),
        F.array(nothing, nothing, nothing, nothing, nothing, link).alias("hrefs"),
    )


def _form() -> Column:
    """A form with all fields of a filing; the first of the two employee controls is empty for every third."""
    pieces: list[Column] = [F.lit("<!DOCTYPE html><p>Formulario<br><form>")]
    for name, (ids, kind) in FORM_FIELDS.items():
        text = F.coalesce(F.col(name), F.lit(""))
        if kind == "select":
            pieces += [
                F.lit(f'<select name=s id="{ids[0]}"><option value="0">--</option><option value="1" selected> '),
                text,
                F.lit("\n</option><option>zz</select>"),
            ]
        elif len(ids) == 1:
            pieces += [F.lit(f"<input type=text id='{ids[0]}' value='"), text, F.lit("'>")]
        else:
            first = F.when(F.col("orderkey") % 3 > 0, text).otherwise(F.lit("  "))
            pieces += [F.lit(f"<textarea id={ids[0]}>"), first, F.lit(f'</textarea><input id="{ids[1]}" value="'), text, F.lit('">')]
    return F.concat(*pieces)


@stored
def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form pages of all filings, not well-formed: ``company_id, filing_pos, page_no, url, html``."""
    return filings(spark, sf_dir).select(
        *FILING_KEY,
        F.lit(1).alias("page_no"),
        F.col("document_link").alias("url"),
        _form().alias("html"),
    )


#: Captures of value tables, two line numbers to a page, as SQL over the order's key k: what is spoiled.
NO_FIRST_PAGE, EMPTY_LAST_PAGE, TWO_TABLES, NO_PAGER, CUT_SHORT, TWICE = (
    f"k % {n} = 0" for n in (59, 61, 7, 71, 73, 5)
)


@stored
def value_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``FILING_PAGES`` with the form and the value table of all filings over up to four pages.

    Some filings lack their first page, end with an empty one, have no pager, or a line without its last
    cell. Some pages hold two tables. Some are captured twice, once without their last line.
    """
    # Lines are shuffled once, as the numbers they are, and rendered where their order's other columns are.
    numbers = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = _given(spark, sf_dir, "lineitem").filter("l_orderkey is not null").groupBy("l_orderkey")
    lines = lines.agg(F.sort_array(F.collect_list(F.struct(*numbers))).alias("lines"))
    orders = _given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    facts = _facts(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "lines")
    fields = [name for name in FILING_FIELDS if name != "orderkey"]
    filings = facts.selectExpr("k", "k as orderkey", "lines", *[f"{FILING_FIELDS[name]} as {name}" for name in fields])
    page_of = "ceil(x.l_linenumber / 2)"
    numbered = filings.withColumn("page_numbers", F.expr(f"array_distinct(transform(lines, x -> {page_of}))"))
    pages = numbered.withColumn("last_page", F.expr("array_max(page_numbers)")).withColumn("page_no", F.explode("page_numbers"))
    pages = pages.withColumn("lines", F.expr(f"filter(lines, x -> {page_of} <=> page_no)"))
    page = "struct(page_no, lines)"
    empty = "struct(page_no + 1 as page_no, filter(lines, x -> false) as lines)"
    with_empty = f"if(page_no = last_page and {EMPTY_LAST_PAGE}, array({page}, {empty}), array({page}))"
    pages = pages.withColumn("page", F.explode(F.expr(with_empty))).withColumns({"page_no": F.col("page.page_no"), "lines": F.col("page.lines")})
    pages = pages.filter(f"not ({NO_FIRST_PAGE} and page_no = 1)")
    again = f"if({TWICE} and size(lines) > 1, array(lines, slice(lines, 1, size(lines) - 1)), array(lines))"
    pages = pages.withColumn("lines", F.explode(F.expr(again)))

    # A line without a number has the last label.
    label = f"element_at(array({', '.join(repr(text) for text in LABELS.values())}), coalesce(x.l_linenumber, -1))"
    cells = ["x.l_linenumber", label, "replace(format_string('%.2f', x.l_extendedprice), '.', ',')"]
    row = "concat('<tr>', concat_ws('', " + ", ".join(f"'<td>', {cell}, '</td>'" for cell in cells) + "), '</tr>')"
    cut = f"concat('<tr><td>', x.l_linenumber, '</td><td>', {label}, '</td></tr>')"
    rows = f"transform(lines, x -> if({CUT_SHORT} and x.l_linenumber = 1, {cut}, {row}))"
    body = "concat_ws('', slice(rows, {}, size(rows)))"
    opened, closed = "<table entidad=\"10013\"><tbody>", "</tbody></table>"
    value_table = f"""concat(
        if({NO_PAGER}, '', concat('<ul class="pagination" entidad="10013" data-paginainicio="1" data-paginafin="',
            cast(last_page + if({EMPTY_LAST_PAGE}, 1, 0) as string), '"></ul>')),
        '{opened}',
        if({TWO_TABLES} and size(rows) > 1,
            concat(rows[0], '{closed}<p>&nbsp;</p>{opened}', {body.format(2)}), {body.format(1)}),
        '{closed}')"""
    return pages.withColumn("rows", F.expr(rows)).select(
        "company_id",
        "document_link",
        F.col("page_no").cast("int").alias("page_no"),
        F.col("document_link").alias("url"),
        F.concat(F.when(F.col("page_no").cast("int") == 1, _form()).otherwise(F.lit("")), F.expr(value_table)).alias("html"),
    )
