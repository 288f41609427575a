"""Dates in the three written forms filings use. Impossible dates give null, never an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from asiento.functions.text import WHITESPACE, as_column, extract, strip

# Month abbreviations, dot included.
MONTHS = {
    "ene.": "01", "feb.": "02", "mar.": "03", "abr.": "04", "may.": "05", "jun.": "06",
    "jul.": "07", "ago.": "08", "sep.": "09", "oct.": "10", "nov.": "11", "dic.": "12",
}

# Fixed value: how a description states the period end. A year 0, which Spark knows and Python's dates
# do not, matches without giving a date.
_PERIOD_END = r"(?U)FECHA\s+CIERRE\s*:\s*(?:0000-[0-9]{2}-[0-9]{2}|([0-9]{4}-[0-9]{2}-[0-9]{2}))"

# The pieces of a written date, brought into the order of an ISO date behind a blank, which stripped
# text never starts with: what did not match is told from what did. Then the year, padded above, is cut
# to its four digits; years beyond 9999 and the year 0 give no text and so no date.
_DATETIME = r"^\+?0*([0-9]{1,2}) \+?0*([0-9]{1,2}) \+?0*([0-9]+)[ :]\+?0*([0-9]{1,2})[ :]\+?0*([0-9]{1,2})$"
_DATETIME_ISO = " 000$3-$2-$1 $4:$5:00"
_DMY = (
    f"^\\+?0*([0-9]{{1,2}})[{WHITESPACE}]*/[{WHITESPACE}]*\\+?0*([0-9]{{1,2}})"
    f"[{WHITESPACE}]*/[{WHITESPACE}]*\\+?0*([0-9]+)$"
)
_DMY_ISO = " 000$3-$2-$1"
_FOUR_DIGIT_YEAR = r"^ 0*((?!0000)[0-9]{4}-.*)$"


def es_timestamp(c: Column | str) -> Column:
    """``13 oct. 2025 14:20`` -> timestamp without zone. Exactly five single-spaced parts."""
    numeric = reduce(
        lambda text, month: F.replace(text, F.lit(month[0]), F.lit(month[1])), MONTHS.items(), strip(c)
    )
    iso = F.regexp_replace(numeric, _DATETIME, _DATETIME_ISO)
    return F.regexp_extract(iso, _FOUR_DIGIT_YEAR, 1).try_cast("timestamp_ntz")


def dmy_date(c: Column | str) -> Column:
    """``31/12/2024`` -> date."""
    iso = F.regexp_replace(strip(c), _DMY, _DMY_ISO)
    return F.regexp_extract(iso, _FOUR_DIGIT_YEAR, 1).try_cast("date")


def description_date(c: Column | str) -> Column:
    """Period end stated in a filing's description; only the first statement of one counts."""
    return extract(c, _PERIOD_END).try_cast("date")


def period_end_date(description: Column | str, metadata: Column | str) -> Column:
    """The form's date wins; the description is the fallback."""
    return F.coalesce(dmy_date(metadata), description_date(description))


def dmy_text(c: Column | str) -> Column:
    """Date -> ``31/12/2024``, the form a listing request takes."""
    return F.date_format(as_column(c), "dd/MM/yyyy")
