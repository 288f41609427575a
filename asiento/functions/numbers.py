"""Numbers written with ``.`` between thousands and ``,`` before decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asiento.functions.text import WHITESPACE, as_column, strip

# A number with any white space around it. The cast alone would also take Java's type suffixes (1d, 1f)
# and the words nan and infinity.
_DECIMAL = (
    f"^[{WHITESPACE}]*"
    r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    f"[{WHITESPACE}]*$"
)


def _plain(c: Column | str) -> Column:
    return F.translate(as_column(c), ",.", ".")


def es_number(c: Column | str) -> Column:
    """``1.234,56`` -> 1234.56; null when the text is blank or no number."""
    return F.regexp_extract(_plain(c), _DECIMAL, 1).try_cast("double")


def es_int(c: Column | str) -> Column:
    """``1.234`` -> 1234; null for anything with a decimal part (``1.234,00``) or beyond 64 bits."""
    return strip(_plain(c)).try_cast("bigint")
