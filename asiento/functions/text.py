"""Text helpers shared by the parsers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a filing's text is stripped of at both ends (all Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space; the plain ``trim`` removes spaces only."""
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_non_empty(*candidates: Column | str) -> Column:
    """The first candidate that is not blank, trimmed; the empty string if there is none."""
    return F.coalesce(*[blank_to_null(c) for c in candidates], F.lit(""))


def contains_ignore_case(c: Column | str, phrase: str) -> Column:
    """Plain substring test, both sides lower-cased; the phrase is not a pattern."""
    return F.lower(as_column(c)).contains(phrase.lower())


def contains_any(c: Column | str, phrases: Sequence[str]) -> Column:
    """True if the text holds at least one phrase. A null text holds none."""
    lowered = F.coalesce(F.lower(as_column(c)), F.lit(""))
    return reduce(
        lambda found, phrase: found | lowered.contains(phrase.lower()), phrases, F.lit(False)
    )


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"double('{value}')"


def lookup(c: Column | str, mapping: Mapping[str, str | float]) -> Column:
    """Value of a small fixed dictionary, null on a miss. For closed sets of a few entries only."""
    pairs = ", ".join(f"{_literal(key)}, {_literal(value)}" for key, value in mapping.items())
    return F.try_element_at(F.expr(f"map({pairs})"), as_column(c))


def extract(c: Column | str, pattern: str) -> Column:
    """First group of the first match, the empty string without one."""
    return F.regexp_extract(as_column(c), pattern, 1)
