"""Units of measure."""

from __future__ import annotations

from pyspark.sql import Column

from asiento.functions.text import lookup

# Unit text -> factor its amounts are multiplied by.
MULTIPLIERS = {
    "Unit": 1.0,
    "$": 1.0,
    "Thousands": 1_000.0,
    "Miles de $": 1_000.0,
    "Millions": 1_000_000.0,
    "Millones de $": 1_000_000.0,
}


def unit_multiplier(c: Column | str) -> Column:
    """Factor of a unit, exact match; null when the unit is unknown."""
    return lookup(c, MULTIPLIERS)
