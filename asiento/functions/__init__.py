"""Column -> Column functions. Every one is a built-in expression, so they stay inside code generation."""

from asiento.functions.dates import (
    description_date,
    dmy_date,
    dmy_text,
    es_timestamp,
    period_end_date,
)
from asiento.functions.flags import es_bool
from asiento.functions.literals import (
    accounting_standard,
    period_from_description,
    period_from_metadata,
    reporting_period,
    standard_from_description,
    standard_from_metadata,
    statement_type,
    type_from_description,
    type_from_metadata,
)
from asiento.functions.numbers import es_int, es_number
from asiento.functions.text import (
    blank_to_null,
    contains_any,
    contains_ignore_case,
    first_non_empty,
    lookup,
    strip,
)
from asiento.functions.units import unit_multiplier

__all__ = [
    "accounting_standard", "blank_to_null", "contains_any", "contains_ignore_case",
    "description_date", "dmy_date", "dmy_text", "es_bool", "es_int", "es_number", "es_timestamp",
    "first_non_empty", "lookup", "period_end_date", "period_from_description", "period_from_metadata",
    "reporting_period", "standard_from_description", "standard_from_metadata", "statement_type", "strip",
    "type_from_description", "type_from_metadata", "unit_multiplier",
]
