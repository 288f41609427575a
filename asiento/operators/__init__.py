"""DataFrame -> DataFrame operators."""

from asiento.operators.clean import (
    CleanTables,
    accepted_statements,
    clean_statements,
    judge_statements,
    parse_lines,
    parse_statements,
    rejected_lines,
    rejected_statements,
    statement_values,
)
from asiento.operators.concepts import map_labels, read_taxonomy, taxonomy_table, unmapped_labels
from asiento.operators.duplicates import drop_separate_duplicates, flag_separate_duplicates
from asiento.operators.filters import EXCLUDED_PHRASES, exclude_phrases, filter_by_date
from asiento.operators.joins import dimension_join, heavy_key_join, heavy_keys, spread_join
from asiento.operators.keyed import keep_last
from asiento.operators.phrases import exclude_phrase_table, find_phrases

__all__ = [
    "CleanTables", "EXCLUDED_PHRASES", "accepted_statements", "clean_statements", "dimension_join",
    "drop_separate_duplicates", "exclude_phrase_table", "exclude_phrases", "filter_by_date", "find_phrases", "flag_separate_duplicates",
    "heavy_key_join", "heavy_keys", "judge_statements", "keep_last", "map_labels", "parse_lines",
    "parse_statements", "read_taxonomy", "rejected_lines", "rejected_statements", "spread_join", "statement_values",
    "taxonomy_table", "unmapped_labels",
]
