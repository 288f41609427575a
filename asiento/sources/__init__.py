"""Readers: registry, filing index, stored pages."""

from asiento.sources.index import listing_request, missing_listings, parse_index
from asiento.sources.index_store import captured_companies, read_index, write_index
from asiento.sources.markup import RowShape
from asiento.sources.pages import (
    FORM_FIELDS,
    extract_controls,
    extract_index_rows,
    extract_links,
    extract_rows,
    failed_captures,
    one_capture,
    parse_pages,
    pivot_fields,
    pivot_items,
    value_rows,
)
from asiento.sources.registry import COLUMN_MAPPING, get_company, load_registry, read_registry

__all__ = [
    "COLUMN_MAPPING", "FORM_FIELDS", "RowShape", "captured_companies", "extract_controls", "extract_index_rows",
    "extract_links", "extract_rows", "failed_captures", "get_company", "listing_request",
    "load_registry", "missing_listings", "one_capture", "parse_index", "parse_pages", "pivot_fields", "pivot_items",
    "read_index", "read_registry", "value_rows", "write_index",
]
