"""Scans, parsers and source-format builders."""

from kestrel.sources.postings import POSTING_SCHEMA, parse_postings, read_postings
from kestrel.sources.text import parse_page_records, read_lines, read_page_records
from kestrel.sources.wide_csv import parse_wide_lines, read_header, read_wide_csv, wide_schema

__all__ = [
    "POSTING_SCHEMA", "parse_postings", "read_postings",
    "parse_page_records", "read_lines", "read_page_records",
    "parse_wide_lines", "read_header", "read_wide_csv", "wide_schema",
]
