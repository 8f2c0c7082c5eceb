"""SQL expressions: whitespace, casts, dates, digests."""

from .casts import (
    date_pattern,
    is_digits,
    is_finite,
    parse_bigint,
    parse_double,
    to_bigint,
    to_date,
    to_double,
)
from .digests import canonical_text, md5_number, row_digest
from .text import as_text, clean, collapse, full_match, is_blank, null_if_blank, quoted, strip

__all__ = [
    "as_text",
    "clean",
    "collapse",
    "date_pattern",
    "full_match",
    "is_blank",
    "is_digits",
    "is_finite",
    "canonical_text",
    "md5_number",
    "null_if_blank",
    "parse_bigint",
    "parse_double",
    "quoted",
    "row_digest",
    "strip",
    "to_bigint",
    "to_date",
    "to_double",
]
