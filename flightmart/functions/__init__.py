"""Column-level building blocks (pure expressions, no actions)."""

from .casting import EDGE_BLANKS, INT_TEXT, date_from_parts, parse_date, to_int, to_int_text
from .missing import (
    MISSING_TOKENS,
    UNKNOWN_TAIL_LABEL,
    UNKNOWN_TAIL_TOKEN,
    all_of,
    any_missing,
    any_of,
    col_of,
    is_missing,
    is_missing_num,
)
from .text import NON_PRINTABLE_ASCII, strip_non_ascii

__all__ = [
    "EDGE_BLANKS",
    "INT_TEXT",
    "MISSING_TOKENS",
    "NON_PRINTABLE_ASCII",
    "UNKNOWN_TAIL_LABEL",
    "UNKNOWN_TAIL_TOKEN",
    "all_of",
    "any_missing",
    "any_of",
    "col_of",
    "date_from_parts",
    "is_missing",
    "is_missing_num",
    "parse_date",
    "strip_non_ascii",
    "to_int",
    "to_int_text",
]
