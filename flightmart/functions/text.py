"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import col_of

# Printable ASCII is 0x20 (space) through 0x7E (tilde); everything else goes.
NON_PRINTABLE_ASCII = r"[^\x20-\x7E]"


def strip_non_ascii(c: str | Column) -> Column:
    """Remove every character outside printable ASCII; NULL stays NULL."""
    return F.regexp_replace(col_of(c), NON_PRINTABLE_ASCII, "")
