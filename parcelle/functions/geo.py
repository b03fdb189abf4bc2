"""Geography code helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions._util import col_of


def code_str(c) -> Column:
    """Codes become strings, so integer keys can meet text keys."""
    return col_of(c).cast("string")


def pad_code(c, width: int = 2) -> Column:
    """Left-pad with zeros to ``width``; longer codes are never truncated."""
    s = code_str(c)
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def repair_corsica(c) -> Column:
    """Department codes 20 and 201 become 2A, 202 becomes 2B (after padding)."""
    # Corsica department code repairs.
    s = col_of(c)
    return (F.when(s.isin("20", "201"), F.lit("2A"))
            .when(s == "202", F.lit("2B"))
            .otherwise(s))


def department_code(c) -> Column:
    """Pad, then repair Corsica codes."""
    return repair_corsica(pad_code(c, 2))
