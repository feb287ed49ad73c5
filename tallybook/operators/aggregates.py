"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_agg(col_name: str, sep: str = ", ") -> Column:
    """``STRING_AGG(col, sep)``: NULLs skipped, all-NULL group -> NULL.

    The source leaves the order open; the values are sorted here so the text
    is deterministic.
    """
    s = sep.replace("'", "''")
    return F.expr(f"listagg(`{col_name}`, '{s}') WITHIN GROUP (ORDER BY `{col_name}`)")


def sum_coalesced(c: Column) -> Column:
    """``SUM(COALESCE(c, 0))``."""
    return F.sum(F.coalesce(c, F.lit(0)))
