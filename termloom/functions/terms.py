"""Term codes: the year and month a term begins in, as one integer (YYYYMM)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def term_code(date: str | Column) -> Column:
    """YYYYMM of a date as an integer; NULL stays NULL."""
    return F.year(date) * 100 + F.month(date)


def shift_month(term: str | Column, shifts: Mapping[int, int]) -> Column:
    """Replace the month part of a term code, e.g. ``{6: 5}`` turns 202506 into 202505."""
    term = F.col(term) if isinstance(term, str) else term
    shifted = term
    for month, target in shifts.items():
        shifted = F.when(term % 100 == month, term + (target - month)).otherwise(shifted)
    return shifted
