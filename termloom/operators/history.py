"""Operators over a key's rows in order: groups opened by a marker, first values, bounded fill.

All work on rows that were collapsed to one per key and period before, so a key holds at most
as many rows as there are periods, however many raw rows it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Frame of all rows of a key.
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)
# Frame of a row and all before it.
RUNNING = (Window.unboundedPreceding, Window.currentRow)


def in_order(key: str | Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in orders])


def marker_groups(df: DataFrame, key: str, order: str | Sequence[str], marker: Column, name: str) -> DataFrame:
    """Number the groups of a history; every marked row opens a new one, rows before the first are group 0."""
    running = in_order(key, order).rowsBetween(*RUNNING)
    return df.withColumn(name, F.sum(F.when(marker, 1).otherwise(0)).over(running))


def first_in_group(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], columns: dict[str, str]
) -> DataFrame:
    """Carry the group's first value (NULL too) to all its rows; ``columns`` maps source to output."""
    running = in_order(keys, order).rowsBetween(*RUNNING)
    return df.select("*", *[F.first(source).over(running).alias(out) for source, out in columns.items()])


def fill_forward(
    df: DataFrame, key: str, order: str | Sequence[str], columns: Sequence[str], depth: int | None
) -> DataFrame:
    """Replace NULLs by the nearest value of the last ``depth`` rows (all earlier rows if None)."""
    start = Window.unboundedPreceding if depth is None else -depth
    recent = in_order(key, order).rowsBetween(start, Window.currentRow)
    return df.select(
        *[F.last(c, ignorenulls=True).over(recent).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
