"""From histories to the output: next observed period, follow-up rows, fixed column layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.segments import lead_value


def next_in_domain(df: DataFrame, column: str, name: str, large: bool = False) -> DataFrame:
    """Every value of a column with the next larger one that occurs.

    A domain of periods is small and sorted in one task; a ``large`` one is cut into segments.
    """
    domain = df.select(column).distinct()
    if large:
        return lead_value(domain, column, name=name)
    return domain.withColumn(name, F.lead(column).over(Window.orderBy(F.asc_nulls_first(column))))


def emit_follow_up(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """Repeat the rows that meet ``condition``: ``name`` is 1 on every row and 2 on a repeat.

    One pass over the input instead of a union of two copies of its plan.
    """
    numbers = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn(name, F.explode(numbers))


def project_layout(df: DataFrame, columns: tuple[str, ...], values: Mapping[str, Column], prefix: str = "") -> DataFrame:
    """Select a fixed layout; columns without a value are ''. The last column takes no prefix."""
    names = [prefix + c for c in columns[:-1]] + [columns[-1]]
    return df.select(*[values.get(c, F.lit("")).alias(n) for c, n in zip(columns, names, strict=True)])
