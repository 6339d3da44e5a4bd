"""Collapsing many rows per key into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes that a joined text may have; a cell of a table cannot hold 2 GB.
MOST_TEXT = 1 << 30


def collapse(
    df: DataFrame,
    keys: Sequence[str],
    lists: Mapping[str, str],
    maxima: Mapping[str, str] | None = None,
    separator: str = ";",
    most: int = MOST_TEXT,
) -> DataFrame:
    """Join the values of each ``lists`` column per key, sorted and with repeats, and take maxima.

    ``lists`` and ``maxima`` map source column to output column. NULLs are skipped, '' is kept.
    Repeats are counted per value before anything is gathered, so a group with very many rows is
    reduced on the map side and reaches its task as one row per different value. The joined text still
    has every repeat, so it grows with the rows of its key; where only the presence of a value matters,
    use :func:`flag_any`, as the conversion does. A run of equal values of more than ``most`` bytes stops the job
    and says so, instead of running a task out of memory.
    """
    maxima = maxima or {}
    values = F.array(
        *[F.struct(F.lit(out).alias("name"), F.col(column).alias("value")) for column, out in lists.items()]
    )
    counted = (
        df.select(*keys, *maxima, F.explode(values).alias("_item"))
        .groupBy(*keys, F.col("_item.name").alias("_name"), F.col("_item.value").alias("_value"))
        .agg(F.count("*").alias("_n"), *[F.max(column).alias(column) for column in maxima])
    )
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    # The length of a run of equal values is known before it is written out.
    size = f"_n * (octet_length(_value) + {len(separator.encode())})"
    failed = f"raise_error(concat('joined text of more than {most} bytes, at a value that occurs ', _n, ' times'))"
    run = f"case when {size} > {most} then {failed} else concat(_value, repeat(concat('{quoted}', _value), cast(_n - 1 as int))) end"
    counted = counted.withColumn("_run", F.expr(run))
    joined = [
        F.expr(f"listagg(case when _name = '{out}' then _run end, '{quoted}') within group (order by _value)").alias(out)
        for out in lists.values()
    ]
    return counted.groupBy(*keys).agg(*joined, *[F.max(column).alias(out) for column, out in maxima.items()])


def count_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_by_term(courses: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return courses.groupBy(*keys).agg(F.sum(value).alias(name))


def max_rank(df: DataFrame, keys: Sequence[str], rank: Column, name: str) -> DataFrame:
    """Highest rank per key; no distinct is needed in front of a maximum."""
    return df.groupBy(*keys).agg(F.max(rank).alias(name))


def flag_any(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """For each key, whether any row satisfies each predicate. One pass for all flags."""
    return df.groupBy(key).agg(
        *[F.max(F.coalesce(predicate, F.lit(False))).alias(name) for name, predicate in flags.items()]
    )
