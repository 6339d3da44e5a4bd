"""Joining to lookup tables whose size is checked before they are broadcast."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes up to which a lookup is sent to every executor.
MAX_BROADCAST_BYTES = 32 << 20
TEXT_BYTES, VALUE_BYTES = 40, 16


def row_bytes(df: DataFrame) -> int:
    """What a row takes in memory, from its schema; codes are short texts."""
    return sum(TEXT_BYTES if f.dataType.typeName() == "string" else VALUE_BYTES for f in df.schema.fields)


def fits(df: DataFrame, rows: int, max_bytes: int | None = None) -> bool:
    return rows * row_bytes(df) <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)


def row_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """How many rows each of several tables has, in one job."""
    names = [df.select(F.lit(name).alias("name")) for name, df in tables.items()]
    counted = functools.reduce(DataFrame.union, names).groupBy("name").agg(F.count("*").alias("n"))
    return dict.fromkeys(tables, 0) | {r["name"]: r["n"] for r in counted.collect()}


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a table really takes at most ``max_bytes`` (``MAX_BROADCAST_BYTES``): counted, not estimated."""
    return fits(df, df.count(), max_bytes)


def lookup_side(df: DataFrame, max_bytes: int | None = None, rows: int | None = None) -> DataFrame:
    """Mark a lookup for broadcast if it is small, and for a merge join if it is not.

    The second mark binds too: no estimate of Spark's can broadcast the table after all, and adaptive
    execution splits hot keys of the merge join. ``rows`` is its number of rows if that is known; otherwise a
    job counts them.
    """
    return F.broadcast(df) if fits(df, df.count() if rows is None else rows, max_bytes) else df.hint("merge")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The same rows, checked while they are read: a key that repeats stops the run and is named. NULLs may repeat.

    Every matching row would be multiplied otherwise, and a lookup of one value would not know which one to take.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count("*").alias("_n"), F.min(F.struct(*others)).alias("_row"))
    message = F.concat(F.lit(f"{key} occurs more than once in a lookup table, for example "), F.col(key).cast("string"))
    checked = grouped.where(F.assert_true(F.col(key).isNull() | (F.col("_n") == 1), message).isNull())
    return checked.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def override_code(df: DataFrame, key: str, value: str, mapping: dict[str, str]) -> DataFrame:
    """Replace ``value`` on the rows whose ``key`` is listed in ``mapping``."""
    new = F.col(value)
    for code, replacement in mapping.items():
        new = F.when(F.col(key) == code, F.lit(replacement)).otherwise(new)
    return df.withColumn(value, new)


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; no row is multiplied."""
    return df.join(keys.select(on), on, "left_semi")


def lookup_equals(df: DataFrame, lookup: DataFrame, key: str, value: str, compared: str, name: str) -> DataFrame:
    """Add ``name``: 'Y' where the lookup's ``value`` for the row's ``key`` equals ``compared``, else 'N'.

    A key that the lookup does not have gives 'N'; one that it repeats stops the run.
    """
    side = one_row_per_key(lookup.select(key, F.col(value).alias("_looked_up")), key)
    same = F.when(F.col("_looked_up") == F.col(compared), F.lit("Y")).otherwise(F.lit("N"))
    return df.join(side, key, "left").withColumn(name, same).drop("_looked_up")


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys with more than half a shuffle partition's share of all rows: at most two for each partition. One job."""
    counted = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counted.agg(F.sum("_n")).first()[0] or 0
    limit = total / (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return [r[key] for r in counted.where(F.col(key).isNotNull() & (F.col("_n") > limit)).collect()]


def spread_left_join(
    df: DataFrame, side: DataFrame, key: str, spread_by: Sequence[str], hot: Sequence | None = None
) -> DataFrame:
    """Left join to a lookup too large to broadcast, with the rows of hot keys spread over all shuffle partitions.

    The lookup's rows of a hot key are copied to every place where rows of that key can be; rows without a key match
    nothing and are spread too. ``spread_by`` are columns that tell the rows of a key apart. ``hot`` lists the hot keys if
    they are known, such as an empty code; otherwise one job finds them. Other keys move as in any merge join.
    """
    hot = hot_keys(df, key) if hot is None else list(hot)
    places = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(key).isin(*hot) if hot else F.lit(False)
    place = F.when(F.col(key).isNull() | is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(places))).otherwise(0)
    every = F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))
    copies = F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("long")))
    copied = side.withColumn("_place", F.explode(copies)).hint("merge")
    joined = df.withColumn("_place", place.cast("long")).join(copied, [key, "_place"], "left")
    return joined.select(*df.columns, *[c for c in side.columns if c != key])
