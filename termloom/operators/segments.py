"""Windows over very long histories: a key's rows, or a whole table, cut into segments of near equal size.

A window over a key puts all its rows into one task, and a window over a whole table puts the table there. Here the rows of
every key that is too large for that are cut at quantiles of the order column, found once in one aggregation; other keys stay
whole. A window then runs within (key, segment), and what the earlier segments hand on is one small row a segment: a sum, or
the last value so far. Only keys with more than a fixed part of all rows are cut, so there are never more than a few segments
for each shuffle partition, and what is sent to every executor has that bound whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.history import RUNNING, in_order

#: Segments that a table as large as a shuffle partition's share would be cut into.
SEGMENTS_PER_PARTITION = 2
#: Keys of at most so many rows are never cut.
LEAST_ROWS = 1000
#: Relative accuracy of the quantiles, as the sketch counts it.
ACCURACY = 10_000
SEGMENT, BOUNDS = "_segment", "_bounds"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def segment_rows(df: DataFrame, total: int, least: int = LEAST_ROWS) -> int:
    """Rows of a segment: what keeps the tasks of a shuffle even."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // (SEGMENTS_PER_PARTITION * partitions)))


def segment_of(bounds: Column, value: Column, most: int) -> Column:
    """How many of the ascending ``bounds``, at most ``most``, are not above the value, by binary search; 0 for NULL."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        further = (at + width <= F.size(bounds)) & (F.try_element_at(bounds, at + width) <= value)
        return F.when(further, at + width).otherwise(at)

    return F.coalesce(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step), F.lit(0)) if steps else F.lit(0)


def measure(df: DataFrame, column: str) -> Column:
    """The column as quantiles and bounds see it: times as their distance from 1970, which no time zone changes."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(column)
    return F.col(column) - F.expr(EPOCH) if kind == "timestamp_ntz" else F.col(column)


def measured(df: DataFrame, column: str, value: Column) -> Column:
    """The value of the column that :func:`measure` gives as ``value``."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.timestamp_micros(value)
    return F.expr(EPOCH) + value if kind == "timestamp_ntz" else value


def quantiles(values: Column, parts: int) -> Column:
    return F.percentile_approx(values, [k / parts for k in range(1, parts)], ACCURACY)


def same_key(key: Sequence[str]) -> list[Column]:
    return [F.col(f"_own.{k}").eqNullSafe(F.col(f"_hot.{k}")) for k in key]


@dataclass(frozen=True)
class Segments:
    """The rows with their segment; ``hot`` has the keys that were cut, and is None if there is none."""

    rows: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None

    def window(self) -> WindowSpec:
        return in_order([*self.key, SEGMENT] if self.hot is not None else self.key, self.order)

    def summary(self, *aggregates: Column) -> DataFrame:
        """One row for each segment of the cut keys, reduced on the map side."""
        own = self.rows.alias("_own").join(F.broadcast(self.hot).alias("_hot"), same_key(self.key), "left_semi")
        return own.groupBy(*self.key, SEGMENT).agg(*aggregates)

    def with_carries(self, rows: DataFrame, carries: DataFrame, columns: Sequence[Column]) -> DataFrame:
        """Bring the segments' rows of ``carries`` back to their rows; both sides are named ``_own`` and ``_hot``."""
        same = [*same_key(self.key), F.col(f"_own.{SEGMENT}") == F.col(f"_hot.{SEGMENT}")]
        return rows.alias("_own").join(F.broadcast(carries).alias("_hot"), same, "left").select(*columns)


def segmented(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], least: int = LEAST_ROWS) -> Segments:
    """Cut the rows of large keys into segments by the first order column: a number, date or time.

    One job counts the rows of each key; only if it finds a large key, a second one takes that key's quantiles. NULL in the
    order comes first. Rows of a key that agree in the first order column stay together.
    """
    keys, orders = ((key,) if isinstance(key, str) else tuple(key)), ((order,) if isinstance(order, str) else tuple(order))
    spark, place = df.sparkSession, measure(df, orders[0])
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counted.agg(F.sum("_n")).first()[0] or 0
    rows = segment_rows(df, total, least)
    large = counted.where(F.col("_n") > rows).collect()  # at most SEGMENTS_PER_PARTITION for each shuffle partition
    if not large:
        return Segments(df, keys, orders, None)
    placed = df.select(*keys, place.alias("_place"))
    sizes = spark.createDataFrame(large, counted.schema)
    own = placed.alias("_own").join(F.broadcast(sizes).alias("_hot"), same_key(keys)).select("_own.*", "_n")
    parts = -(-max(r["_n"] for r in large) // rows)
    taken = own.groupBy(*keys).agg(F.max("_n").alias("_n"), quantiles(F.col("_place"), parts).alias(BOUNDS)).collect()
    cuts = []
    for row in taken:
        # Of the common quantiles, every key takes as many as its own size asks for.
        wanted = min(parts, -(-row["_n"] // rows))
        chosen = [row[BOUNDS][-(-k * parts // wanted) - 1] for k in range(1, wanted)] if row[BOUNDS] else []
        cuts.append((*[row[k] for k in keys], sorted(set(chosen))))
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField(BOUNDS, T.ArrayType(placed.schema["_place"].dataType))])
    hot = spark.createDataFrame(cuts, schema)
    joined = df.alias("_own").join(F.broadcast(hot).alias("_hot"), same_key(keys), "left")
    segment = segment_of(F.col(f"_hot.{BOUNDS}"), measure(df, orders[0]), parts - 1)
    return Segments(joined.select("_own.*", segment.alias(SEGMENT)), keys, orders, hot.select(*keys))


def running_over(cut: Segments, sums: Mapping[str, Column], lasts: Mapping[str, Column]) -> Segments:
    """The segments with running sums and last values added to their rows."""
    window = cut.window().rowsBetween(*RUNNING)
    local = {name: F.sum(c).over(window) for name, c in sums.items()}
    local |= {name: F.last(c, ignorenulls=True).over(window) for name, c in lasts.items()}
    if cut.hot is None:
        return replace(cut, rows=cut.rows.select("*", *[c.alias(name) for name, c in local.items()]))

    place = F.struct(*cut.order)
    handed = [F.sum(c).alias(name) for name, c in sums.items()]
    handed += [F.max_by(c, F.when(c.isNotNull(), place)).alias(name) for name, c in lasts.items()]
    earlier = Window.partitionBy(*cut.key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(name).over(earlier).alias(name) for name in sums]
    carried += [F.last(name, ignorenulls=True).over(earlier).alias(name) for name in lasts]
    carries = cut.summary(*handed).select(*cut.key, SEGMENT, *carried)

    out = [F.col(f"_own.{c}") for c in cut.rows.columns]
    for name in local:
        own, before = F.col(f"_own.{name}"), F.col(f"_hot.{name}")
        out.append(F.coalesce(*([own + before] if name in sums else []), own, before).alias(name))
    placed = cut.rows.select("*", *[c.alias(name) for name, c in local.items()])
    return replace(cut, rows=cut.with_carries(placed, carries, out))


def running(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """Add running sums and last non-NULL values over a key's rows up to each row, whatever a key's size.

    As window functions over the key with ``rows between unbounded preceding and current row``; rows that agree in the whole
    order may come in any order. A sum skips NULLs and is NULL up to the first value.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    return running_over(segmented(df, key, order, least), sums, lasts).rows.select(*df.columns, *sums, *lasts)


def long_marker_groups(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], marker: Column, name: str, least: int = LEAST_ROWS
) -> DataFrame:
    """:func:`history.marker_groups` for keys of any size."""
    return running(df, key, order, {name: F.when(marker, 1).otherwise(0)}, least=least)


def long_fill_forward(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    columns: Sequence[str],
    depth: int | None,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """:func:`history.fill_forward` for keys of any size: the last value travels with its row's number."""
    numbered = running_over(segmented(df, key, order, least), {"_nth": F.lit(1)}, {})
    lasts = {f"_last_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("value"), F.col("_nth").alias("nth"))) for c in columns}
    filled = running_over(numbered, {}, lasts).rows

    def value(c: str) -> Column:
        last = F.col(f"_last_{c}")
        return last["value"] if depth is None else F.when(F.col("_nth") - last["nth"] <= depth, last["value"])

    return filled.select(*[value(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def long_first_in_group(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], opens: Column, columns: Mapping[str, str], least: int = LEAST_ROWS
) -> DataFrame:
    """Carry the values (NULL too) of the row that opened a group to the group's rows; ``columns`` maps source to output.

    Rows before the first opened group get NULL.
    """
    lasts = {out: F.when(opens, F.struct(F.col(source).alias("value"))) for source, out in columns.items()}
    carried = running(df, key, order, lasts=lasts, least=least)
    return carried.select(*df.columns, *[F.col(out)["value"].alias(out) for out in columns.values()])


def lead_value(
    df: DataFrame, column: str, tie_break: Sequence[str] = (), name: str = "following", by: Sequence[str] = (), least: int = LEAST_ROWS
) -> DataFrame:
    """Add the column's next value in the order of the whole table or of each key (NULLs first).

    The table, or a large key, is cut into segments; the last row of a segment is followed by the least value of the next one.
    """
    if by:
        cut = segmented(df, by, (column, *tie_break), least)
        local = F.lead(column).over(cut.window())
        if cut.hot is None:
            return df.withColumn(name, local)
        over = Window.partitionBy(*cut.key).orderBy(SEGMENT)
        ends = cut.summary(F.min(column).alias("_least"))
        carries = ends.select(*cut.key, SEGMENT, F.lead("_least").over(over).alias("_next"))
        is_last = F.lead(F.lit(1)).over(cut.window()).isNull()
        rows = cut.rows.select("*", local.alias("_lead"), is_last.alias("_is_last"))
        after = F.when(F.col("_own._is_last"), F.col("_hot._next")).otherwise(F.col("_own._lead"))
        return cut.with_carries(rows, carries, [*[F.col(f"_own.{c}") for c in df.columns], after.alias(name)])

    order, total = [F.asc_nulls_first(c) for c in (column, *tie_break)], df.count()
    parts, place = -(-total // segment_rows(df, total, least)), measure(df, column)
    if parts <= 1:  # no more rows than a segment holds
        return df.withColumn(name, F.lead(column).over(Window.orderBy(*order)))
    bounds = sorted(set(df.agg(quantiles(place, parts)).first()[0] or []))
    rough = segment_of(F.array(*map(F.lit, bounds)), place, len(bounds)) if bounds else F.lit(0)
    # The quantiles may be rounded; the least value of each segment is exact, and where that segment starts.
    least_values = df.where(F.col(column).isNotNull()).groupBy(rough.alias(SEGMENT)).agg(F.min(place).alias("_least"))
    starts = sorted(r["_least"] for r in least_values.collect())  # one row a segment
    if not starts:
        return df.withColumn(name, F.col(column))
    known = F.array(*[F.lit(x).cast(df.select(place.alias("_")).schema[0].dataType) for x in starts])
    cut = df.withColumn(SEGMENT, segment_of(known, place, len(starts)))  # 0 for NULL
    within = Window.partitionBy(SEGMENT).orderBy(*order)
    is_last = F.lead(F.lit(1)).over(within).isNull()
    following = measured(df, column, F.try_element_at(known, F.col(SEGMENT) + 1))
    return cut.withColumn(name, F.when(is_last, following).otherwise(F.lead(column).over(within))).drop(SEGMENT)
