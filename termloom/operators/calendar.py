"""The term calendar and the two ways rows find their term: by code and by date."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions.terms import term_code
from termloom.operators.lookup import lookup_side
from termloom.operators.segments import lead_value, running


def extend_intervals(
    df: DataFrame,
    begin: str,
    end: str,
    tie_break: Sequence[str] = (),
    last_end: datetime.date | None = None,
    by: Sequence[str] = (),
    large: bool = False,
) -> DataFrame:
    """Give each interval the day before the next begin as its end, closing all gaps.

    The last interval ends at ``last_end``, or stays open (NULL). With ``by`` every key has intervals of its own. A calendar
    is looked up over the whole table in one task; ``large`` tables and those of many keys are cut into segments, so that
    neither a table nor a hot key meets in one task.
    """
    if by or large:
        followed = lead_value(df, begin, tie_break, "_following", by)
    else:
        order = Window.orderBy(*[F.asc_nulls_first(c) for c in (begin, *tie_break)])
        followed = df.withColumn("_following", F.lead(begin).over(order))
    following = F.date_sub("_following", 1)
    if last_end is not None:
        # NULL begins come first, so only the last row with a begin is followed by none.
        is_last = F.col("_following").isNull() & F.col(begin).isNotNull()
        following = F.when(is_last, F.lit(last_end)).otherwise(following)
    return followed.select(following.alias(end), *df.columns)


def term_calendar(year_terms: DataFrame, cfg: Config) -> DataFrame:
    """Real terms with gap-free ends."""
    return extend_intervals(
        year_terms.where(F.col("yr_cde") != cfg.dummy_year),
        "trm_begin_dte",
        "extend_trm_end_dte",
        ("yr_cde", "trm_cde"),
        cfg.last_term_end,
    )


def code_table(calendar: DataFrame) -> DataFrame:
    """Term code and begin date of each academic year and term."""
    return calendar.select("yr_cde", "trm_cde", term_code("trm_begin_dte").alias("term_code"), "trm_begin_dte")


def term_codes(calendar: DataFrame) -> DataFrame:
    """Lookup from academic year and term to term code and begin date."""
    return lookup_side(code_table(calendar))


def attach_term(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Add the term code and begin date of a row's academic year and term; NULL if unknown."""
    return df.join(codes, ["yr_cde", "trm_cde"], "left")


def month_number(date: str | Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def month_table(calendar: DataFrame, begin: str = "trm_begin_dte", end: str = "extend_trm_end_dte") -> DataFrame:
    """One row per calendar month that an interval touches: month, both bounds, term code."""
    return calendar.where(F.col(end) >= F.col(begin)).select(
        F.explode(F.sequence(month_number(begin), month_number(end))).alias("month"),
        F.col(begin).alias("first_day"),
        F.col(end).alias("last_day"),
        term_code(begin).alias("term_code"),
    )


def term_months(calendar: DataFrame, begin: str = "trm_begin_dte", end: str = "extend_trm_end_dte") -> DataFrame:
    """Lookup with one row per calendar month that an interval touches."""
    return lookup_side(month_table(calendar, begin, end))


def interval_lookup(df: DataFrame, months: DataFrame, on: str, name: str = "term_code") -> DataFrame:
    """Left join each row to the term its date falls into; ``months`` comes from :func:`term_months`.

    An equi-join on the month with the interval as a further condition: one hash probe per row that meets
    the few terms of a month, whatever the number of terms. A time of day is ignored.
    """
    side = months.select(
        F.col("month").alias("_of_month"),
        F.col("first_day").alias("_first_day"),
        F.col("last_day").alias("_last_day"),
        F.col("term_code").alias(name),
    )
    day = F.col("_day")
    inside = (month_number(day) == F.col("_of_month")) & day.between(F.col("_first_day"), F.col("_last_day"))
    dated = df.withColumn("_day", F.col(on).cast("date"))
    return dated.join(side, inside, "left").drop("_day", "_of_month", "_first_day", "_last_day")


def keyed_interval_lookup(
    df: DataFrame, intervals: DataFrame, key: str, on: str, begin: str, end: str, values: Sequence[str]
) -> DataFrame:
    """Left join each row to the interval of its own key that its date falls into, adding ``values``; both sides large.

    The intervals of a key must not overlap, as :func:`extend_intervals` leaves them. Both sides become rows of one shape,
    sorted by key and date, and every row meets the last interval that began before it: one shuffle by key and no pair of
    rows is compared, however long the intervals are. A hot key is cut into segments by date. Empty intervals, and rows
    without a key, match nothing. A time of day is ignored.
    """
    found = F.struct(F.col(end).cast("date").alias("end"), *values)
    real = intervals.where(F.col(key).isNotNull() & (F.col(end).cast("date") >= F.col(begin).cast("date")))
    starts = real.select(F.col(key).alias("_key"), F.col(begin).cast("date").alias("_day"), F.lit(0).alias("_kind"), found.alias("_interval"))
    rows = df.select(F.col(key).alias("_key"), F.col(on).cast("date").alias("_day"), F.lit(1).alias("_kind"), F.struct("*").alias("_row"))
    both = starts.unionByName(rows, allowMissingColumns=True)
    met = running(both, "_key", ("_day", "_kind"), lasts={"_last": F.col("_interval")}).where("_kind = 1")
    inside = F.col("_key").isNotNull() & (F.col("_day") <= F.col("_last.end"))
    return met.select("_row.*", *[F.when(inside, F.col(f"_last.{v}")).alias(v) for v in values])
