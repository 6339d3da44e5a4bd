"""Dated events per student: milestone dates, enrolment bounds and the timeline made of both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.status import CONFERRED, ENTRY, EXIT, LAST, START, WITHDRAWN

# Date column of a degree record -> event name.
MILESTONES = {
    "entry_dte": ENTRY,
    "exit_dte": EXIT,
    "dte_degr_conferred": CONFERRED,
    "withdrawal_dte": WITHDRAWN,
}
# Curriculum columns every event carries.
CURRICULUM = ("major_1", "degr_cde", "div_cde", "major_2", "concentration_1")


def unpivot_dates(
    df: DataFrame, dates: Mapping[str, str], keep: Sequence[str], reasons: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per date column, in one scan. ``reasons`` names the reason column of an event, '' elsewhere."""
    reasons = reasons or {}
    events = [
        F.struct(
            F.col(column).alias("sig_date"),
            F.lit(label).alias("sig_desc"),
            (F.col(reasons[label]) if label in reasons else F.lit("")).alias("reason_code"),
        )
        for column, label in dates.items()
    ]
    return df.select(*keep, F.explode(F.array(*events)).alias("_event")).select(
        keep[0], "_event.*", *keep[1:]
    )


def milestone_events(degrees: DataFrame) -> DataFrame:
    """Milestones of the degree records, undated ones included and repeats kept."""
    return unpivot_dates(degrees, MILESTONES, ("id_num", *CURRICULUM), {EXIT: "exit_reason"})


def first_last(df: DataFrame, key: str, predicate: Column, date: str) -> DataFrame:
    """Earliest and latest date per key over the rows that satisfy ``predicate``, in one pass."""
    return (
        df.where(predicate)
        .groupBy(key)
        .agg(F.min(date).alias("first_term_date"), F.max(date).alias("last_term_date"))
    )


def event_timeline(milestones: DataFrame, bounds: DataFrame) -> DataFrame:
    """Distinct dated milestones and, for every enrolled student, the first and last enrolment."""
    blank = bounds.select("*", *[F.lit("").alias(c) for c in CURRICULUM])
    enrolments = unpivot_dates(
        blank, {"first_term_date": START, "last_term_date": LAST}, ("id_num", *CURRICULUM)
    )
    return milestones.where(F.col("sig_date").isNotNull()).unionByName(enrolments).distinct()
