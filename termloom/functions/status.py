"""The rules that derive load, type, status and level codes from a term and its neighbours.

All of them are plain Column expressions over values the caller has already put side by side
(own row, previous row, next row), so one sorted window pass serves every rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.config import Config

# Event names; fixed values.
ENTRY = "entry date"
EXIT = "exit date"
CONFERRED = "degree conferred date"
WITHDRAWN = "withdrawal date"
START = "start enroll"
LAST = "last enroll"


def code_of(value: Column, names: Mapping[int, str]) -> Column:
    """Name of an integer code, NULL when it has none."""
    name = F.lit(None).cast("string")
    for code, text in names.items():
        name = F.when(value == code, F.lit(text)).otherwise(name)
    return name


def degree_level(cfg: Config) -> Column:
    """Level of a degree by the first matching rule; NULL when no rule matches."""
    level = F.lit(None).cast("int")
    for column, codes, value in reversed(cfg.level_rules):
        level = F.when(F.col(column).isin(*codes), F.lit(value)).otherwise(level)
    return level


def load_indicator(
    cfg: Config, hours: Column, previous: Column, following: Column, row_num: Column, declared: Column
) -> Column:
    """``F`` or ``P`` by hours; without hours by the neighbouring term, then as declared, then ``F``.

    The neighbour is the next term on a student's first row and the previous term on later rows.
    """

    def by_hours(h: Column) -> Column:
        return F.when(h >= cfg.full_time_hours, F.lit("F")).when(h > 0, F.lit("P"))

    neighbour = F.when(row_num == 1, following).otherwise(previous)
    return F.coalesce(by_hours(hours), F.when(hours.isNull(), by_hours(neighbour)), declared, F.lit("F"))


def initial_type(cfg: Config, level: Column, degree_seeking: Column, transfer: Column) -> Column:
    """``9`` for a low level that is surely not degree-seeking, else ``2`` with transfer courses, else ``3``."""
    return (
        F.when((level < cfg.degree_level_floor) & ~degree_seeking, F.lit("9"))
        .when(transfer, F.lit("2"))
        .otherwise(F.lit("3"))
    )


def seeks_degree(cfg: Config, joined_codes: Column) -> Column:
    """Substring tests over the ;-joined, sorted degree codes; NULL text gives NULL."""
    found = joined_codes.contains(f";{cfg.degree_middle_mark};")
    for mark in cfg.degree_marks:
        found = found | joined_codes.contains(mark)
    return found


def status_code(cfg: Config, term: Column, row_num: Column, row_count: Column, has: Mapping[str, Column]) -> Column:
    """``AS`` / ``IS`` / ``GR`` from the events of the term and its place in the history."""
    leaving = has[LAST] | has[WITHDRAWN]
    return (
        F.when(row_count == 1, F.lit("AS"))
        .when(((row_num == row_count) | leaving) & (term < cfg.cutoff_term), F.lit("IS"))
        .when(leaving & term.isin(*cfg.current_terms), F.lit("AS"))
        .when(has[START] | has[ENTRY] | has[EXIT], F.lit("AS"))
        .when(has[CONFERRED], F.lit("GR"))
    )


def one_character(value: Column) -> Column:
    """An integer as text one character wide: ``*`` when it does not fit."""
    return F.when(value.between(0, 9), value.cast("string")).when(value.isNotNull(), F.lit("*"))


def level_code(
    cfg: Config,
    level: Column,
    previous_level: Column,
    next_level: Column,
    rank: Column,
    has: Mapping[str, Column],
    previous_entry: Column,
    next_entry: Column,
) -> Column:
    """Level name of the term; a term without a degree borrows it from credit type or a neighbour."""
    unknown = F.lit(cfg.level_unknown)
    by_rank = F.coalesce(code_of(rank, cfg.level_names), unknown)
    previous_name = code_of(previous_level, cfg.level_names)
    leaving = F.when(has[START] | previous_level.isNull(), by_rank).otherwise(
        F.coalesce(previous_name, one_character(previous_level))
    )
    starting = (
        F.when(previous_entry, F.coalesce(previous_name, unknown))
        .when(next_entry, F.coalesce(code_of(next_level, cfg.level_names), unknown))
        .otherwise(by_rank)
    )
    borrowed = F.when(has[LAST], leaving).when(has[START], starting)
    return F.when(level.isNull(), borrowed).otherwise(code_of(level, cfg.level_names_own))


def student_type(starts: Column, own: Column, previous: Column) -> Column:
    """Continuing (``C``) or advancing (``A``) by the previous row's initial type, else the own one."""
    return F.when(~starts & (previous == "9"), F.lit("C")).when(previous.isin("2", "3"), F.lit("A")).otherwise(own)
