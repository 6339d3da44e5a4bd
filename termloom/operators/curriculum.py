"""Majors and degrees of a term: unpivot, split, number into slots, map to target codes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import status
from termloom.operators.lookup import fits, lookup_side, one_row_per_key, spread_left_join

SLOT_KEYS = ("id_num", "term_code")
# What identifies one entry of a term; also the order in which entries take slots.
SLOT_ORDER = ("mmd_degr_cde", "major_1", "degree_history_degr_cde", "concentration_1")


def map_majors(events: DataFrame, majors: DataFrame) -> DataFrame:
    """Distinct majors of each term with the degree each major leads to, codes trimmed."""
    side = lookup_side(majors.select("major_cde", "degr_cde").distinct())
    first = side.select(F.col("major_cde").alias("major_1"), F.col("degr_cde").alias("mmd_degr_cde"))
    second = side.select(F.col("major_cde").alias("major_2"), F.col("degr_cde").alias("mmd2_degr_cde"))
    return (
        events.join(first, "major_1", "left")
        .join(second, "major_2", "left")
        .select(
            *SLOT_KEYS,
            F.trim("major_1").alias("major_1"),
            "mmd_degr_cde",
            F.trim("major_2").alias("major_2"),
            "mmd2_degr_cde",
            F.trim("concentration_1").alias("concentration_1"),
            "degr_cde",
        )
        .distinct()
    )


def event_degrees(events: DataFrame, cfg: Config) -> DataFrame:
    """Distinct degrees of each term with their levels."""
    level = status.degree_level(cfg).alias("degree_level")
    return events.select(*SLOT_KEYS, F.trim("degr_cde").alias("degr_cde"), level).distinct()


def unpivot_slots(df: DataFrame, keep: Sequence[str], pairs: Sequence[tuple[str, str]], names: tuple[str, str]) -> DataFrame:
    """One distinct row per non-empty slot; each pair is (code column, companion column)."""
    items = F.array(*[F.struct(F.col(a).alias(names[0]), F.col(b).alias(names[1])) for a, b in pairs])
    return (
        df.select(*keep, F.explode(items).alias("_slot"))
        .select(*keep, "_slot.*")
        .where(F.col(names[0]) != "")
        .distinct()
    )


def term_majors(event_majors: DataFrame) -> DataFrame:
    """Both majors of every event below each other."""
    return unpivot_slots(
        event_majors.withColumnRenamed("degr_cde", "degree_history_degr_cde"),
        (*SLOT_KEYS, "degree_history_degr_cde", "concentration_1"),
        (("major_1", "mmd_degr_cde"), ("major_2", "mmd2_degr_cde")),
        ("major_1", "mmd_degr_cde"),
    )


def split_by_codes(df: DataFrame, column: str, codes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows outside and inside a code list; a NULL code is in neither."""
    inside = F.col(column).isin(*codes)
    return df.where(~inside), df.where(inside)


def slot_pivot(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], k: int = 2) -> DataFrame:
    """The first ``k`` rows per key side by side: ``<column>_<slot>``; missing slots are NULL.

    The bound on the row number is applied before the shuffle as well as after it, so a task
    receives at most ``k`` rows of a key from every other task.
    """
    numbered = df.withColumn(
        "_slot", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in order]))
    ).where(F.col("_slot") <= k)
    return numbered.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_slot") == slot, F.col(c))).alias(f"{c}_{slot}")
            for slot in range(1, k + 1)
            for c in columns
        ]
    )


def map_key(*parts: str | Column) -> Column:
    """Codes joined without a separator, NULL read as ''."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c, F.lit("")) for c in columns])


def two_slots(entries: DataFrame) -> DataFrame:
    """First and second entry of a term with their map keys."""
    columns = ("mmd_degr_cde", "major_1", "concentration_1")
    slots = slot_pivot(entries, SLOT_KEYS, SLOT_ORDER, columns)
    return slots.select(
        *SLOT_KEYS,
        *[
            c
            for n in (1, 2)
            for c in (
                F.col(f"major_1_{n}").alias(f"major_{n}"),
                F.col(f"mmd_degr_cde_{n}").alias(f"degree_{n}"),
                F.col(f"concentration_1_{n}").alias(f"concentration_{n}"),
                map_key(*[f"{c}_{n}" for c in columns]).alias(f"map_key_{n}"),
            )
        ],
    )


class CodeMap(NamedTuple):
    """A map with one row per key, and whether it is sent to every executor."""

    rows: DataFrame
    small: bool


def code_map(df: DataFrame, key: str, rows: int) -> CodeMap:
    """``rows`` is the map's number of rows. A key that repeats stops the run."""
    small = fits(df, rows)
    side = one_row_per_key(df, key)
    return CodeMap(F.broadcast(side) if small else side, small)


def map_codes(df: DataFrame, full_map: CodeMap, degree_map: CodeMap) -> DataFrame:
    """Target codes of the two degree slots.

    Active students are mapped by degree, major and concentration together; others by degree
    alone, keeping the raw major. Needs ``is_active`` and ``has_major`` as booleans. Terms without a
    slot have an empty key: against a large map, these rows are spread.
    """
    for n in (1, 2):
        full = full_map.rows.select(
            F.col("map_code").alias(f"map_key_{n}"),
            *[F.col(c).alias(f"_full_{c}_{n}") for c in ("college", "degree", "major", "concentration", "program")],
        )
        plain = degree_map.rows.select(
            F.col("degree_code").alias(f"degree_{n}"),
            *[F.col(c).alias(f"_plain_{c}_{n}") for c in ("college", "degree", "program")],
        )
        for side, small, key in ((full, full_map.small, f"map_key_{n}"), (plain, degree_map.small, f"degree_{n}")):
            df = df.join(side, key, "left") if small else spread_left_join(df, side, key, SLOT_KEYS, hot=[""])

    active, has_major = F.col("is_active"), F.col("has_major")
    two_degrees = F.col("degree_1") != F.col("degree_2")
    one_degree = F.col("degree_1") == F.col("degree_2")

    def code(name: str, n: int) -> Column:
        other = F.col(f"major_{n}") if name == "major" else F.col(f"_plain_{name}_{n}")
        return F.when(active, F.col(f"_full_{name}_{n}")).otherwise(other)

    mapped = df.select(
        "*",
        code("college", 1).alias("coll_code_1"),
        code("degree", 1).alias("degc_code_1"),
        code("major", 1).alias("majr_code_1"),
        F.when(active, F.col("_full_concentration_1")).alias("majr_code_conc_1"),
        F.when(two_degrees, code("college", 2)).alias("coll_code_2"),
        F.when(two_degrees, code("degree", 2)).alias("degc_code_2"),
        F.when(two_degrees, code("major", 2)).alias("majr_code_2"),
        F.when(two_degrees & active & has_major, F.col("_full_concentration_2")).alias("majr_code_conc_2"),
        F.when(one_degree, code("major", 2)).alias("majr_code_1_2"),
        code("program", 1).alias("program_1"),
        # The inactive program of the second slot does not ask whether the degrees differ.
        F.when(has_major & (two_degrees | ~active), code("program", 2)).alias("program_2"),
    )
    return mapped.drop(*[c for c in mapped.columns if c.startswith(("_full_", "_plain_"))])


def default_first_row(df: DataFrame, cfg: Config) -> DataFrame:
    """Default codes on a student's first row when its college is unmapped. Tests see the mapped values."""
    bare = F.col("coll_code_1").isNull() & (F.col("row_num") == 1)
    changed = {
        "coll_code_1": F.when(bare, F.lit(cfg.first_row_college)).otherwise(F.col("coll_code_1")),
        "degc_code_1": F.when(bare, F.lit(cfg.first_row_degree)).otherwise(F.col("degc_code_1")),
        "majr_code_1": F.coalesce("majr_code_1", F.when(bare, F.lit(cfg.first_row_major))),
        "program_1": F.when(
            F.col("has_major"), F.when(bare, F.lit(cfg.first_row_program)).otherwise(F.col("program_1"))
        ),
    }
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])
