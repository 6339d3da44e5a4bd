"""Small inputs for the nine tables, given as rows or drawn at random, in Spark and in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import random

import duckdb
from pyspark.sql import SparkSession

from termloom.sources import SCHEMAS, Sources, conform

DAY = datetime.date


def tables(spark: SparkSession, rows: dict[str, list[tuple]]) -> tuple[Sources, duckdb.DuckDBPyConnection]:
    """Both engines over the same rows; tables not given are empty."""
    con = duckdb.connect()
    frames = {}
    for name, schema in SCHEMAS.items():
        ddl = ", ".join(f"{c} {kind}" for c, kind in schema.items()).replace("number", "decimal(9,3)")
        con.execute(f"CREATE TABLE {name} ({ddl})")
        given = rows.get(name, [])
        if given:
            marks = ", ".join("?" * len(schema))
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", given)
        exact = [tuple(decimal.Decimal(v) if v is not None and kind == "number" else v for v, kind in zip(row, schema.values(), strict=True)) for row in given]
        frames[name] = conform(spark.createDataFrame(exact, ddl), name)
    return Sources(**frames), con


def random_rows(seed: int, students: int = 60) -> dict[str, list[tuple]]:
    """Rows that hit the odd cases often: NULLs, ties, gaps, repeated keys, unknown codes."""
    r = random.Random(seed)
    begins = []
    day = DAY(2020, 1, 10)
    for i in range(12):
        begins.append(day)
        day += datetime.timedelta(days=r.choice([0, 25, 110, 140, 150]) if i < 11 else 0)
    year_terms = [
        (f"{20 + i // 3}{21 + i // 3}", ("FA", "SP", "SU")[i % 3], b, b + datetime.timedelta(days=90))
        for i, b in enumerate(begins)
    ]
    year_terms.append(("ZZZZ", "ZZ", DAY(1900, 1, 1), DAY(1900, 1, 1)))
    year_terms.append((None, "FA", DAY(2021, 1, 1), DAY(2021, 2, 1)))
    known = [t[:2] for t in year_terms[:12]]
    degrees = ["BA", "BS", "A", "V", "C", "NDA", "BSW", "AGS", "ADE", "XS", "Z", None]
    majors = [f"M{i}" for i in range(9)] + ["LAR"]

    def term():
        kind = r.random()
        if kind < 0.06:
            return ("TRAN", "TR")
        if kind < 0.1:
            return ("9999", "XX")
        return r.choice(known)

    def when(null: float):
        if r.random() < null:
            return None
        return DAY(2019, 12, 1) + datetime.timedelta(days=r.randrange(1500))

    courses, candidacy, records = [], [], []
    for student in range(students):
        for _ in range(r.choice([0, 1, 2, 6, 14])):
            hours = r.choice([0, 1, 3, 4, "3.999", "0.004", 12, None])
            courses.append(
                (
                    student,
                    *term(),
                    r.choice(["A", "A", "A", "B", "T", "TU", None]),
                    r.choice(["H", "H", "H", "D", None]),
                    r.choice([0, 3, 3, "0.004", None]),
                    hours,
                    r.choice(["CR", "VO", "CE", "XX", None]),
                )
            )
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            major = r.choice([*majors, "M99", None, ""])
            second = r.choice([None, None, "", *majors])
            records.append(
                (
                    student,
                    when(0.1),
                    when(0.6),
                    when(0.6),
                    when(0.7),
                    r.choice(["", "X", None]),
                    major,
                    second,
                    r.choice(["", "", "C0", "C1", None]),
                    r.choice(degrees),
                    r.choice(["U", "A", "X", None, "X"]),
                )
            )
        for _ in range(r.choice([0, 1, 1, 3])):
            row = (student, *r.choice([*known, ("ZZZZ", "ZZ"), ("9999", "XX")]), r.choice(["F", "P", None]), r.choice("12"))
            candidacy += [row] * r.choice([1, 1, 1, 2, 9, 30])
    of = {m: r.choice([d for d in degrees if d] + [None]) for m in majors}
    full = [
        (f"{of[m] or ''}{m}{c}", r.choice(["U", "V", None]), f"D{of[m]}", f"B{m}", c or None, f"P{m}")
        for m in majors
        for c in ("", "C0")
        if r.random() < 0.8
    ]
    plain = [(d, r.choice(["U", None]), f"T{d}", f"Q{d}") for d in degrees if d and r.random() < 0.7]
    return {
        "year_terms": year_terms,
        "courses": courses,
        "candidacy": candidacy,
        "degrees": records,
        "majors": list(of.items()) * 2 + [("LAR", "BS"), ("LAR", "BA"), (majors[seed % 9], "BA")],
        "cohort": [(s,) for s in range(students) if s % 7],
        "code_map": full,
        "degree_map": plain,
        "external_ids": [(str(s), 1000 + s) for s in range(students) if s % 5]
        + [("x", 1), (None, 2)]
        + [(str(s), 1000 + s + s % 2) for s in range(0, students, 6)] * 3,
    }
