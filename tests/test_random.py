"""The whole conversion against SQL on random inputs full of odd cases, and on hot keys."""

import dataclasses

import compare
import made_up
import oracle
import pytest

from termloom import student_term_history
from termloom.operators import lookup
from termloom.plans.student_history import derived_codes, term_facts
from termloom.sources.star import STAR_CONFIG

CFG = dataclasses.replace(
    STAR_CONFIG, active_year="2223", active_terms=("SP", "SU"), cutoff_term=202203, current_terms=(202203, 202206)
)


def conversion_sql() -> str:
    """The SQL is written for the star-schema parameters; only these differ."""
    sql = oracle.expected_sql(own_inputs=True)["student_term_history"]
    for old, new in (
        (f"'{STAR_CONFIG.active_year}'", f"'{CFG.active_year}'"),
        (str(STAR_CONFIG.current_terms), str(CFG.current_terms)),
        (f"< {STAR_CONFIG.cutoff_term}", f"< {CFG.cutoff_term}"),
    ):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


@pytest.mark.parametrize("seed", range(6))
def test_conversion(spark, seed):
    sources, con = made_up.tables(spark, made_up.random_rows(seed))
    assert compare.assert_same(student_term_history(sources, CFG), con, conversion_sql()) > 50


def hot_rows() -> dict[str, list[tuple]]:
    """One student holds most rows of every table."""
    rows = made_up.random_rows(11)
    valid = {c[0] for c in rows["courses"] if c[1] < "9" and c[3] in ("A", "B") and c[4] == "H" and c[5] and c[6]}
    hot = min(s for s in valid if s % 7 and sum(c[0] == s for c in rows["courses"]) >= 6)
    for table, times in (("courses", 900), ("degrees", 400), ("candidacy", 300)):
        rows[table] += [row for row in rows[table] if row[0] == hot] * times
    rows["degrees"] += [(hot, *row[1:]) for row in rows["degrees"][:100]] * 20
    year, term, begin, _ = rows["year_terms"][3]
    rows["degrees"].append((hot, begin, *[None] * 3, "", "M1", None, "", "BA", "U"))
    rows["candidacy"] += [(hot, year, term, "P", "1")] * 3000
    rows["external_ids"] += [(str(hot), 5)] * 2
    return rows


def test_hot_student(spark):
    rows = hot_rows()
    sources, con = made_up.tables(spark, rows)
    derived = derived_codes(term_facts(sources, CFG), CFG)
    pieces, copies = derived.selectExpr("count(*)", "sum(weight)").first()
    # Thousands of candidacy rows of one term are a handful of weighted rows inside the plan ...
    assert copies > 3000 and pieces < 1000
    # ... and all of them in the result.
    assert compare.assert_same(student_term_history(sources, CFG), con, conversion_sql()) > 2 * 3000


def test_without_any_broadcast(spark, monkeypatch):
    """Lookups too large to broadcast are joined by shuffle, with the same result."""
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 0)
    sources, con = made_up.tables(spark, made_up.random_rows(21))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert compare.assert_same(student_term_history(sources, CFG), con, conversion_sql()) > 50
    finally:
        spark.conf.set(threshold, before)
