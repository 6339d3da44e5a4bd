"""Properties of the physical plans, on inputs stored as files."""

import dataclasses
import re

import pytest

from termloom import Sources, student_term_history
from termloom.plans import student_history
from termloom.plans.student_history import KEPT, history_rows
from termloom.sources.star import STAR_CONFIG, star_sources

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    sources = star_sources(spark, DATA)
    for field in dataclasses.fields(sources):
        getattr(sources, field.name).write.parquet(f"{folder}/{field.name}.parquet")
    return Sources.parquet(spark, folder)


@pytest.fixture(scope="module")
def text(spark, stored):
    """The plan as chosen for large tables: a large cohort, and nothing is broadcast by estimate."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "5000"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        patch = pytest.MonkeyPatch()
        patch.setattr(student_history, "fits", lambda df, rows: False)
        df = history_rows(stored, STAR_CONFIG).select(*KEPT)
        patch.undo()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def scans(text, table):
    """Scans of a table in the plan itself, not in the cached lookups."""
    return re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", text)


def test_big_tables_are_scanned_once(text):
    assert len(scans(text, "courses")) == 1
    assert len(scans(text, "candidacy")) == 1
    # Once for the flags and once for the slots.
    assert len(scans(text, "degrees")) == 2


def test_only_needed_columns_are_read(text):
    by_columns = sorted(len(re.search(r"ReadSchema: struct<([^>]*)>", line).group(1).split(","))
                        for line in text.splitlines() if "/degrees.parquet" in line)
    assert by_columns == [8, 9]


def test_no_python_and_no_pairwise_join(text):
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_lookups_are_hash_probes(text):
    # Calendar twice by code and four times by day, majors once, code maps four times.
    assert "SemiJoin" not in text and "LeftSemi" not in text
    assert text.count("BroadcastHashJoin") == 11


def test_rows_are_reduced_before_they_move(text):
    """Course rows meet a partial aggregation below the first exchange above their scan."""
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "/courses.parquet" in line)
    above = [re.sub(r"^[ :+\-]*\*?(\(\d+\) )?", "", line) for line in reversed(lines[:scan])]
    first_exchange = next(i for i, line in enumerate(above) if line.startswith("Exchange"))
    assert any(line.startswith("HashAggregate") and "partial_sum" in line for line in above[:first_exchange])


def test_one_shuffle_serves_all_student_windows(text):
    """Above the exchange by student come all windows and no other exchange of the rows."""
    lines = text.splitlines()
    by_student = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(id_num#\d+L, \d+\)", line)]
    windows = [i for i, line in enumerate(lines) if re.match(r"^[ :+\-]*\*?(\(\d+\) )?Window \[", line)]
    assert len([w for w in windows if w < by_student[0]]) >= 5
    assert len(by_student) == 1
    assert not [line for line in lines[: by_student[0]] if "Exchange hash" in line]


def test_only_the_slot_pivot_sorts_to_aggregate(text):
    assert "ObjectHashAggregate" not in text
    # The code maps are checked for repeated keys: a few rows each.
    aggregates = [line for line in text.splitlines() if "SortAggregate" in line]
    assert all("_slot" in line or re.search(r"key=\[(map_code|degree_code)#", line) for line in aggregates), aggregates


def test_slots_are_limited_before_the_shuffle(text):
    assert text.count("WindowGroupLimit") == 2


def test_the_whole_conversion_is_planned_lazily_and_scans_once(spark, stored):
    """Before the result is used only the small tables are counted; next terms share the rows' shuffle."""
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    result = student_term_history(stored, STAR_CONFIG)
    assert len(tracker.getJobIdsForGroup()) - before < 10
    result.collect()
    text = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    by_table = {t: len(re.findall(rf"FileScan parquet [^\n]*/{t}\.parquet", text)) for t in ("courses", "candidacy", "degrees")}
    assert by_table == {"courses": 1, "candidacy": 1, "degrees": 2}


def test_nothing_runs_twice(spark, stored):
    """Next terms and the sort, which reads its input twice, read the finished rows' shuffle and no window."""
    result = student_term_history(stored, STAR_CONFIG)
    result.collect()
    text = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lines = [re.sub(r"^[ :+\-]*\*?(\(\d+\) )?", "", line) for line in text.splitlines()]
    windows = [i for i, line in enumerate(lines) if line.startswith("Window [")]
    assert len([i for i in windows if "bit_or(flags" in lines[i]]) == 1
    sort = next(i for i, line in enumerate(lines) if line.startswith("Exchange rangepartitioning"))
    shuffle = next(i for i, line in enumerate(lines) if i > sort and line.startswith("Exchange hashpartitioning"))
    assert not [i for i in windows if sort < i < shuffle]
    assert [line for line in lines if line.startswith("ReusedExchange") and "pidm" in line]


def test_result_is_sorted(spark, stored):
    rows = student_term_history(stored, STAR_CONFIG).select("pidm", "term_code_eff", "sort").collect()
    key = [tuple((v is not None, v or 0) for v in r) for r in rows]
    assert key == sorted(key)
