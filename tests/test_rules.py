"""Handwritten cases for the odd behaviours of the rules and operators."""

import datetime

import made_up
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from termloom import Config, student_term_history
from termloom.functions import status
from termloom.functions.terms import shift_month, term_code
from termloom.operators import calendar as cal
from termloom.operators import collapse, curriculum, events, history, lookup, output
from termloom.plans import student_history as plan
from termloom.sources import normalize_codes

D = datetime.date
CFG = Config(active_year="2021", cutoff_term=202301, current_terms=(202301, 202306))
TERMS = [
    ("2122", "FA", D(2021, 8, 20), D(2021, 12, 15)),
    ("2122", "SP", D(2022, 1, 10), D(2022, 5, 5)),
    ("2122", "SU", D(2022, 6, 1), D(2022, 7, 31)),
    ("2223", "FA", D(2022, 8, 20), D(2022, 12, 15)),
    ("2223", "SP", D(2023, 1, 10), D(2023, 5, 5)),
    ("2223", "SU", D(2023, 6, 1), D(2023, 7, 31)),
]
LAST_BEGIN = D(2023, 6, 1)


def course(student, year, term, hours=3, grade="A", state="H", credit=3, kind="CR"):
    return (student, year, term, grade, state, credit, hours, kind)


def degree(student, entry, degr="BA", major="M1", exit_=None, conferred=None, withdrawn=None, **extra):
    return (
        student,
        entry,
        exit_,
        conferred,
        withdrawn,
        extra.get("reason", ""),
        major,
        extra.get("major_2"),
        extra.get("conc", ""),
        degr,
        extra.get("div", "X"),
    )


MAJORS = [("M1", "BA"), ("M2", "BS"), ("M3", "V"), ("M4", "BA")]
FULL_MAP = [
    ("BAM1", "U", "BA", "BM1", None, "PM1"),
    ("BAM4", "U", "BA", "BM4", "K4", "PM4"),
    ("BSM2", "U", "BS", "BM2", "K2", "PM2"),
]
PLAIN_MAP = [("BA", "U", "BAX", "P-BA"), ("BS", "W", "BSX", "P-BS")]


def two_terms(student):
    return [course(student, "2122", "FA"), course(student, "2122", "SP")]


def active(student):
    """Makes a student active without an event: the grade is not valid, the term not in the calendar."""
    return course(student, "2021", "SP", grade="T")


def converted(spark, cfg=CFG, **rows):
    sources, _ = made_up.tables(spark, {"year_terms": TERMS, "majors": MAJORS, **rows})
    return student_term_history(sources, cfg).collect()


@pytest.fixture(scope="module")
def mixed(spark):
    """One conversion of many students, each a case of its own; the target id is the student id."""
    rows = {
        "courses": [
            *two_terms(1),
            *[course(2, "2122", "FA"), course(2, "2223", "SU")],
            course(3, "1999", "FA"),
            *[course(4, "2122", "FA"), course(4, "2122", "SU")],
            *[course(4, "2122", "SP", grade=g) for g in ("T", "TU", None)],
            *[course(4, "2122", "SP", state=s) for s in ("D", None)],
            *[course(4, "2122", "SP", credit=0), course(4, "TRAN", "TR")],
            *[course(5, "2122", "FA", 6), course(5, "2122", "FA", 6, state="D"), course(5, "2122", "SP", 6)],
            *[course(6, "2122", "FA", 6), course(6, "2122", "SP", 6)],
            *[c for student in (7, 8, 9, 17, 18) for c in two_terms(student)],
            *[active(17), active(18)],
            *[course(10, "2122", "FA", None), course(10, "2122", "SP", None), course(10, "2122", "SU", 3)],
            course(11, "2122", "FA"),
            course(12, "2122", "FA", hours=0),
            *two_terms(13),
        ],
        "degrees": [
            degree(1, D(2021, 9, 1), conferred=D(2023, 7, 1)),
            degree(7, D(2021, 9, 1), major_2="M2"),
            degree(17, D(2021, 9, 1), major_2="M2"),
            degree(8, D(2021, 9, 1), major_2="M4"),
            degree(18, D(2021, 9, 1), major_2="M4"),
            degree(9, D(2021, 9, 1), degr="V", major="M3"),
        ],
        "candidacy": [
            (10, "2122", "FA", "P", "1"),
            (10, "2122", "FA", "F", "1"),
            (10, "ZZZZ", "ZZ", "F", "1"),
            (10, "ZZZZ", "FA", "F", "1"),
        ],
        "code_map": FULL_MAP,
        "degree_map": PLAIN_MAP,
        "cohort": [(i,) for i in range(1, 20) if i != 11] + [(1,)],
        "external_ids": [(str(i), i) for i in range(1, 20) if i != 13] + [("x", 8)],
    }
    return converted(spark, **rows)


def of(rows, student):
    return [r for r in rows if r.pidm == student]


def column(rows, name):
    return [r[name] for r in rows]


# ---- calendar -----------------------------------------------------------------------------------


def test_extended_ends_close_gaps_and_last_stays_open(spark):
    sources, _ = made_up.tables(spark, {"year_terms": [*TERMS, ("ZZZZ", "ZZ", D(1900, 1, 1), D(1900, 1, 1))]})
    ends = cal.term_calendar(sources.year_terms, CFG).orderBy("trm_begin_dte").select("extend_trm_end_dte").collect()
    assert [r[0] for r in ends] == [
        D(2022, 1, 9),
        D(2022, 5, 31),
        D(2022, 8, 19),
        D(2023, 1, 9),
        D(2023, 5, 31),
        None,
    ]


def test_dates_outside_the_calendar_find_no_term(spark):
    sources, _ = made_up.tables(spark, {"year_terms": TERMS})
    days = cal.term_months(cal.term_calendar(sources.year_terms, CFG))
    dates = [D(2021, 8, 19), D(2021, 8, 20), D(2022, 1, 9), D(2022, 1, 10), D(2023, 5, 31), LAST_BEGIN, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, d date")
    found = cal.interval_lookup(df, days, "d").orderBy("i").collect()
    assert column(found, "term_code") == [None, 202108, 202108, 202201, 202301, None, None]


def test_last_term_end_can_be_given(spark):
    sources, _ = made_up.tables(spark, {"year_terms": TERMS})
    days = cal.term_months(cal.term_calendar(sources.year_terms, Config(last_term_end=D(2023, 8, 1))))
    df = spark.createDataFrame([(D(2023, 8, 1),), (D(2023, 8, 2),)], "d date")
    assert column(cal.interval_lookup(df, days, "d").orderBy("d").collect(), "term_code") == [202306, None]


def test_time_of_day_is_ignored(spark):
    sources, _ = made_up.tables(spark, {"year_terms": TERMS})
    days = cal.term_months(cal.term_calendar(sources.year_terms, CFG))
    df = spark.createDataFrame([(datetime.datetime(2022, 1, 9, 23, 59),)], "d timestamp_ntz")
    assert cal.interval_lookup(df, days, "d").first().term_code == 202108


def test_of_two_terms_with_one_begin_the_earlier_never_matches(spark):
    tied = [("2122", "A1", D(2022, 1, 10), D(2022, 3, 1)), ("2122", "A2", D(2022, 1, 10), D(2022, 5, 1))]
    sources, _ = made_up.tables(spark, {"year_terms": [*tied, TERMS[2]]})
    calendar = cal.term_calendar(sources.year_terms, CFG)
    ends = {r.trm_cde: r.extend_trm_end_dte for r in calendar.collect()}
    assert ends["A1"] == D(2022, 1, 9) and ends["A2"] == D(2022, 5, 31)
    df = spark.createDataFrame([(D(2022, 1, 10),), (D(2022, 5, 31),)], "d date")
    assert cal.interval_lookup(df, cal.term_months(calendar), "d").count() == 2


def test_term_code_and_shift(spark):
    df = spark.createDataFrame([(D(2022, 6, 1),), (D(2022, 8, 20),), (None,)], "d date")
    got = df.select(term_code("d").alias("a"), shift_month(term_code("d"), {6: 5}).alias("b")).collect()
    assert [tuple(r) for r in got] == [(202206, 202205), (202208, 202208), (None, None)]


# ---- loading ------------------------------------------------------------------------------------


def test_codes_lose_trailing_blanks_only(spark):
    df = spark.createDataFrame([(" a  ", 1), ("  ", 2), (None, 3)], "x string, n int")
    assert column(normalize_codes(df).orderBy("n").collect(), "x") == [" a", "", None]
    assert normalize_codes(df, upper=True).orderBy("n").first().x == " A"


def test_sources_read_with_other_names(spark):
    from termloom import Sources
    from termloom.sources import SCHEMAS

    def table(name):
        ddl = ", ".join(f"{'M_' + c if name == 'STORED_MAP' else c} {k.replace('number', 'double')}" for c, k in SCHEMAS[stored.get(name, name)].items())
        return spark.createDataFrame([], ddl)

    stored = {"STORED_MAP": "code_map"}
    names = {c: f"M_{c}" for c in SCHEMAS["code_map"]}
    sources = Sources.read(table, names={"code_map": "STORED_MAP"}, columns={"code_map": names})
    assert sources.code_map.columns == list(SCHEMAS["code_map"])


# ---- events and collapse ------------------------------------------------------------------------


def test_undated_and_repeated_milestones(spark):
    rows = [degree(1, D(2022, 1, 15), exit_=D(2022, 6, 3), reason="X")] * 2
    sources, _ = made_up.tables(spark, {"degrees": rows})
    got = events.milestone_events(sources.degrees).distinct().collect()
    assert sorted((r.sig_desc, r.sig_date, r.reason_code) for r in got if r.sig_date) == [
        ("entry date", D(2022, 1, 15), ""),
        ("exit date", D(2022, 6, 3), "X"),
    ]
    assert len(got) == 4


def test_joined_text_is_sorted_keeps_repeats_and_blanks_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", None), (1, "b", 3), (1, "", 2), (1, None, 9), (2, None, None)], "k int, v string, n int"
    )
    got = collapse.collapse(df, ["k"], {"v": "text"}, {"n": "top"}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, ";a;b;b", 9), (2, None, None)]


def test_event_after_the_last_begin_makes_a_row_without_term(mixed):
    rows = of(mixed, 1)
    assert column(rows, "term_code_eff") == [None, 202108, 202201]
    assert column(rows, "stst_code") == ["GR", "AS", "IS"]


def test_enrolment_in_the_last_term_adds_a_row_without_term(mixed):
    rows = of(mixed, 2)
    assert column(rows, "term_code_eff") == [None, 202108]
    assert column(rows, "stst_code") == [None, "IS"]


def test_enrolment_only_in_unknown_terms(mixed):
    got = [(r.term_code_eff, r.sort, r.stst_code) for r in of(mixed, 3)]
    assert got == [(None, 1, "AS"), (None, 2, "AS")]


def test_invalid_courses_do_not_count(mixed):
    rows = of(mixed, 4)
    assert column(rows, "term_code_eff") == [202108, 202205]
    assert column(rows, "styp_code")[0] == "2"


def test_hours_count_dropped_courses(mixed):
    assert column(of(mixed, 5), "full_part_ind") == ["F", "F"]
    assert column(of(mixed, 6), "full_part_ind") == ["P", "P"]


def test_students_outside_cohort_or_without_attempts(mixed):
    assert not of(mixed, 11) and not of(mixed, 12)


def test_candidacy_rows_multiply_and_only_double_dummies_drop(mixed):
    assert column(of(mixed, 10), "term_code_eff") == [202108, 202108, 202205]


# ---- rules --------------------------------------------------------------------------------------


def check(spark, ddl, cases, code):
    """Each case is the input columns and the expected code; all run as one frame."""
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"i int, {ddl}, expected string")
    wrong = df.select("*", code.alias("got")).where(~F.col("got").eqNullSafe(F.col("expected"))).collect()
    assert not wrong, wrong


def has_events(*names):
    return {e: F.array_contains("events", e) for e in names}


def test_load(spark):
    cases = [
        (12, None, None, 1, None, "F"),
        (11, None, None, 1, "F", "P"),
        (0, 12, 12, 1, "P", "P"),
        (0, 12, 12, 2, None, "F"),
        (None, 3, 12, 1, "P", "F"),
        (None, 12, 3, 1, "F", "P"),
        (None, 3, 12, 2, "F", "P"),
        (None, 12, 3, 2, "P", "F"),
        (None, None, None, 1, "P", "P"),
        (None, 0, None, 2, "P", "P"),
        (None, None, None, 3, None, "F"),
    ]
    names = ("hours", "before", "after", "row", "declared")
    load = status.load_indicator(CFG, *[F.col(n) for n in names])
    check(spark, "hours int, before int, after int, row int, declared string", cases, load)


def test_level(spark):
    cases = [
        (-1, None, None, None, (), False, False, "XX"),
        (0, 3, 3, 3, (status.LAST,), True, True, None),
        (1, None, None, None, (), False, False, "CE"),
        (2, None, None, None, (), False, False, "VO"),
        (3, None, None, None, (), False, False, "UG"),
        (None, 3, 3, 2, (status.START, status.LAST), True, True, "VO"),
        (None, 3, 3, None, (status.START, status.LAST), True, True, "00"),
        (None, None, None, 1, (status.LAST,), False, False, "CE"),
        (None, None, None, None, (status.LAST,), False, False, "00"),
        (None, 2, None, 1, (status.LAST,), False, False, "VO"),
        (None, 0, None, 1, (status.LAST,), False, False, "0"),
        (None, -1, None, 1, (status.LAST,), False, False, "*"),
        (None, 3, 1, 2, (status.START,), True, True, "UG"),
        (None, 0, 1, 2, (status.START,), True, True, "00"),
        (None, 3, 1, 2, (status.START,), False, True, "CE"),
        (None, 3, None, 2, (status.START,), False, True, "00"),
        (None, 3, 1, 2, (status.START,), None, None, "VO"),
        (None, 3, 1, None, (status.START,), False, False, "00"),
        (None, 3, 3, 3, (status.EXIT,), True, True, None),
    ]
    has = has_events(status.START, status.LAST)
    names = ("level", "before", "after", "rank")
    code = status.level_code(CFG, *[F.col(n) for n in names], has, F.col("entry_before"), F.col("entry_after"))
    ddl = "level int, before int, after int, rank int, events array<string>, entry_before boolean, entry_after boolean"
    check(spark, ddl, cases, code)


def test_status(spark):
    cases = [
        (202201, 1, 1, (status.CONFERRED,), "AS"),
        (202201, 2, 2, (status.CONFERRED,), "IS"),
        (202301, 2, 2, (status.CONFERRED,), "GR"),
        (202201, 1, 2, (status.LAST,), "IS"),
        (202201, 1, 2, (status.WITHDRAWN, status.ENTRY), "IS"),
        (202306, 1, 2, (status.LAST,), "AS"),
        (202308, 1, 2, (status.LAST,), None),
        (202308, 1, 2, (status.WITHDRAWN, status.CONFERRED), "GR"),
        (202201, 1, 2, (status.START,), "AS"),
        (202201, 1, 2, (status.ENTRY,), "AS"),
        (202201, 1, 2, (status.EXIT, status.CONFERRED), "AS"),
        (202201, 1, 2, (status.CONFERRED,), "GR"),
        (None, 2, 2, (status.LAST,), None),
        (None, 1, 2, (status.WITHDRAWN, status.EXIT), "AS"),
    ]
    has = has_events(status.START, status.LAST, status.ENTRY, status.EXIT, status.CONFERRED, status.WITHDRAWN)
    code = status.status_code(CFG, F.col("term"), F.col("row"), F.col("count"), has)
    check(spark, "term int, row int, count int, events array<string>", cases, code)


def test_type(spark):
    cases = [
        (False, "3", "9", "C"),
        (True, "3", "9", "3"),
        (True, "3", "2", "A"),
        (False, "9", "3", "A"),
        (False, "9", None, "9"),
        (True, "2", None, "2"),
    ]
    code = status.student_type(F.col("starts"), F.col("own"), F.col("before"))
    check(spark, "starts boolean, own string, before string", cases, code)


def test_degree_levels_in_rule_order(spark):
    rows = [("U", "V"), ("A", "BA"), ("X", "V"), ("X", "C"), ("X", "NDA"), ("A", "ADE"), ("X", "ADE"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, div_cde string, degr_cde string")
    got = df.select("i", status.degree_level(CFG).alias("l")).orderBy("i").collect()
    assert column(got, "l") == [3, 3, 2, 1, 0, -1, None, None]


TEXTS = [
    ["A"],
    ["A", "C"],
    ["C", "A", "ADE"],
    ["", "A"],
    ["", "A", "C"],
    ["A", "A", "A"],
    ["A", "A"],
    ["", "A", "A"],
    ["V", "C"],
    ["XS"],
    ["BA"],
    ["NDA", "V"],
    [None],
    [None, "V"],
]


def test_flags_agree_with_the_joined_text(spark):
    """The flag form of the substring tests equals the tests on the joined text."""
    items = [
        (i, code, level, code == "")
        for i, codes in enumerate(TEXTS)
        for level, code in enumerate(codes)
    ]
    df = spark.createDataFrame(items, "i int, degr_cde string, n int, enrolment boolean")
    # Every item has a level of its own, as the distinct (code, level) pairs of a term have.
    bit = F.call_function("shiftleft", F.lit(1), F.col("n"))
    mark = F.lit(False)
    for text in CFG.degree_marks:
        mark = mark | F.col("degr_cde").contains(text)
    real = ~F.col("enrolment")
    flags = df.groupBy("i").agg(
        F.bit_or(F.when(F.col("degr_cde") == "A", bit)).alias("middle_bits"),
        *[
            F.coalesce(F.max(c), F.lit(False)).alias(n)
            for n, c in {
                "has_degree": real & F.col("degr_cde").isNotNull(),
                "has_mark": mark,
                "has_before": real & (F.col("degr_cde") < "A"),
                "has_after": F.col("degr_cde") > "A",
                plan.name_of(status.START): F.col("enrolment"),
                plan.name_of(status.LAST): F.lit(False),
            }.items()
        ],
    )
    text = collapse.collapse(df, ["i"], {"degr_cde": "text"})
    both = flags.join(text, "i").select(
        "i", plan.degree_seeking(CFG).alias("a"), status.seeks_degree(CFG, F.col("text")).alias("b")
    )
    got = {r.i: (r.a, r.b) for r in both.collect()}
    assert len(got) == len(TEXTS)
    assert all(a == b for a, b in got.values()), got
    assert {b for _, b in got.values()} == {True, False, None}


# ---- history and curriculum ---------------------------------------------------------------------


def test_groups_and_first_values(spark):
    rows = [(1, 1, False, None), (1, 2, True, None), (1, 3, False, "x"), (1, 4, True, "y"), (1, 5, False, None)]
    df = spark.createDataFrame(rows, "k int, t int, m boolean, v string")
    groups = history.marker_groups(df, "k", "t", F.col("m"), "g")
    assert column(groups.orderBy("t").collect(), "g") == [0, 1, 1, 2, 2]
    first = history.first_in_group(groups, ("k", "g"), "t", {"v": "f"})
    assert column(first.orderBy("t").collect(), "f") == [None, None, None, "y", "y"]


@pytest.mark.parametrize("depth, reached", [(6, 7), (2, 3), (None, 10)])
def test_fill_depth_counts_rows(spark, depth, reached):
    df = spark.createDataFrame([(1, t, "x" if t == 1 else None) for t in range(1, 11)], "k int, t int, v string")
    got = history.fill_forward(df, "k", "t", ["v"], depth).orderBy("t").collect()
    assert column(got, "v") == ["x"] * reached + [None] * (10 - reached)


def test_slots_take_the_first_entries_in_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, None), (3, "z")], "k int, v string")
    got = curriculum.slot_pivot(df, ["k"], ["v"], ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "b"), (2, None, None), (3, "z", None)]


def test_second_slot_with_another_degree(mixed):
    names = (
        "degc_code_1 majr_code_1 program_1 degc_code_2 majr_code_2 majr_code_conc_2 program_2 majr_code_1_2".split()
    )
    plain, mapped = ([of(mixed, student)[0][n] for n in names] for student in (7, 17))
    assert plain == ["BAX", "M1", "P-BA", "BSX", "M2", None, "P-BS", None]
    assert mapped == ["BA", "BM1", "PM1", "BS", "BM2", "K2", "PM2", None]


def test_second_slot_with_the_same_degree(mixed):
    names = "coll_code_2 degc_code_2 majr_code_2 majr_code_1_2 program_2".split()
    plain, mapped = ([of(mixed, student)[0][n] for n in names] for student in (8, 18))
    # Without an active course the second program is set even so.
    assert plain == [None, None, None, "M4", "P-BA"]
    assert mapped == [None, None, None, "BM4", None]


def test_first_row_defaults_and_certificates(mixed):
    rows = of(mixed, 9)
    first = rows[0]
    assert (first.coll_code_1, first.degc_code_1, first.majr_code_1, first.program_1) == ("U", "NOND", "ATLG", "NOND")
    assert column(rows, "coll_code_1") == ["U", "U"]


def test_repeated_map_keys_fail(spark):
    with pytest.raises(Exception, match="map_code occurs more than once in a lookup table, for example BAM1"):
        converted(spark, courses=two_terms(1), cohort=[(1,)], code_map=[*FULL_MAP, FULL_MAP[0]])


def test_a_map_without_a_key_may_repeat(spark):
    keyless = (None, "U", "X", "X", None, "X")
    assert converted(spark, courses=two_terms(1), cohort=[(1,)], code_map=[*FULL_MAP, keyless, keyless])


# ---- output -------------------------------------------------------------------------------------


def test_one_row_students_get_a_follow_up_in_the_next_seen_term(spark):
    rows = converted(
        spark,
        courses=[course(1, "2122", "FA"), course(2, "2122", "SU"), course(3, "2122", "SP"), course(4, "2223", "SP")],
        cohort=[(i,) for i in range(1, 5)],
        external_ids=[(str(i), i) for i in range(1, 5)],
    )
    got = [(r.pidm, r.term_code_eff, r.sort, r.stst_code) for r in rows]
    assert got == [
        (1, 202108, 1, "AS"),
        (1, 202201, 2, "IS"),
        (2, 202205, 1, "AS"),
        (2, 202301, 2, "IS"),
        (3, 202201, 1, "AS"),
        (3, 202205, 2, "IS"),
        (4, 202301, 1, "AS"),
        (4, 202301, 2, "AS"),
    ]


def test_layout(spark, mixed):
    r = of(mixed, 6)[0].asDict()
    assert len(r) == 115 and list(r)[0] == "pidm" and list(r)[-1] == "sort"
    assert (r["camp_code"], r["resd_code"], r["admt_code"]) == ("SAC", "C", "ST")
    assert sum(v == "" for v in r.values()) == 91
    named = output.project_layout(spark.range(1), ("a", "b", "sort"), {"b": F.lit("x"), "sort": F.lit(1)}, "p_")
    assert named.collect() == [Row(p_a="", p_b="x", sort=1)]


def test_rows_without_external_id_sort_first(mixed):
    ids = column(mixed, "pidm")
    assert ids[:2] == [None, None] and None not in ids[2:]


def test_next_in_domain(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (3,)], "t int")
    got = {r.t: r.n for r in output.next_in_domain(df, "t", "n").collect()}
    assert got == {None: 1, 1: 3, 3: None}


def test_lookup_above_the_bound_is_not_broadcast(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    plan_of = lambda side: spark.range(5).withColumnRenamed("id", "k").join(side, "k")._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan_of(lookup.lookup_side(df))
    assert "strategy=broadcast" not in plan_of(lookup.lookup_side(df, max_bytes=9))


# ---- exact hours, binding size check, written-out rows --------------------------------------------


def test_hours_keep_their_type_and_are_not_rounded(spark):
    import decimal

    from termloom.sources import HOURS, conform, number_type

    ddl = "id_num bigint, yr_cde string, trm_cde string, grade_cde string, transaction_sts string, credit_hrs double, hrs_attempted decimal(9,3), credit_type_cde string"
    rows = [(1, "2021", "FA", "A", "H", 0.004, decimal.Decimal("3.999"), "CR")] * 3
    loaded = conform(spark.createDataFrame(rows, ddl), "courses")
    assert loaded.agg(F.sum("hrs_attempted")).first()[0] == decimal.Decimal("11.997")
    assert loaded.where("credit_hrs > 0").count() == 3
    kinds = spark.createDataFrame([], "a int, b float, c string, d decimal(5,1), e double").schema
    assert [number_type(f.dataType) for f in kinds] == ["bigint", "double", "decimal(38,10)", "decimal(5,1)", "double"]
    assert HOURS == "number"


def test_hours_just_below_full_time_are_part_time(spark):
    term = [("2021", "FA", D(2020, 8, 20), D(2020, 12, 15)), ("ZZZZ", "ZZ", D(1900, 1, 1), D(1900, 1, 1))]
    course = (1, "2021", "FA", "A", "H", 3, "3.999", "CR")
    rows = {"year_terms": term, "courses": [course] * 3, "cohort": [(1,)], "degrees": [(1, D(2020, 9, 1), None, None, None, "", "M1", None, "", "BA", "U")]}
    sources, _ = made_up.tables(spark, {**rows, "courses": [course] * 3})
    cfg = Config(last_term_end=D(2021, 1, 1))
    facts = plan.derived_codes(plan.term_facts(sources, cfg), cfg)
    assert {r.ft_pt_ind for r in facts.collect()} == {"P"}


def test_a_lookup_over_the_bound_is_never_broadcast(spark):
    """Spark's estimate does not see an explode; the hint holds at the default threshold."""
    calendar = spark.createDataFrame([("0001", "FA", D(1900, 1, 1), D(9999, 12, 31))], "yr_cde string, trm_cde string, trm_begin_dte date, extend_trm_end_dte date")
    dates = spark.createDataFrame([(D(2020, 1, 1),)], "d date")
    small = cal.interval_lookup(dates, cal.term_months(calendar), "d")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString() and small.first().term_code == 190001
    exploded = calendar.select(F.explode(F.sequence(F.lit(0), F.lit(5_000_000))).alias("k"))
    joined = spark.range(5).withColumnRenamed("id", "k").join(lookup.lookup_side(exploded), "k")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text and "SinglePartition" not in text


def test_pieces_are_written_out(spark):
    rows = spark.createDataFrame([(1, 5, 3, 3, True), (1, 6, 1, 3, False)], "id_num long, row_num long, weight long, hist_group long, starts boolean")
    out = plan.written_out(rows).orderBy("row_num").collect()
    assert [(r.row_num, r.hist_group, r.weight) for r in out] == [(3, 1, 1), (4, 2, 1), (5, 3, 1), (6, 3, 1)]


def test_lookup_equals(spark):
    rows = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, None)], "k int, v int")
    side = spark.createDataFrame([(1, 10), (3, 5)], "k int, w int")
    assert sorted((r.k, r.v or 0, r.f) for r in lookup.lookup_equals(rows, side, "k", "w", "v", "f").collect()) == [(1, 10, "Y"), (1, 11, "N"), (2, 10, "N"), (3, 0, "N")]


def test_a_lookup_of_one_value_fails_on_a_second_row(spark):
    rows = spark.createDataFrame([(1, 10), (2, 10)], "k int, v int")
    side = spark.createDataFrame([(1, 10), (1, 10), (None, 3), (None, 4)], "k int, w int")
    found = lookup.lookup_equals(rows, side, "k", "w", "v", "f")  # fails when it runs, not before
    with pytest.raises(Exception, match="k occurs more than once in a lookup table, for example 1"):
        found.collect()
    assert lookup.lookup_equals(rows, side.where("k is null or w is null"), "k", "w", "v", "f").count() == 2


def test_row_counts(spark):
    assert lookup.row_counts({"a": spark.range(7), "b": spark.range(0), "c": spark.range(3)}) == {"a": 7, "b": 0, "c": 3}


@pytest.mark.parametrize("hot", [None, [""], []])
def test_hot_and_empty_keys_are_spread(spark, hot):
    """Half of the rows have an empty key and some have none; both are spread, with the rows of a plain join."""
    rows = spark.range(8000).selectExpr("id", "case when id % 2 = 0 then '' when id % 10 = 1 then null else cast(id % 700 as string) end as code")
    side = spark.range(600).selectExpr("cast(id as string) as code", "id as n").union(spark.createDataFrame([("", -1), (None, -2)], "code string, n long"))
    got = lookup.spread_left_join(rows, side, "code", ["id"], hot)
    want = rows.join(side, "code", "left").select("id", "code", "n")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan_text and "Broadcast" not in plan_text
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(coalesce)
    if hot != []:
        assert max(sizes) < 2 * 8000 / 8


def test_a_value_repeated_very_often_is_counted_first(spark):
    rows = spark.range(1_000_000).selectExpr("1 as k", "case when id = 7 then 'b' else 'a' end as v")
    text = collapse.collapse(rows, ["k"], {"v": "t"}).first().t
    assert len(text) == 2 * 1_000_000 - 1 and text.endswith("a;b") and "b" not in text[:-1]
    with pytest.raises(Exception, match="occurs 999999 times"):
        collapse.collapse(rows, ["k"], {"v": "t"}, most=1000).collect()


def test_separator_with_a_quote(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    from termloom.operators.collapse import collapse

    assert collapse(rows, ["k"], {"v": "all"}, separator="'").first()["all"] == "a'b"


def test_levels_have_bits():
    with pytest.raises(ValueError, match="between -1 and 28"):
        Config(level_rules=(("degr_cde", ("A",), 29),))
