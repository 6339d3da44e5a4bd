"""One row per student and term, from course, degree and candidacy rows.

How the data moves:

1. Course rows, degree milestones and cohort marks become rows of the same shape, keyed by student and
   term, and meet in ONE aggregation with constant-size buffers. Rows are reduced before the shuffle,
   so a student or term with very many rows costs no more than any other.
2. Degree slots and declared loads arrive with the same partitioning and join without moving it.
3. One shuffle by student; a student now has at most one row per term, and every window of the plan
   (enrolment bounds, neighbours, groups, fill) runs on that partitioning and one sort order.
4. External ids join on that partitioning. Then the finished, narrow rows move once more, and everything that reads
   them twice reads that shuffle: next terms, follow-up rows and the final sort, which first looks for its bounds.
   So no window runs twice. Nothing is stored and nothing but the sizes of the small tables is read until the result
   is used.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import courses as course_rules
from termloom.functions import status
from termloom.functions.terms import shift_month, term_code
from termloom.operators.calendar import attach_term, code_table, interval_lookup, month_table, term_calendar
from termloom.operators.curriculum import (
    SLOT_KEYS,
    CodeMap,
    code_map,
    default_first_row,
    map_codes,
    split_by_codes,
    two_slots,
    unpivot_slots,
)
from termloom.operators.events import CURRICULUM, MILESTONES, unpivot_dates
from termloom.operators.history import RUNNING, WHOLE, fill_forward, in_order
from termloom.operators.lookup import fits, keep_keys, lookup_side, override_code, row_counts
from termloom.operators.output import emit_follow_up, next_in_domain, project_layout
from termloom.plans.layout import LAYOUT
from termloom.sources import Sources

MILESTONE_FLAGS = (status.ENTRY, status.EXIT, status.CONFERRED, status.WITHDRAWN)
STUDENT_FLAGS = ("is_enrolled", "is_transfer", "is_active", "has_attempted", "in_cohort")
DEGREE_FLAGS = ("has_major", "has_degree", "has_mark", "has_before", "has_after")
FILLED = (
    "coll_code_1",
    "degc_code_1",
    "majr_code_1",
    "majr_code_conc_1",
    "coll_code_2",
    "degc_code_2",
    "majr_code_2",
    "program_1",
    "program_2",
)
# What the output is made of; everything else is dropped before the result is stored.
KEPT = (
    "id_num",
    "term_code",
    "row_num",
    "row_count",
    "weight",
    "stst_code",
    "levl_code",
    "styp_code",
    "full_part_ind",
    "term_code_admit",
    *FILLED,
    "majr_code_conc_2",
    "majr_code_1_2",
)
# Order of a student's rows; the last three only tell repeated candidacy rows apart.
ROW_ORDER = ("term_code", "load_p_f", "candidacy_type", "piece")
# Copies a repeated row is cut into before they are written out.
COPIES_PER_CHUNK = 64


def name_of(event: str) -> str:
    return "has_" + event.replace(" ", "_")


# All yes/no facts of a row share one integer, so that one aggregate gathers them.
FLAGS = (*STUDENT_FLAGS, *map(name_of, MILESTONE_FLAGS), *DEGREE_FLAGS)


def flags_of(facts: dict[str, Column]) -> Column:
    """The integer with a bit for every fact that is true."""
    bits = F.lit(0)
    for name, fact in facts.items():
        bits = bits + F.when(fact, F.lit(1 << FLAGS.index(name))).otherwise(0)
    return bits.alias("flags")


def flag(name: str, flags: str | Column = "flags") -> Column:
    flags = F.col(flags) if isinstance(flags, str) else flags
    return flags.bitwiseAND(F.lit(1 << FLAGS.index(name))) != 0


def course_rows(courses: DataFrame, codes: DataFrame, cfg: Config) -> DataFrame:
    valid = course_rules.valid_enrolment(cfg)
    return attach_term(courses, codes).select(
        *SLOT_KEYS,
        F.col("hrs_attempted").alias("hours"),
        F.when(valid, F.col("trm_begin_dte")).alias("enrolled_on"),
        F.when(valid, course_rules.credit_rank(cfg)).alias("credit_rank"),
        flags_of(
            {
                "is_enrolled": valid,
                "is_transfer": course_rules.is_transfer(cfg),
                "is_active": course_rules.is_active(cfg),
                "has_attempted": course_rules.attempted_enrolment(cfg),
            }
        ),
    )


def dated_milestones(degrees: DataFrame, months: DataFrame) -> DataFrame:
    # Without the reasons, which no rule reads.
    milestones = unpivot_dates(degrees, MILESTONES, ("id_num", *CURRICULUM))
    return interval_lookup(milestones.where(F.col("sig_date").isNotNull()), months, "sig_date")


def milestone_rows(milestones: DataFrame, cfg: Config) -> DataFrame:
    degree = F.trim("degr_cde")
    level = status.degree_level(cfg)
    if cfg.whole_degree_marks:
        mark = degree.isin(*cfg.degree_marks, cfg.degree_middle_mark)
    else:
        mark = F.lit(False)
        for text in cfg.degree_marks:
            mark = mark | degree.contains(text)
    # A bit per level (and one for none): the middle mark is an item for each different level.
    bit = F.call_function("shiftleft", F.lit(1), F.coalesce(level + 2, F.lit(0)))
    return milestones.select(
        *SLOT_KEYS,
        level.alias("level"),
        F.when(degree == cfg.degree_middle_mark, bit).alias("middle_bits"),
        flags_of(
            {
                **{name_of(event): F.col("sig_desc") == event for event in MILESTONE_FLAGS},
                "has_major": F.col("major_1").isNotNull(),
                "has_degree": degree.isNotNull(),
                "has_mark": mark,
                "has_before": degree < cfg.degree_middle_mark,
                "has_after": degree > cfg.degree_middle_mark,
            }
        ),
    )


def degree_slots(milestones: DataFrame, degrees: DataFrame, cfg: Config) -> DataFrame:
    """First two non-certificate degrees of each student and term. Events without a term join nothing.

    ``degrees`` looks up the degree that a major leads to.
    """
    entries = unpivot_slots(
        milestones.where(F.col("term_code").isNotNull()).select(
            *SLOT_KEYS,
            F.col("degr_cde").alias("degree_history_degr_cde"),
            F.trim("concentration_1").alias("concentration_1"),
            "major_1",
            "major_2",
        ),
        (*SLOT_KEYS, "degree_history_degr_cde", "concentration_1"),
        (("major_1", "major_1"), ("major_2", "major_2")),
        ("major_cde", "raw"),
    ).drop("raw")
    known = entries.join(degrees.withColumnRenamed("degr_cde", "mmd_degr_cde"), "major_cde", "left").select(
        *SLOT_KEYS, F.trim("major_cde").alias("major_1"), "mmd_degr_cde", "degree_history_degr_cde", "concentration_1"
    )
    return two_slots(split_by_codes(known, "mmd_degr_cde", cfg.certificate_degrees)[0])


def declared_loads(candidacy: DataFrame, codes: DataFrame, cfg: Config) -> DataFrame:
    """Different candidacy entries of each student and term, with the number of rows that say the same."""
    real = (F.col("yr_cde") != cfg.dummy_year) | (F.col("trm_cde") != cfg.dummy_term)
    return (
        attach_term(candidacy.where(real), codes)
        .where(F.col("term_code").isNotNull())
        .groupBy(*SLOT_KEYS, "load_p_f", "candidacy_type")
        .agg(F.count("*").alias("copies"))
    )


def collapsed_terms(rows: DataFrame) -> DataFrame:
    """One row per student and term, with every fact as a sum, bound or flag."""
    return rows.groupBy(*SLOT_KEYS).agg(
        F.sum("hours").alias("hours"),
        F.min("enrolled_on").alias("first_on"),
        F.max("enrolled_on").alias("last_on"),
        F.max("credit_rank").alias("credit_rank"),
        F.max("level").alias("level"),
        F.bit_or("middle_bits").alias("middle_bits"),
        F.bit_or("flags").alias("flags"),
    )


def with_enrolment_events(terms: DataFrame, months: DataFrame) -> DataFrame:
    """Mark the terms of the first and last enrolment; keep the terms in which something happened.

    An enrolment date no term covers belongs to the student's row without a term, which is added
    where there is none yet. Facts that are looked up by term are NULL on that row.
    """
    by_term = in_order("id_num", "term_code")
    student = by_term.rowsBetween(*WHOLE)
    bounds = terms.select(
        *[F.col(c) for c in terms.columns if c not in ("first_on", "last_on")],
        F.bit_or("flags").over(student).alias("student_flags"),
        F.min("first_on").over(student).alias("first_on"),
        F.max("last_on").over(student).alias("last_on"),
        F.row_number().over(by_term).alias("_row"),
    ).where(flag("has_attempted", "student_flags") & flag("in_cohort", "student_flags"))
    bounds = interval_lookup(bounds, months, "first_on", "first_term")
    bounds = interval_lookup(bounds, months, "last_on", "last_term")

    enrolled = flag("is_enrolled", "student_flags")
    no_term = F.col("first_term").isNull() | F.col("last_term").isNull()
    missing = enrolled & no_term & (F.col("_row") == 1) & F.col("term_code").isNotNull()
    bounds = emit_follow_up(bounds, missing, "_part")
    own = F.col("_part") == 1
    term = F.when(own, F.col("term_code"))
    has = {
        **{e: own & flag(name_of(e)) for e in MILESTONE_FLAGS},
        status.START: enrolled & term.eqNullSafe(F.col("first_term")),
        status.LAST: enrolled & term.eqNullSafe(F.col("last_term")),
    }
    used = ("term_code", "flags", "student_flags", "first_on", "last_on", "first_term", "last_term", "_row", "_part")
    by_term_only = [c for c in bounds.columns if c not in (*used, "id_num")]
    facts = bounds.select(
        "id_num",
        term.alias("term_code"),
        flag("is_transfer", "student_flags").alias("is_transfer"),
        flag("is_active", "student_flags").alias("is_active"),
        *[F.when(term.isNotNull(), F.col(c)).alias(c) for c in by_term_only],
        *[F.when(term.isNotNull(), flag(c)).alias(c) for c in DEGREE_FLAGS],
        *[fact.alias(name_of(event)) for event, fact in has.items()],
    )
    happened = F.lit(False)
    for event in has:
        happened = happened | F.col(name_of(event))
    return facts.where(happened)


def degree_seeking(cfg: Config) -> Column:
    """The tests of :func:`status.seeks_degree` from flags instead of the joined text.

    An enrolment event adds one empty item, which sorts before every code.
    """
    enrolment = F.col(name_of(status.START)) | F.col(name_of(status.LAST))
    before = F.col("has_before") | enrolment
    after = F.col("has_after")
    items = F.coalesce(F.bit_count("middle_bits"), F.lit(0))
    middle = (
        (items >= 3) | ((items == 2) & (before | after)) | ((items == 1) & before & after)
    )
    return F.when(F.col("has_degree") | enrolment, F.col("has_mark") | middle)


def repeated_rows(facts: DataFrame, cfg: Config) -> DataFrame:
    """Repeat a term for each of its candidacy rows, in pieces that stand for ``weight`` equal rows.

    Only the first rows and the last one of a long run can differ from the rest: those are pieces of
    their own and the rows in between are one piece. So a student's pieces stay bounded by terms and
    codes even if a term has very many candidacy rows. ``row_count`` counts terms, not rows.
    """
    by_term = in_order("id_num", "term_code")
    student = by_term.rowsBetween(*WHOLE)
    ranked = facts.withColumn("_rank", F.dense_rank().over(by_term))
    counted = ranked.select("*", F.max("_rank").over(student).cast("long").alias("row_count")).drop("_rank")
    copies = F.coalesce("copies", F.lit(1))
    single = F.greatest(F.col("row_count"), F.lit(cfg.fill_depth + 1)).cast("long")
    weights = F.transform(
        F.sequence(F.lit(1).cast("long"), F.least(copies, single + 2)),
        lambda i: F.when((copies > single + 2) & (i == single + 1), copies - single - 1).otherwise(F.lit(1)),
    )
    return counted.select("*", F.posexplode(weights).alias("piece", "weight")).drop("copies")


def written_out(rows: DataFrame) -> DataFrame:
    """Every piece as the equal rows that it stands for; numbers that count rows go on from copy to copy."""
    copies = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("weight"))).alias("_copy"))
    back = F.col("weight") - F.col("_copy")
    if "row_num" in rows.columns:
        copies = copies.withColumn("row_num", F.col("row_num") - back)
    if "hist_group" in rows.columns:
        copies = copies.withColumn("hist_group", F.when(F.col("starts"), F.col("hist_group") - back).otherwise(F.col("hist_group")))
    return copies.withColumn("weight", F.lit(1).cast("long")).drop("_copy")


def cohort_rows(cohort: DataFrame) -> DataFrame:
    """A mark per student to convert, which travels with the student's other rows instead of a join."""
    return cohort.select(
        "id_num", F.lit(None).cast("int").alias("term_code"), flags_of({"in_cohort": F.lit(True)})
    )


@dataclasses.dataclass(frozen=True)
class Lookups:
    """The small tables of a conversion, marked by their counted sizes."""

    codes: DataFrame
    months: DataFrame
    degrees: DataFrame
    maps: tuple[CodeMap, CodeMap]
    terms: int
    small_cohort: bool


def lookups(sources: Sources, cfg: Config) -> Lookups:
    """Count all small tables at once, before anything is planned on them; a table's distinct rows count as all its rows."""
    calendar = term_calendar(sources.year_terms, cfg)
    overridden = override_code(
        sources.majors.select("major_cde", "degr_cde"), "major_cde", "degr_cde", dict(cfg.major_degree_overrides)
    )
    # An override can make rows equal that were not; each would take a slot.
    tables = {"codes": code_table(calendar), "months": month_table(calendar), "degrees": overridden.distinct()}
    counted = {"codes": sources.year_terms, "months": tables["months"], "degrees": sources.majors, "cohort": sources.cohort}
    rows = row_counts(counted | {"code_map": sources.code_map, "degree_map": sources.degree_map})
    sides = {name: lookup_side(df, rows=rows[name]) for name, df in tables.items()}
    return Lookups(
        **sides,
        maps=(
            code_map(sources.code_map, "map_code", rows["code_map"]),
            code_map(sources.degree_map, "degree_code", rows["degree_map"]),
        ),
        terms=rows["codes"],
        small_cohort=fits(sources.cohort, rows["cohort"]),
    )


def within_small_cohort(sources: Sources, small: bool) -> Sources:
    """Drop the rows of other students while scanning, if the cohort is small enough to send everywhere."""
    if not small:
        return sources
    cohort = F.broadcast(sources.cohort)
    tables = ("courses", "candidacy", "degrees")
    return dataclasses.replace(sources, **{t: keep_keys(getattr(sources, t), cohort, "id_num") for t in tables})


def student_terms(sources: Sources, sides: Lookups, cfg: Config) -> DataFrame:
    """Steps 1-3: the facts of every (student, term) in which an event falls, one row each."""
    sources = within_small_cohort(sources, sides.small_cohort)
    milestones = dated_milestones(sources.degrees, sides.months)
    rows = (
        course_rows(sources.courses, sides.codes, cfg)
        .unionByName(milestone_rows(milestones, cfg), allowMissingColumns=True)
        .unionByName(cohort_rows(sources.cohort), allowMissingColumns=True)
        .where("id_num is not null")
    )
    terms = (
        collapsed_terms(rows)
        .join(degree_slots(milestones, sides.degrees, cfg), [*SLOT_KEYS], "left")
        .join(declared_loads(sources.candidacy, sides.codes, cfg), [*SLOT_KEYS], "left")
    )
    return with_enrolment_events(terms, sides.months)


def term_facts(sources: Sources, cfg: Config, sides: Lookups | None = None) -> DataFrame:
    """The facts of every row before any rule: a term repeats with its candidacy rows."""
    return repeated_rows(student_terms(sources, sides or lookups(sources, cfg), cfg), cfg)


def observed_terms(terms: DataFrame, sides: Lookups) -> DataFrame:
    """Lookup from each term in which an event falls to the next one.

    It branches off the shuffle of :func:`read_twice`. The mark reads every column, so that this branch asks that
    shuffle for the same columns as the rows do and Spark runs it once for both. There are no more terms than the
    calendar has, and one row for none.
    """
    marked = terms.groupBy("term_code").agg(F.max(F.xxhash64(*terms.columns)).alias("_mark"))
    domain = marked.where(F.col("_mark").isNotNull()).select("term_code")
    return lookup_side(next_in_domain(domain, "term_code", "next_term"), rows=sides.terms + 1)


def derived_codes(facts: DataFrame, cfg: Config) -> DataFrame:
    """Status, level, type, load and admission of every row, from its facts and its neighbours."""
    ordered = in_order("id_num", ROW_ORDER)
    running = ordered.rowsBetween(*RUNNING)
    has = {e: F.col(name_of(e)) for e in (*MILESTONE_FLAGS, status.START, status.LAST)}
    entry = name_of(status.ENTRY)
    starts = has[status.ENTRY] | has[status.START]

    facts = facts.select(
        "*",
        starts.alias("starts"),
        F.when(starts, F.col("term_code")).alias("start_term"),
        status.initial_type(cfg, F.col("level"), degree_seeking(cfg), F.col("is_transfer")).alias("ini_styp"),
    )
    neighbours = {
        f"{place}_{column}": move(column).over(ordered)
        for place, move in (("previous", F.lag), ("next", F.lead))
        for column in ("hours", "level", entry)
    }
    placed = facts.select(
        "*",
        F.sum("weight").over(running).alias("row_num"),
        F.sum(F.when(F.col("starts"), F.col("weight")).otherwise(0)).over(running).alias("hist_group"),
        F.lag("ini_styp").over(ordered).alias("previous_styp"),
        *[c.alias(n) for n, c in neighbours.items()],
    )
    row_num = F.col("row_num")
    coded = placed.select(
        "*",
        status.load_indicator(
            cfg, F.col("hours"), F.col("previous_hours"), F.col("next_hours"), row_num, F.col("load_p_f")
        ).alias("ft_pt_ind"),
        status.status_code(cfg, F.col("term_code"), row_num, F.col("row_count"), has).alias("stst_code"),
        status.level_code(
            cfg,
            F.col("level"),
            F.col("previous_level"),
            F.col("next_level"),
            F.col("credit_rank"),
            has,
            F.col(f"previous_{entry}"),
            F.col(f"next_{entry}"),
        ).alias("levl_code"),
        status.student_type(F.col("starts"), F.col("ini_styp"), F.col("previous_styp")).alias("styp_code"),
    ).drop("previous_styp", *neighbours)
    # The first row of a group is a start row, or the student's first row: carrying its values forward
    # needs no window over groups and hence no other sort. A 0 stands for a row without a term.
    opens = F.col("starts") | (F.col("row_num") == 1)
    admit = F.last(F.when(opens, F.coalesce("start_term", F.lit(0))), ignorenulls=True).over(running)
    load = F.last(F.when(opens, F.col("ft_pt_ind")), ignorenulls=True).over(running)
    return coded.select(
        "*", F.nullif(admit, F.lit(0)).alias("term_code_admit"), load.alias("full_part_ind")
    )


def mapped_rows(derived: DataFrame, sides: Lookups) -> DataFrame:
    """Target codes of the two degree slots; a term without facts has no major."""
    enrolment = F.col(name_of(status.START)) | F.col(name_of(status.LAST))
    has_major = F.coalesce(
        F.col("term_code").isNotNull() & (F.col("has_major") | enrolment), F.lit(False)
    )
    return map_codes(derived.withColumn("has_major", has_major), *sides.maps)


def coded_rows(facts: DataFrame, sides: Lookups, cfg: Config) -> DataFrame:
    """Everything from the facts up to the filled codes: the rows the output is made of."""
    mapped = default_first_row(mapped_rows(derived_codes(facts, cfg), sides), cfg)
    return fill_forward(mapped, "id_num", ROW_ORDER, FILLED, cfg.fill_depth)


def history_rows(sources: Sources, cfg: Config) -> DataFrame:
    sides = lookups(sources, cfg)
    return coded_rows(term_facts(sources, cfg, sides), sides, cfg)


def own_rows(history: DataFrame, cfg: Config) -> DataFrame:
    """The rows themselves (sort 1) with the output's term."""
    return history.withColumns({"sort": F.lit(1), "term_code_eff": shift_month("term_code", cfg.month_shift)})


def read_twice(rows: DataFrame) -> DataFrame:
    """The same rows behind a shuffle of their own, so that all who read them share what was shuffled.

    A sort by range reads its input once for the bounds and once more for the rows; without this, it would run everything
    below it twice, as the next terms would a third time. The key spreads a student's rows, so no task holds many of one.
    """
    return rows.repartition("id_num", "term_code")


def follow_ups(history: DataFrame, following: DataFrame, cfg: Config) -> DataFrame:
    """The rows (sort 1) and the follow-up rows of one-term students (sort 2), with the output's term and status."""
    rows = emit_follow_up(history.join(following, "term_code", "left"), F.col("row_count") == 1, "sort")
    repeat = F.col("sort") == 2
    term = F.when(repeat, F.coalesce("next_term", "term_code")).otherwise(F.col("term_code"))
    later = F.when(F.col("term_code") < cfg.cutoff_term, F.lit("IS")).otherwise(F.lit("AS"))
    return rows.withColumns(
        {
            "term_code_eff": shift_month(term, cfg.month_shift),
            "stst_code": F.when(repeat, later).otherwise(F.col("stst_code")),
        }
    ).drop("next_term")


def with_external_ids(rows: DataFrame, external_ids: DataFrame) -> DataFrame:
    """Add ``pidm``. An id listed several times repeats its rows: by weight, so that a very frequent one stays small."""
    number = F.expr("try_cast(external_id as bigint)").alias("id_num")
    ids = external_ids.groupBy(number, "pidm").agg(F.count("*").alias("times")).where("id_num is not null")
    weight = F.col("weight") * F.coalesce("times", F.lit(1))
    return rows.join(ids, "id_num", "left").withColumn("weight", weight).drop("times")


def output_rows(rows: DataFrame, cfg: Config, sort: bool = True) -> DataFrame:
    """Copies, order and layout."""
    admit = shift_month("term_code_admit", cfg.month_shift)
    values = {
        "pidm": F.col("pidm"),
        **{c: F.col(c) for c in ("term_code_eff", "stst_code", "levl_code", "styp_code", "full_part_ind", *FILLED, "majr_code_conc_2")},
        "majr_code_1_2": F.col("majr_code_1_2"),
        "term_code_admit": admit,
        "term_code_ctlg_1": admit,
        "term_code_ctlg_2": F.when(F.col("program_2").isNotNull(), admit),
        "sort": F.col("sort"),
    }
    # A piece that stands for many rows is cut before the sort spreads the rows and written out after it.
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(weight - 1) div {COPIES_PER_CHUNK}"))
    rows = rows.select(
        "id_num", "row_num", "weight", *[c.alias(n) for n, c in values.items()], F.explode(chunks).alias("chunk")
    )
    if sort:
        order = ("pidm", "term_code_eff", "sort", "id_num", "row_num", "chunk")
        rows = rows.orderBy(*[F.asc_nulls_first(c) for c in order])
    size = F.least(F.lit(COPIES_PER_CHUNK), F.col("weight") - F.col("chunk") * COPIES_PER_CHUNK)
    rows = rows.select(*values, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("copy"))
    constants = {
        "camp_code": F.lit(cfg.campus),
        "resd_code": F.lit(cfg.residence),
        "admt_code": F.lit(cfg.admit_type),
    }
    return project_layout(rows, LAYOUT, {**{n: F.col(n) for n in values}, **constants}, cfg.column_prefix)


def student_term_history(sources: Sources, cfg: Config | None = None, sort: bool = True) -> DataFrame:
    """The whole conversion: one row per student and term in the target layout, sorted by id and term.

    Only the sizes of the small tables are read before the result is used.
    """
    cfg = cfg or Config()
    sides = lookups(sources, cfg)
    history = coded_rows(term_facts(sources, cfg, sides), sides, cfg).select(*KEPT)
    rows = read_twice(with_external_ids(history, sources.external_ids))
    return output_rows(follow_ups(rows, observed_terms(rows, sides), cfg), cfg, sort)
