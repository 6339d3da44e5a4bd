"""Every registered query: (spark, data folder) -> DataFrame, over the whole tables."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import courses as course_rules
from termloom.functions import status
from termloom.functions.terms import shift_month, term_code
from termloom.operators import calendar as cal
from termloom.operators import collapse, curriculum, events, history, output, segments
from termloom.operators.lookup import keep_keys, lookup_equals, override_code, spread_left_join
from termloom.plans import student_history as plan
from termloom.plans.student_history import student_term_history
from termloom.sources import Sources
from termloom.sources.star import ACCOUNT, STAR_CONFIG, read_table, star_sources

KEYS = list(curriculum.SLOT_KEYS)
# End of the last interval in the queries over orders and shipments.
LAST_DAY = datetime.date(2002, 12, 31)
CODES = [*plan.FILLED, "majr_code_conc_2", "majr_code_1_2"]


class Relations:
    """The named intermediate relations of one data folder, built from the single operators."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self.cfg = STAR_CONFIG
        self.sources: Sources = star_sources(spark, directory)
        self.calendar = cal.term_calendar(self.sources.year_terms, self.cfg)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.directory, name)

    def course_terms(self) -> DataFrame:
        return cal.attach_term(self.sources.courses, cal.term_codes(self.calendar))

    def majors(self) -> DataFrame:
        return override_code(self.sources.majors, "major_cde", "degr_cde", dict(self.cfg.major_degree_overrides))

    def bounds(self) -> DataFrame:
        valid = course_rules.valid_enrolment(self.cfg)
        return events.first_last(self.course_terms(), "id_num", valid, "trm_begin_dte")

    def timeline(self) -> DataFrame:
        return events.event_timeline(events.milestone_events(self.sources.degrees), self.bounds())

    def placed(self) -> DataFrame:
        return cal.interval_lookup(self.timeline(), cal.term_months(self.calendar), "sig_date")

    def event_majors(self) -> DataFrame:
        return curriculum.map_majors(self.placed(), self.majors())

    def event_degrees(self) -> DataFrame:
        return curriculum.event_degrees(self.placed(), self.cfg)

    def cohort_events(self) -> DataFrame:
        """Events of the cohort; other students go before anything is collapsed."""
        return keep_keys(self.placed(), self.sources.cohort, "id_num")

    def term_events(self) -> DataFrame:
        lists = {"sig_desc": "agg_sig_desc", "reason_code": "agg_reason_code"}
        return collapse.collapse(self.cohort_events(), KEYS, lists)

    def event_terms(self) -> DataFrame:
        """Students and terms with an event."""
        return self.cohort_events().select(*KEYS).distinct()

    def term_majors(self) -> DataFrame:
        return curriculum.term_majors(self.event_majors())

    def split(self) -> tuple[DataFrame, DataFrame]:
        return curriculum.split_by_codes(self.term_majors(), "mmd_degr_cde", self.cfg.certificate_degrees)

    @functools.cached_property
    def sides(self) -> plan.Lookups:
        return plan.lookups(self.sources, self.cfg)

    def facts(self) -> DataFrame:
        return plan.term_facts(self.sources, self.cfg, self.sides)

    def pieces(self) -> DataFrame:
        """The rows as the plan carries them: a piece may stand for many equal rows."""
        return plan.derived_codes(self.facts(), self.cfg)

    def derived(self) -> DataFrame:
        return plan.written_out(self.pieces())

    def mapped(self) -> DataFrame:
        return plan.written_out(plan.mapped_rows(self.pieces(), self.sides))

    def history(self) -> DataFrame:
        return plan.written_out(plan.history_rows(self.sources, self.cfg))

    def user_days(self) -> DataFrame:
        bought = F.when(F.col("event_type") == "purchase", F.col("value"))
        return (
            self.table("events")
            .groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(
                F.max(bought).alias("spent"),
                F.max(F.col("event_type") == "signup").alias("signed_up"),
                F.count("*").alias("n"),
            )
        )


def term_calendar(r: Relations) -> DataFrame:
    return r.calendar


def term_codes(r: Relations) -> DataFrame:
    code = term_code("o_orderdate")
    shifted = shift_month(code, r.cfg.month_shift)
    return r.table("orders").select("o_orderkey", code.alias("term_code"), shifted.alias("shifted_term_code"))


def attempted_hours(r: Relations) -> DataFrame:
    summed = collapse.sum_by_term(r.course_terms(), KEYS, "hrs_attempted", "sum_hrs_attempted")
    return summed.withColumn("sum_hrs_attempted", F.col("sum_hrs_attempted").cast("double"))


def candidacy_terms(r: Relations) -> DataFrame:
    real = (F.col("yr_cde") != r.cfg.dummy_year) | (F.col("trm_cde") != r.cfg.dummy_term)
    with_code = r.calendar.withColumn("term_code", term_code("trm_begin_dte"))
    return cal.attach_term(r.sources.candidacy.where(real), cal.lookup_side(with_code))


def enrolment_bounds(r: Relations) -> DataFrame:
    return r.bounds().withColumn("first_term_code", term_code("first_term_date"))


def term_majors_agg(r: Relations) -> DataFrame:
    lists = {c: f"agg_{c}" for c in ("major_1", "major_2", "concentration_1")}
    return collapse.collapse(r.event_majors(), KEYS, lists)


def term_degrees_agg(r: Relations) -> DataFrame:
    return collapse.collapse(
        r.event_degrees(), KEYS, {"degr_cde": "agg_degree_code"}, {"degree_level": "highest_degree"}
    )


def credit_type_rank(r: Relations) -> DataFrame:
    own = r.course_terms().where(course_rules.valid_enrolment(r.cfg))
    return collapse.max_rank(own, KEYS, course_rules.credit_rank(r.cfg), "max_credit_type_rank")


def student_flags(r: Relations) -> DataFrame:
    return collapse.flag_any(
        r.sources.courses,
        "id_num",
        {
            "is_transfer": course_rules.is_transfer(r.cfg),
            "is_active": course_rules.is_active(r.cfg),
            "has_attempted": course_rules.attempted_enrolment(r.cfg),
        },
    )


def cohort_semi(r: Relations) -> DataFrame:
    attempting = r.sources.courses.where(course_rules.attempted_enrolment(r.cfg)).select("id_num").distinct()
    return keep_keys(r.event_terms(), attempting, "id_num")


def first_term_flag(r: Relations) -> DataFrame:
    first = r.bounds().select("id_num", term_code("first_term_date").alias("first"))
    return lookup_equals(r.event_terms(), first, "id_num", "first", "term_code", "is_first_term")


def derived(*columns: str) -> Callable[[Relations], DataFrame]:
    return lambda r: r.derived().select(*KEYS, *columns)


def history_groups(r: Relations) -> DataFrame:
    starts = r.derived().select(*KEYS, "row_num", "starts")
    groups = history.marker_groups(starts, "id_num", "row_num", F.col("starts"), "hist_group")
    return groups.drop("row_num")


def group_first_values(r: Relations) -> DataFrame:
    rows = r.derived().select(*KEYS, "row_num", "hist_group", "start_term", "ft_pt_ind")
    first = {"start_term": "term_code_admit", "ft_pt_ind": "full_part_ind"}
    return history.first_in_group(rows, ("id_num", "hist_group"), "row_num", first).drop("row_num", *first)


def degree_split(r: Relations) -> DataFrame:
    outside, inside = r.split()
    return outside.withColumn("kind", F.lit("degree")).unionByName(inside.withColumn("kind", F.lit("certificate")))


def layout(r: Relations) -> DataFrame:
    """The plan's own output rows, without the follow-up rows."""
    history = plan.with_external_ids(plan.history_rows(r.sources, r.cfg).select(*plan.KEPT), r.sources.external_ids)
    return plan.output_rows(plan.own_rows(history, r.cfg), r.cfg, sort=False)


def follow_up_rows(r: Relations) -> DataFrame:
    rows = plan.read_twice(r.derived().select("id_num", "term_code", "row_count", "stst_code"))
    return plan.follow_ups(rows, plan.observed_terms(rows, r.sides), r.cfg).drop("term_code", "row_count")


def daily_fill_forward(r: Relations) -> DataFrame:
    days = r.user_days().select("user_id", "day", "n", "spent")
    return history.fill_forward(days, "user_id", "day", ["spent"], r.cfg.fill_depth)


def daily_marker_groups(r: Relations) -> DataFrame:
    return history.marker_groups(
        r.user_days().select("user_id", "day", "n", "signed_up"), "user_id", "day", F.col("signed_up"), "visit"
    ).drop("signed_up")


def order_line_slots(r: Relations) -> DataFrame:
    return curriculum.slot_pivot(
        r.table("lineitem"), ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"]
    )


def shipment_terms(r: Relations) -> DataFrame:
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return cal.interval_lookup(lines, cal.term_months(r.calendar), "l_shipdate")


def order_periods(r: Relations) -> DataFrame:
    """A calendar for each customer: an order opens a period, which lasts to the day before the next one."""
    orders = r.table("orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("first_day"))
    return cal.extend_intervals(orders, "first_day", "last_day", ("o_orderkey",), LAST_DAY, by=("o_custkey",))


def customer_shipments(r: Relations) -> DataFrame:
    """Order lines with the customer they go to."""
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"))
    owners = r.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(owners, "l_orderkey")


def keyed_interval_join(r: Relations) -> DataFrame:
    lines = customer_shipments(r)
    return cal.keyed_interval_lookup(lines, order_periods(r), "o_custkey", "ship_day", "first_day", "last_day", ["o_orderkey", "first_day"])


def shipment_intervals(r: Relations) -> DataFrame:
    """Every shipment lasts to the day before the next one of the whole table."""
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"))
    return cal.extend_intervals(lines, "ship_day", "until", ("l_orderkey", "l_linenumber"), LAST_DAY, large=True)


def spread_lookup(r: Relations) -> DataFrame:
    """Part data of order lines by a code that is empty on half of the lines and missing on some."""
    code = F.when(F.col("l_returnflag") == "N", F.lit("")).when(F.col("l_linenumber") < 7, F.col("l_partkey").cast("string"))
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", code.alias("code"))
    parts = r.table("part").select(F.col("p_partkey").cast("string").alias("code"), "p_name", "p_brand")
    return spread_left_join(lines, parts.unionByName(empty_part(r)), "code", ("l_orderkey", "l_linenumber"))


def empty_part(r: Relations) -> DataFrame:
    return r.table("part").agg(F.lit("").alias("code"), F.min("p_name").alias("p_name"), F.max("p_brand").alias("p_brand"))


def typed_events(r: Relations) -> DataFrame:
    """Events by type: a handful of keys, so each one holds a large part of all rows."""
    cents = F.floor(F.col("value") * 100).cast("long")
    noted = F.when(F.col("event_type") != "view", F.col("user_id"))
    kind = F.when(F.col("event_type").isin("view", "click"), "look").otherwise(F.col("event_type"))
    return r.table("events").select("event_id", kind.alias("kind"), "ts", cents.alias("cents"), noted.alias("noted"))


def hot_running_sum(r: Relations) -> DataFrame:
    events_ = typed_events(r)
    sums = {"nth": F.lit(1), "total_cents": F.col("cents")}
    return segments.running(events_, "kind", ("ts", "event_id"), sums, {"last_noted": F.col("noted")}).drop("ts", "noted")


def hot_fill_forward(r: Relations) -> DataFrame:
    events_ = typed_events(r).select("event_id", "kind", "ts", "noted")
    return segments.long_fill_forward(events_, "kind", ("ts", "event_id"), ["noted"], r.cfg.fill_depth).drop("ts")


def hot_marker_groups(r: Relations) -> DataFrame:
    events_ = typed_events(r)
    opens = F.col("event_id") % 50 == 0
    grouped = segments.long_marker_groups(events_, "kind", ("ts", "event_id"), opens, "visit")
    first = segments.long_first_in_group(grouped, "kind", ("ts", "event_id"), opens, {"noted": "first_noted"})
    return first.select("event_id", "kind", "visit", "first_noted")


def single_quarter_follow_up(r: Relations) -> DataFrame:
    period = (F.year("o_orderdate") * 10 + F.quarter("o_orderdate")).alias("period")
    quarters = (
        r.table("orders")
        .groupBy(F.expr(ACCOUNT).alias("account"), period)
        .agg(F.count("*").alias("orders"), F.min("o_orderdate").alias("first_order"))
    )
    counts = F.count("*").over(history.in_order("account", "period").rowsBetween(*history.WHOLE))
    return output.emit_follow_up(quarters.withColumn("quarters", counts), F.col("quarters") == 1, "part")


QUERIES: dict[str, Callable[[Relations], DataFrame]] = {
    "term_calendar": term_calendar,
    "term_code": term_codes,
    "major_override": Relations.majors,
    "attempted_hours": attempted_hours,
    "candidacy_terms": candidacy_terms,
    "enrolment_bounds": enrolment_bounds,
    "event_unpivot": lambda r: events.milestone_events(r.sources.degrees).distinct(),
    "event_timeline": Relations.timeline,
    "interval_join": Relations.placed,
    "event_majors": Relations.event_majors,
    "event_degree_levels": Relations.event_degrees,
    "term_majors_agg": term_majors_agg,
    "term_degrees_agg": term_degrees_agg,
    "term_events": Relations.term_events,
    "rows_per_student": lambda r: collapse.count_rows(r.term_events(), ["id_num"], "row_count"),
    "credit_type_rank": credit_type_rank,
    "cohort_semi": cohort_semi,
    "student_flags": student_flags,
    "first_term_flag": first_term_flag,
    "load_indicator": derived("row_num", "row_count", "ft_pt_ind"),
    "initial_type": derived("starts", "start_term", "ini_styp"),
    "status_code": derived("stst_code"),
    "level_code": derived("levl_code"),
    "student_type": derived("styp_code"),
    "history_groups": history_groups,
    "group_first_values": group_first_values,
    "major_slots_unpivot": Relations.term_majors,
    "degree_split": degree_split,
    "degree_count": lambda r: collapse.count_rows(r.split()[0], KEYS, "count_degree"),
    "degree_slots": lambda r: curriculum.two_slots(r.split()[0]),
    "certificate_slots": lambda r: curriculum.two_slots(r.split()[1]),
    "mapped_codes": lambda r: r.mapped().select(*KEYS, *CODES),
    "first_row_defaults": lambda r: curriculum.default_first_row(r.mapped(), r.cfg).select(*KEYS, *CODES),
    "fill_forward_6": lambda r: r.history().select(*KEYS, *CODES),
    "next_observed_term": lambda r: output.next_in_domain(r.facts(), "term_code", "next_term"),
    "follow_up_rows": follow_up_rows,
    "layout": layout,
    "student_term_history": lambda r: student_term_history(r.sources, r.cfg),
    "daily_fill_forward": daily_fill_forward,
    "daily_marker_groups": daily_marker_groups,
    "order_line_slots": order_line_slots,
    "shipment_terms": shipment_terms,
    "single_quarter_follow_up": single_quarter_follow_up,
    "order_periods": order_periods,
    "keyed_interval_join": keyed_interval_join,
    "shipment_intervals": shipment_intervals,
    "next_observed_time": lambda r: output.next_in_domain(r.table("events"), "ts", "next_ts", large=True),
    "spread_lookup": spread_lookup,
    "hot_running_sum": hot_running_sum,
    "hot_fill_forward": hot_fill_forward,
    "hot_marker_groups": hot_marker_groups,
}


def run(name: str, spark: SparkSession, directory: str) -> DataFrame:
    return QUERIES[name](Relations(spark, directory))
