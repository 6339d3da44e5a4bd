"""The nine inputs derived from a sales star schema (orders, lineitem, customer, part).

There is no student data to test with, so orders stand in: a customer account is a student, an order
line a course registration, an account's orders of one priority a degree record. Some customers keep an
account per order priority, which gives short histories beside the long ones. Every table is read whole.
The scalar expressions are portable SQL; the SQL oracle uses the same ones.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.sources import Sources, conform

# Parameters that fit these dates (1995-2001).
STAR_CONFIG = Config(
    active_year="0001", active_terms=("SP", "SU"), cutoff_term=200101, current_terms=(200101, 200106)
)


def two_digits(n: str) -> str:
    return f"lpad(CAST(({n}) % 100 AS STRING), 2, '0')"


def degree_of(n: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(("BA", "BS", "A", "V", "C", "NDA")))
    return f"CASE ({n}) % 7 {arms} ELSE 'BSW' END"


def major_of(n: str) -> str:
    return f"CASE WHEN ({n}) % 56 = 50 THEN 'LAR' ELSE concat('M', CAST(({n}) % 56 AS STRING)) END"


ACCOUNT = (
    "CASE WHEN o_custkey % 3 = 0 THEN o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) "
    "ELSE o_custkey * 10 END"
)
# Last digit of an account number; not every customer uses every one.
ACCOUNT_DIGITS = (0, 1, 2, 3, 4, 5)
_Y = "year(o_orderdate)"
TERM = "CASE WHEN month(o_orderdate) <= 5 THEN 'SP' WHEN month(o_orderdate) <= 7 THEN 'SU' ELSE 'FA' END"
YEAR = (
    f"CASE WHEN month(o_orderdate) <= 7 THEN concat({two_digits(_Y + ' - 1')}, {two_digits(_Y)}) "
    f"ELSE concat({two_digits(_Y)}, {two_digits(_Y + ' + 1')}) END"
)
# (academic year, term, begin month and day, end month and day) of the calendar year y
TERMS = (
    (f"concat({two_digits('y - 1')}, {two_digits('y')})", "SP", (1, 10), (5, 5)),
    (f"concat({two_digits('y - 1')}, {two_digits('y')})", "SU", (6, 1), (7, 31)),
    (f"concat({two_digits('y')}, {two_digits('y + 1')})", "FA", (8, 20), (12, 15)),
)
# What a course row takes from its order, worked out once per order.
COURSE_ORDER = {"o_orderkey": "o_orderkey", "id_num": ACCOUNT, "yr": YEAR, "trm": TERM}
_MOVED = "l_linenumber = 7 AND l_returnflag = 'R'"
COURSES = {
    "id_num": "id_num",
    "yr_cde": f"CASE WHEN {_MOVED} THEN 'TRAN' ELSE yr END",
    "trm_cde": f"CASE WHEN {_MOVED} THEN 'TR' ELSE trm END",
    "grade_cde": (
        "CASE WHEN l_returnflag = 'R' AND l_quantity <= 10 THEN 'T' "
        "WHEN l_returnflag = 'N' AND l_quantity > 45 THEN NULL ELSE 'A' END"
    ),
    "transaction_sts": "CASE WHEN l_linestatus = 'F' AND l_quantity < 5 THEN 'D' ELSE 'H' END",
    "credit_hrs": "CAST(l_linenumber % 5 AS INT)",
    "hrs_attempted": "CAST(l_linenumber % 5 AS DECIMAL(9,3)) - CASE WHEN l_suppkey % 16 = 0 THEN 0.001 ELSE 0.000 END",
    "credit_type_cde": "CASE l_suppkey % 3 WHEN 0 THEN 'CR' WHEN 1 THEN 'VO' ELSE 'CE' END",
}
# One row per account and priority: first and last order date, smallest key, status range.
RECORD_GROUP = {"id_num": ACCOUNT, "o_orderpriority": "o_orderpriority"}
RECORD = {
    "first_date": "min(o_orderdate)",
    "last_date": "max(o_orderdate)",
    "k": "min(o_orderkey)",
    # 1 F, 2 O, 3 P
    "low": "min(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)",
    "high": "max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)",
}
DEGREES = {
    "id_num": "id_num",
    "entry_dte": "CAST(first_date AS DATE)",
    "exit_dte": "CASE WHEN low = 1 AND k % 3 > 0 THEN CAST(last_date + INTERVAL '100' DAY AS DATE) END",
    "dte_degr_conferred": "CASE WHEN high = 2 THEN CAST(first_date + INTERVAL '1400' DAY AS DATE) END",
    "withdrawal_dte": "CASE WHEN low = 3 THEN CAST(first_date + INTERVAL '200' DAY AS DATE) END",
    "exit_reason": "CASE WHEN low = 1 THEN substr(o_orderpriority, 1, 1) ELSE '' END",
    "major_1": f"CASE WHEN k % 56 = 55 THEN NULL ELSE {major_of('k')} END",
    "major_2": f"CASE WHEN k % 4 = 0 THEN {major_of('k + 7')} END",
    "concentration_1": "CASE WHEN k % 5 = 0 THEN concat('C', CAST(k % 3 AS STRING)) ELSE '' END",
    "degr_cde": f"CASE WHEN k % 13 = 0 THEN 'ADE' WHEN k % 17 = 0 THEN NULL ELSE {degree_of('k % 56')} END",
    "div_cde": "CASE WHEN k % 13 = 0 AND k % 2 = 0 THEN 'A' WHEN k % 4 = 1 THEN 'U' ELSE 'X' END",
}
# The orders of odd and of even keys give a row each, so a term may have two, equal or not.
CANDIDACY_GROUP = {"id_num": ACCOUNT, "yr_cde": YEAR, "trm_cde": TERM, "half": "o_orderkey % 2"}
CANDIDACY = {
    "load_p_f": "CASE min(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 END) WHEN 1 THEN 'F' WHEN 2 THEN 'P' END",
    "candidacy_type": "CAST(min(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS STRING)",
}
# Major rows differ in columns that nobody reads, so that rows repeat.
MAJOR_TWIN = "p_partkey % 2"
MAJORS = {"major_cde": major_of("p_size"), "degr_cde": degree_of("p_size")}
CONCENTRATIONS = ("", "C0", "C1")
CODE_MAP = {
    "map_code": "concat(degr_cde, major_cde, conc)",
    "college": "'U'",
    "degree": "degr_cde",
    "major": "concat('B', major_cde)",
    "concentration": "conc",
    "program": "concat('P', major_cde)",
}
DEGREE_MAP = {
    "degree_code": "degr_cde",
    "college": "'U'",
    "degree": "CASE WHEN degr_cde = 'NDA' THEN 'NOND' ELSE degr_cde END",
    "program": "concat('P-', degr_cde)",
}
DEGREE_MAP_ROWS = "degr_cde <> 'BSW'"
# Per customer and account digit d.
ACCOUNTS = {"id_num": "c_custkey * 10 + d"}
EXTERNAL_IDS = {"external_id": "CAST(c_custkey * 10 + d AS STRING)", "pidm": "100000 + c_custkey * 10 + d"}
EXTERNAL_IDS_ROWS = "c_acctbal >= 0"
COHORT_ROWS = "c_mktsegment <> 'FURNITURE'"


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _named(columns: dict[str, str]) -> list:
    return [F.expr(text).alias(name) for name, text in columns.items()]


def _year_terms(orders: DataFrame) -> DataFrame:
    years = orders.select(F.year("o_orderdate").alias("y")).distinct()
    terms = [
        F.struct(
            F.expr(year).alias("yr_cde"),
            F.lit(code).alias("trm_cde"),
            F.make_date("y", F.lit(begin[0]), F.lit(begin[1])).alias("trm_begin_dte"),
            F.make_date("y", F.lit(end[0]), F.lit(end[1])).alias("trm_end_dte"),
        )
        for year, code, begin, end in TERMS
    ]
    dummy_day = F.lit(datetime.date(1900, 1, 1))
    dummy = F.struct(
        F.lit("ZZZZ").alias("yr_cde"),
        F.lit("ZZ").alias("trm_cde"),
        dummy_day.alias("trm_begin_dte"),
        dummy_day.alias("trm_end_dte"),
    )
    real = years.select(F.explode(F.array(*terms)).alias("t")).select("t.*")
    return real.unionByName(years.agg(F.max("y")).select(dummy.alias("t")).select("t.*"))


def star_sources(spark: SparkSession, directory: str) -> Sources:
    """Inputs over ``<directory>/{orders,lineitem,customer,part}.parquet``."""
    orders, lineitem, customer, part = (
        read_table(spark, directory, t) for t in ("orders", "lineitem", "customer", "part")
    )
    course_orders = orders.select(*_named(COURSE_ORDER))
    courses = lineitem.join(course_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*_named(COURSES))
    records = orders.groupBy(*_named(RECORD_GROUP)).agg(*_named(RECORD))
    major_rows = part.select("p_size", F.expr(MAJOR_TWIN).alias("twin")).distinct().select(*_named(MAJORS))
    majors = major_rows.distinct()
    with_conc = majors.select("*", F.explode(F.array(*[F.lit(c) for c in CONCENTRATIONS])).alias("conc"))
    digits = F.array(*[F.lit(d) for d in ACCOUNT_DIGITS])
    accounts = customer.select("*", F.explode(digits).alias("d"))
    tables = {
        "year_terms": _year_terms(orders),
        "courses": courses,
        "candidacy": orders.groupBy(*_named(CANDIDACY_GROUP)).agg(*_named(CANDIDACY)),
        "degrees": records.select(*_named(DEGREES)),
        "majors": major_rows,
        "cohort": accounts.where(COHORT_ROWS).select(*_named(ACCOUNTS)),
        "code_map": with_conc.select(*_named(CODE_MAP)),
        "degree_map": majors.select("degr_cde").distinct().where(DEGREE_MAP_ROWS).select(*_named(DEGREE_MAP)),
        "external_ids": accounts.where(EXTERNAL_IDS_ROWS).select(*_named(EXTERNAL_IDS)),
    }
    return Sources(**{name: conform(df, name) for name, df in tables.items()})
