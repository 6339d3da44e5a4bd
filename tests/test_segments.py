"""Windows over hot keys and whole tables: same rows as plain windows, even groups, no task for everything."""

import datetime
import random
from decimal import Decimal

import pytest
from compare import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from termloom.operators import history, segments
from termloom.operators.calendar import extend_intervals, keyed_interval_lookup
from termloom.operators.output import next_in_domain

ORDER = ("at", "n")


def same(got, want):
    assert got.columns == want.columns
    a, b = rows_of(got.collect(), got.columns), rows_of(want.collect(), want.columns)
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """One user with half of all rows, many small ones, a null key, null and equal times."""
    dice = random.Random(3)
    rows = []
    for n in range(20_000):
        user = "hot" if n % 2 else dice.choice([None, "b", *[f"u{k}" for k in range(400)]])
        at = dice.choice([None, *range(5)]) if dice.random() < 0.05 else dice.randrange(100_000)
        rows.append((user, at, n, dice.choice([None, None, None, *range(50)]), dice.random() < 0.1))
    return spark.createDataFrame(rows, "user string, at long, n long, value long, opens boolean").repartition(5).persist()


@pytest.fixture(scope="module")
def cut(hot):
    return segments.segmented(hot, "user", ORDER)


def test_hot_key_is_cut_evenly(spark, hot, cut):
    assert [r.user for r in cut.hot.collect()] == ["hot"]
    sizes = [r["count"] for r in cut.rows.groupBy("user", segments.SEGMENT).count().collect()]
    limit = segments.segment_rows(hot, hot.count())
    assert max(sizes) <= 1.2 * limit and sum(s > limit / 2 for s in sizes) == 8


def test_no_large_key_no_cut(spark, hot):
    assert segments.segmented(hot.where("user <> 'hot'"), "user", ORDER).hot is None
    assert segments.segmented(hot.limit(0), "user", ORDER).hot is None


def test_running(spark, hot):
    over = history.in_order("user", ORDER).rowsBetween(*history.RUNNING)
    want = hot.select("*", F.sum("value").over(over).alias("total"), F.last("value", True).over(over).alias("latest"))
    same(segments.running(hot, "user", ORDER, {"total": F.col("value")}, {"latest": F.col("value")}), want)


@pytest.mark.parametrize("depth", [None, 1, 6])
def test_fill_forward(spark, hot, depth):
    want = history.fill_forward(hot, "user", ORDER, ["value"], depth)
    same(segments.long_fill_forward(hot, "user", ORDER, ["value"], depth), want)


def test_groups_and_their_first_values(spark, hot):
    want = history.marker_groups(hot, "user", ORDER, F.col("opens"), "visit")
    got = segments.long_marker_groups(hot, "user", ORDER, F.col("opens"), "visit")
    same(got, want)
    firsts = history.first_in_group(want, ("user", "visit"), ORDER, {"value": "first"})
    firsts = firsts.withColumn("first", F.when(F.col("visit") > 0, F.col("first")))
    same(segments.long_first_in_group(got, "user", ORDER, F.col("opens"), {"value": "first"}), firsts)


def test_keys_of_several_columns_and_many_large_keys(spark, hot):
    df = hot.withColumn("part", F.col("n") % 3)
    over = history.in_order(["user", "part"], ORDER).rowsBetween(*history.RUNNING)
    want = df.select("*", F.count("*").over(over).alias("nth"))
    got = segments.running(df, ["user", "part"], ORDER, {"nth": F.lit(1)}, least=100)
    assert segments.segmented(df, ["user", "part"], ORDER, 100).hot.count() >= 3
    same(got, want)


KINDS = {
    "long": lambda k: (1 << 60) + k // 2,
    "double": lambda k: k / 3 if k % 50 else float("nan"),
    "decimal(20,2)": lambda k: Decimal(k) / 4,
    "date": lambda k: datetime.date(1990, 1, 1) + datetime.timedelta(k // 3),
    "timestamp": lambda k: datetime.datetime(2021, 3, 28) + datetime.timedelta(seconds=7 * k),
    "timestamp_ntz": lambda k: datetime.datetime(2021, 3, 28) + datetime.timedelta(microseconds=7 * k),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_lead_of_every_kind(spark, kind, zone):
    dice = random.Random(kind)
    rows = [(None if dice.random() < 0.03 else KINDS[kind](dice.randrange(9000)), n) for n in range(9000)]
    df = spark.createDataFrame(rows, f"x {kind}, n long")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        want = df.withColumn("following", F.lead("x").over(Window.orderBy(F.asc_nulls_first("x"), "n")))
        got = segments.lead_value(df, "x", ("n",))
        text = [F.col(c).cast("string") for c in ("x", "n", "following")]
        same(got.select(*text), want.select(*text))
        assert "SinglePartition" not in plan_of(got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_million_intervals(spark):
    days = spark.range(1_000_000).select("id", F.date_add(F.lit(datetime.date(1700, 1, 1)), F.pmod(F.xxhash64("id"), 90_000).cast("int")).alias("day"))
    got = extend_intervals(days, "day", "until", ("id",), datetime.date(2100, 1, 1), large=True)
    assert "SinglePartition" not in plan_of(got)
    want = extend_intervals(days, "day", "until", ("id",), datetime.date(2100, 1, 1))
    marks = [F.count("*"), F.sum(F.xxhash64("until", "id", "day").cast("decimal(20,0)"))]
    assert got.agg(*marks).first() == want.agg(*marks).first()


def test_only_nulls_and_no_rows(spark):
    nulls = spark.createDataFrame([(None, n) for n in range(3000)], "x long, n long")
    assert segments.lead_value(nulls, "x", ("n",)).where("following is not null").count() == 0
    assert segments.lead_value(nulls.limit(0), "x").count() == 0
    assert next_in_domain(nulls, "x", "y", large=True).collect()[0].asDict() == {"x": None, "y": None}


def calendars(spark, seed, hot_part):
    """Intervals and events per group; one group has a part of both."""
    dice = random.Random(seed)
    day = lambda: datetime.date(2000, 1, 1) + datetime.timedelta(dice.randrange(4000))
    group = lambda: "hot" if dice.random() < hot_part else dice.choice([None, *[f"g{k}" for k in range(60)]])
    opened = spark.createDataFrame([(group(), None if dice.random() < 0.02 else day(), n) for n in range(6000)], "grp string, opens date, n long")
    events = spark.createDataFrame([(group(), None if dice.random() < 0.02 else day(), n) for n in range(9000)], "grp string, sig_date date, n long")
    return opened, events


@pytest.mark.parametrize("hot_part", [0.0, 0.5])
def test_intervals_of_each_key(spark, hot_part):
    opened, _ = calendars(spark, 5, hot_part)
    order = Window.partitionBy("grp").orderBy(F.asc_nulls_first("opens"), "n")
    ends = F.date_sub(F.lead("opens").over(order), 1)
    same(extend_intervals(opened, "opens", "ends", ("n",), by=("grp",)), opened.select(ends.alias("ends"), "*"))


@pytest.mark.parametrize("hot_part", [0.0, 0.5])
def test_keyed_interval_lookup(spark, hot_part):
    opened, events = calendars(spark, 6, hot_part)
    spans = extend_intervals(opened, "opens", "ends", ("n",), datetime.date(2009, 1, 1), by=("grp",)).withColumnRenamed("n", "span").persist()
    got = keyed_interval_lookup(events, spans, "grp", "sig_date", "opens", "ends", ["span", "opens"])
    side = spans.select(F.col("grp").alias("g"), "span", "opens", "ends")
    inside = (F.col("grp") == F.col("g")) & F.col("sig_date").between(F.col("opens"), F.col("ends"))
    same(got, events.join(side, inside, "left").drop("g", "ends"))
    text = plan_of(got)
    assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
