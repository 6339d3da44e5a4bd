"""Helpers of several operators: tables in the shared folder, Arrow stages, distributed components."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only under a local master, where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    folder = tempfile.mkdtemp(prefix="termloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict[str, Any]]:
    """A stored table and aggregates over it, its `rows` among them, taken while it is written: no job of their own."""
    figures = {"rows": F.count(F.lit(1)), **figures}
    seen = Observation()
    table = stored(df.observe(seen, *[figure.alias(name) for name, figure in figures.items()]), label)
    found = seen.get
    if set(figures) - set(found):  # an optimizer rule took the whole plan away
        found = table.agg(*[figure.alias(name) for name, figure in figures.items()]).first().asDict()
    return table, found


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating stars: every vertex points its (larger or smaller) neighbours at the least one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    side = both if large else both.where("v < u")
    least = side.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    moved = side.join(least.hint("merge"), "u")  # many small rounds: broadcasts would pass through the driver each time
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(u, root) for every vertex that is not the least of its component; edges: distinct (u, v), u <> v.

    Alternating large and small stars; each round is a table in the shared folder. The number of rounds grows with the
    logarithm of the vertex count; no vertex gathers its neighbours in one task.
    """
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    now, before = stored_with(star(stored(edges, label), True), label, total=total)
    while before["rows"]:
        now, after = stored_with(star(star(now, False), True), label, total=total)
        if after == before:
            break
        before = after
    return now.select("u", F.col("v").alias("root"))


def hex64(value: Column) -> Column:
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_by_worker(kind: str, key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps from task to task; a new key replaces the old object of this kind."""
    state = sys.modules.setdefault("termloom_worker_state", types.ModuleType("termloom_worker_state")).__dict__
    if state.get(kind, (None,))[0] != key:
        state[kind] = (key, make())
    return state[kind][1]


#: Bytes of a table, as rows times the width of its schema, up to which it is sent to all executors.
BROADCAST_BYTES = 32 << 20


def small_or_merged(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A table counted before a join: broadcast if it is small, else held to a shuffled join with the same result.

    rows: a bound on its rows that is known already.
    """
    width = sum({"string": 64, "array": 256}.get(f.dataType.typeName(), 16) for f in df.schema.fields)
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df.hint("merge")


def least_by_hash(df: DataFrame, order: Column, most: int) -> DataFrame:
    """At most `most` rows, the least by a 64-bit hash.

    Rows that cannot be among them are dropped where they are read: a few times `most` rows are sorted and sent on, however
    many partitions there are.
    """
    name, total = fresh(df, "order"), df.count()
    part = min(1.0, 4 * most / max(1, total))
    marked = df.withColumn(name, order)
    if part < 1:
        marked = marked.where(F.col(name) <= int(part * 2.0**64) - (1 << 63))
    return marked.orderBy(name).limit(most).drop(name)


#: Rows of an Arrow batch: texts are long, and Spark's default of 10,000 would hold tens of MB on both sides of each worker.
TEXT_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches fit for texts, unless its user has chosen a size."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, str(TEXT_ROWS))
