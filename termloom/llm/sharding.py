"""Sharding by histogram sort: shards of near equal bytes in which equal texts lie together.

Rows are ordered by (hash of the text, id, row number). The boundaries between shards are found without sorting: probes, that
is candidate boundaries, are sent to all partitions, which count the exact bytes below each one; the two probes around a
target enclose it more and more closely until one is within the tolerance. A boundary lies between two texts wherever one
meets the tolerance; only a group of equal texts that is too large for that is cut between ids, and a repeated id between its
rows. Then all rows are exchanged once. A shard is cut into ranges by the same probes, so a task sorts a range, not a shard,
and a row's slot is the number of rows in the earlier ranges plus its place in its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: How far a shard's boundary may lie from its target, as a part of a shard's bytes.
TOLERANCE = 0.01
#: Rows of a range, about; and probes of one round of counting.
RANGE_ROWS = 500_000
PROBES = 4096
#: Keys are three unsigned 64-bit numbers, compared as one number of 192 bits.
KEY = ("_hash", "_id", "_row")
UNITS = (1 << 128, 1 << 64, 1)
END = 1 << 192


class Splitter(NamedTuple):
    """A boundary that is looked for between the keys `low` and `high`, which have so many bytes below them."""

    target: float
    tolerance: float
    low: int
    low_bytes: int
    high: int
    high_bytes: int
    level: int = 0

    def nearest(self) -> int:
        return self.low if self.target - self.low_bytes <= self.high_bytes - self.target else self.high

    def done(self) -> bool:
        within = min(self.target - self.low_bytes, self.high_bytes - self.target) <= self.tolerance
        return within or (self.level == len(UNITS) - 1 and self.high - self.low <= 1)

    def deeper(self, least: Sequence[int], most: Sequence[int]) -> Splitter:
        """Where no key of this level is left between the ends, the boundary lies inside the group of the lower one."""
        now = self
        while not now.done() and now.level + 1 < len(UNITS) and now.high - now.low <= UNITS[now.level]:
            level, start = now.level + 1, now.low - now.low % UNITS[now.level]
            low, high = start + least[level] * UNITS[level], start + (most[level] + 1) * UNITS[level]
            now = now._replace(level=level, low=max(now.low, low), high=min(now.high, high))
        return now

    def probes(self, count: int) -> list[int]:
        unit = UNITS[self.level]
        steps = (self.high - self.low - 1) // unit
        count = min(count, steps)
        return sorted({self.low - self.low % unit + unit * (1 + k * steps // count) for k in range(count)}) if count else []

    def narrowed(self, probes: Sequence[int], below: np.ndarray) -> Splitter:
        """Between the last probe with at most the target below it, and the next one; both ascending."""
        after = int(np.searchsorted(below, self.target, side="right"))
        now = self
        if after and probes[after - 1] > now.low:
            now = now._replace(low=probes[after - 1], low_bytes=int(below[after - 1]))
        if after < len(probes) and probes[after] < now.high:
            now = now._replace(high=probes[after], high_bytes=int(below[after]))
        return now


def packed_keys(keys: Sequence[int]) -> np.ndarray:
    return np.array([k.to_bytes(24, "big") for k in keys], "S24")


def row_keys(batch: pa.RecordBatch) -> np.ndarray:
    """The keys of a batch as texts of 24 bytes, whose order is that of the signed columns."""
    columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in KEY]
    words = np.stack([c.view(np.uint64) ^ np.uint64(1 << 63) for c in columns], axis=1)
    return np.ascontiguousarray(words.astype(">u8")).view("S24").ravel()


def bytes_below(rows: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact (bytes, rows) below each of the ascending probes, counted in every partition and added up."""
    sent = rows.sparkSession.sparkContext.broadcast(packed_keys([p for p in probes if p < END]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = sent.value
        sums = np.zeros((2, len(bounds) + 1), np.int64)
        for batch in batches:
            part = np.searchsorted(bounds, row_keys(batch), side="right")
            np.add.at(sums[0], part, batch.column("size").to_numpy())
            sums[1] += np.bincount(part, minlength=len(bounds) + 1)
        used = np.flatnonzero(sums[1])
        yield pa.record_batch([pa.array(used), *[pa.array(s[used]) for s in sums]], ["part", "bytes", "n"])

    counted = rows.select(*KEY, "size").mapInArrow(work, "part long, bytes long, n long")
    sums = np.zeros((2, len(probes) + 1), np.int64)
    for row in counted.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect():  # one row a probe
        sums[:, row.part] = row.bytes, row.n
    sent.destroy()
    below = np.cumsum(sums, axis=1)[:, :-1]
    return below[0], below[1]


def boundaries(rows: DataFrame, total: int, least: Sequence[int], most: Sequence[int], ranges: int, each: int, tolerance: float) -> list[int]:
    """The keys that cut the rows into ranges of near equal bytes; every `each`-th one bounds a shard."""
    shard = total * each / ranges
    open_ = {
        k: Splitter(total * k / ranges, tolerance * shard if k % each == 0 else total / ranges / 4, 0, 0, END, total)
        for k in range(1, ranges)
    }
    found = {}
    while open_:
        for k in list(open_):
            open_[k] = open_[k].deeper(least, most)
            if open_[k].done():
                found[k] = open_.pop(k).nearest()
        probes = sorted({p for s in open_.values() for p in s.probes(max(2, PROBES // len(open_)))})
        if probes:
            below, _ = bytes_below(rows, probes)
            open_ = {k: s.narrowed(probes, below) for k, s in open_.items()}
    return sorted(found.values())


def shards(
    docs: DataFrame, count: int, keep: Sequence[str | Column], tolerance: float = TOLERANCE, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The columns `keep` of every row, with size (long), shard (int, from 0) and slot (long, gapless from 0 in its shard).

    A row's size is the UTF-8 bytes of its text plus 16; a null text has none. Shards hold near equal bytes: every boundary is
    within `tolerance` of a shard, or at the row nearest to its target. Slots follow the order of (hash of the text, id, row),
    so equal texts are neighbours, in one shard unless a boundary must cut their group. Null ids come first. Rows of one id are
    rows of their own; which of them comes first is open where text and id are equal. Fewer rows than shards leave some empty;
    an empty table gives no rows. `keep` must not name size, shard or slot.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    lowest = -(1 << 63)
    rows = docs.select(
        *keep,
        F.xxhash64(text).alias(KEY[0]),
        F.coalesce(F.col(id_column).cast("long"), F.lit(lowest)).alias(KEY[1]),
        F.monotonically_increasing_id().alias(KEY[2]),
        (F.octet_length(text) + 16).cast("long").alias("size"),
    )
    names = rows.columns[: -len(KEY) - 1]
    rows = stored(rows, "sizes")
    total, number, *ends = rows.agg(F.sum("size"), F.count("*"), *[f(c) for c in KEY for f in (F.min, F.max)]).first()
    ends = [x - lowest for x in ends] if number else [0] * 6
    each = max(1, -(-number // count // RANGE_ROWS))
    bounds = boundaries(rows, total, ends[::2], ends[1::2], count * each, each, tolerance) if number else [END] * (count - 1)
    below = bytes_below(rows, bounds)[1] if number and bounds else np.zeros(len(bounds), np.int64)
    starts = np.concatenate(([0], below))
    first = starts - starts[np.arange(len(starts)) // each * each]  # rows of the same shard in earlier ranges
    sent = rows.sparkSession.sparkContext.broadcast((packed_keys([b for b in bounds if b < END]), first))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, start = sent.value
        for batch in batches:
            part = np.searchsorted(edges, row_keys(batch), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(start[part])], [*batch.schema.names, "_range", "_first"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.mapInArrow(work, f"{kinds}, _range long, _first long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*KEY))
    return dealt.select(
        *names, "size", F.expr(f"cast(_range div {each} as int)").alias("shard"), (F.col("_first") + place - 1).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, count: int, **options) -> None:
    """Write whole documents to one folder per shard, in slot order inside each file."""
    dealt = shards(docs, count, [c for c in docs.columns if c not in ("size", "shard", "slot")], **options)
    dealt.repartition("shard", F.expr(f"slot div {RANGE_ROWS}")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
