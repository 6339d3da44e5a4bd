"""Hard-negative mining with Kronecker-packed products.

Components are integers. Several candidates' components are made non-negative by a bias and put side by side into the fields
of one wide integer; one multiplication by an anchor's component serves all of them, and the sum over the components holds,
field by field, the candidates' exact inner products, from which the bias is taken out again. Arithmetic is modulo 2 ** 64 and
a field is as wide as the largest possible product, so nothing is rounded and no field runs into the next one.

Anchors are the stated query set. They are sent out in chunks of a bounded size; every chunk meets all rows twice: once for
its positives, once for the negatives between the two bounds that each positive's score sets. A task keeps, for each anchor,
only the few best rows it has seen, so what is shuffled does not depend on the number of rows, groups or ties.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import shared_folder, stored

#: Bytes of anchors that are sent to every executor at once.
ANCHOR_BYTES = 16 << 20
#: Candidates and anchors of one packed product.
ROWS, ANCHORS = 4096, 64
#: Rows of a task, unless that leaves cores without work.
TASK_ROWS = 65_536
#: Squared length from which a row takes no part: its scores need not fit 64 bits.
MOST_SQUARED = float(1 << 61)
NONE = np.iinfo(np.int64).min


class Packing(NamedTuple):
    """The layout of the wide integers: `fields` of `width` bits; no inner product exceeds `largest` either way."""

    largest: int
    bias: int
    width: int
    fields: int

    @classmethod
    def of(cls, squared: int, component: int) -> Packing:
        """For rows of at most this squared length, which bounds all products, and components of at most this size."""
        width = (2 * max(1, squared)).bit_length()
        return cls(max(1, squared), component, width, max(1, 64 // width))

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """(component, word): row k * words + w lies in field k of word w."""
        words = -(-len(rows) // self.fields)
        biased = np.zeros((self.fields * words, rows.shape[1]), np.uint64)
        biased[: len(rows)] = (rows + self.bias).astype(np.uint64)
        packed = np.zeros((words, rows.shape[1]), np.uint64)
        for k, part in enumerate(biased.reshape(self.fields, words, -1)):
            packed |= part << np.uint64(k * self.width)
        return packed

    def products(self, anchors: np.ndarray, packed: np.ndarray, rows: int) -> np.ndarray:
        """The exact inner products of every anchor and row."""
        sums = np.einsum("ac,wc->aw", anchors.view(np.uint64), packed)
        ones = np.uint64(sum(1 << (k * self.width) for k in range(self.fields)))
        # Every field holds a product plus bias * sum(anchor); shifted by `largest`, it is never negative.
        surplus = (self.bias * anchors.sum(axis=1) - self.largest).view(np.uint64)
        sums -= (surplus * ones)[:, None]
        if self.fields == 1:
            return sums.view(np.int64)[:, :rows] - self.largest
        mask = np.uint64((1 << self.width) - 1)
        fields = [(sums >> np.uint64(k * self.width)) & mask for k in range(self.fields)]
        return np.hstack(fields)[:, :rows].view(np.int64) - self.largest


class Best:
    """The `count` best (score, id) of every slot; higher scores first, then smaller ids."""

    def __init__(self, slots: int, count: int):
        self.score = np.full((slots, count), NONE)
        self.id = np.zeros((slots, count), np.int64)

    def worst(self) -> np.ndarray:
        """The score that a further row must reach, at least."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        count = self.score.shape[1]
        seen = np.unique(slot)
        held, at = np.nonzero(self.score[seen] != NONE)
        held = seen[held]
        slot = np.concatenate((slot, held))
        score = np.concatenate((score, self.score[held, at]))
        ids = np.concatenate((ids, self.id[held, at]))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        nth = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = nth < count
        self.score[slot[keep], nth[keep]], self.id[slot[keep], nth[keep]] = score[keep], ids[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, at = np.nonzero(self.score != NONE)
        return slot, self.score[slot, at], self.id[slot, at]


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as rows of `width` int64, filled up with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


class Chunk(NamedTuple):
    """Some anchors, and the score bounds of their negatives: `low` and `high`, one column a positive."""

    id: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _scan(rows: DataFrame, chunk, packing: Packing, count: int, negatives: bool) -> DataFrame:
    """(slot, score, id): the best rows of every slot that a task has seen; a slot is an anchor, or one of its positives."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Chunk = chunk.value
        each = own.low.shape[1]
        best = Best(len(own.id) * (each if negatives else 1), count)

        def meet(table: pa.Table) -> None:
            ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
            packed = packing.pack(matrix(table.column("v"), own.vector.shape[1]))
            for at in range(0, len(own.id), ANCHORS):
                part = slice(at, at + ANCHORS)
                scores = packing.products(own.vector[part], packed, len(ids))
                same = own.label[part, None] == labels[None, :]
                if not negatives:
                    hit = same & (own.id[part, None] != ids[None, :]) & (scores >= best.worst()[part, None])
                    row, column = np.nonzero(hit)
                    best.add(row + at, scores[row, column], ids[column])
                    continue
                worst = best.worst().reshape(-1, each)[part]
                low = np.maximum(own.low[part], worst)
                row, column = np.nonzero(~same & (scores >= low.min(axis=1)[:, None]) & (scores <= own.high[part].max(axis=1)[:, None]))
                found = scores[row, column]
                for k in range(each):
                    fits = (found >= low[row, k]) & (found <= own.high[part][row, k])
                    best.add((row[fits] + at) * each + k, found[fits], ids[column[fits]])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at in range(0, table.num_rows, ROWS):
                meet(table.slice(at, ROWS))
        yield pa.record_batch([pa.array(x) for x in best.rows()], ["slot", "score", "id"])

    return rows.mapInArrow(work, "slot long, score long, id long")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def integer_rows(vectors: DataFrame, is_anchor: Column, label: Column, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(id, label, v array<int>, asks): one usable row of every id."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"), finite.alias("finite"),
    )
    rows = rows.where("id is not null and label is not null and v is not null and finite")
    squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.where(squared < MOST_SQUARED).select("id", F.struct("label", F.col("v").cast("array<int>").alias("v"), "asks").alias("row"))
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, count: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact, over all rows.

    Positives of an anchor are its nearest `positives` other rows of its label; negatives of a positive the nearest `count`
    rows of other labels whose score is from `low` to `high` per cent of the positive's. Higher scores come first, then
    smaller ids. Scores are inner products of floor(scale * component); of vectors of unequal length, over the components that
    both have. Rows without an id, label or vector, with a null or non-finite component, or of a squared length of 2 ** 61 and
    more after scaling take no part. Rows of one id are one: the least label, then the least vector. Zero and empty vectors
    score 0. Anchors without positives, and positives without negatives, give no row; an empty table gives none.
    """
    spark = vectors.sparkSession
    total, cores = vectors.count(), spark.sparkContext.defaultParallelism
    tasks = max(1, -(-total // TASK_ROWS), min(2 * cores, total // 1024))
    rows = stored(integer_rows(vectors, is_anchor, label, scale, id_column, vector_column).repartition(tasks), "integers")
    squared = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
    size = F.array_max(F.transform("v", F.abs))
    longest, most, component, anchors = rows.agg(F.max(F.size("v")), F.max(squared), F.max(size), F.count_if("asks")).first()
    packing = Packing.of(most or 0, component or 0)
    width = max(1, longest or 0)
    chunks = max(1, -(-anchors * (width + 2 * positives + 2) * 8 // ANCHOR_BYTES))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    folder, paths = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}", []
    for k in range(chunks if anchors else 0):
        chosen = rows.where(F.col("asks") & (F.pmod(F.xxhash64("id"), F.lit(chunks)) == k)).toArrow()
        own = Chunk(
            chosen.column("id").to_numpy(), chosen.column("label").to_numpy(), matrix(chosen.column("v"), width),
            np.full((chosen.num_rows, positives), np.iinfo(np.int64).max), np.full((chosen.num_rows, positives), NONE),
        )
        sent = spark.sparkContext.broadcast(own)
        near = _ranked(_scan(rows, sent, packing, positives, False), positives).toArrow()  # a few rows for each anchor sent
        slot, nth, score = (near.column(c).to_numpy() for c in ("slot", "rank", "score"))
        positive = np.zeros((2, *own.low.shape), np.int64)
        positive[:, slot, nth - 1] = near.column("id").to_numpy(), score
        own.high[slot, nth - 1] = [high * int(s) // 100 for s in score]
        own.low[slot, nth - 1] = [-(-low * int(s) // 100) for s in score]
        names = spark.createDataFrame(
            pa.table({
                "slot": pa.array(slot * positives + nth - 1), "anchor_id": pa.array(own.id[slot]),
                "positive_id": near.column("id"), "positive_score": near.column("score"),
            })
        )
        bounded = spark.sparkContext.broadcast(own)
        found = _ranked(_scan(rows, bounded, packing, count, True), count).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        named = found.join(F.broadcast(names), "slot").select(*[c.split()[0] for c in schema.split(", ")])
        paths.append(f"{folder}/{k}")
        named.write.parquet(paths[-1])
        sent.destroy()
        bounded.destroy()
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
