"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Cosines of random projections approximate a Gaussian kernel over some twenty statistics of a text. Every partition adds up
its part of the normal equations, one set for each fold of the labelled rows; the driver solves the small sums. Scores of
rows outside the folds they were fitted on are calibrated by isotonic regression over a fixed grid of raw scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_batches

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "spread_word", "longest_word", "upper", "digit", "punctuation", "symbol",
    "space", "line_end", "beyond_ascii", "distinct_words", "top_word", "repeated_next", "symbol_words", "upper_words",
    "words_per_line", "distinct_lines", "short_lines", "bar_words", "ends_well",
)
FEATURES = 256
FOLDS = 4
#: Raw scores are calibrated on a grid of so many steps per unit, from -1 to 2.
GRID = 512
SEED = 20_24
#: Parts into which a sum is cut, each added up by itself.
SLICES = 64


def _class_of_byte() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    for kind, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"#$%&*|!@^~<>{}[]\\/+=_`", b" \t\r\x0b\x0c", b"\n"), 1):
        kinds[list(members)] = kind
    kinds[128:] = 7
    return kinds


CLASS_OF_BYTE = _class_of_byte()
SYMBOL_ENDS = frozenset("#$%&*|!@^~<>{}[]\\/+=_`")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; a null is an empty text, for which all are 0."""
    raw = (text or "").encode()
    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(CLASS_OF_BYTE, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=8) / len(raw)
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    n, mean = len(words), float(lengths.mean())
    distinct: dict[str, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    lines = [x for x in text.split("\n") if x]
    return [
        math.log1p(len(raw)), math.log1p(n), mean, float(lengths.std()), math.log1p(float(lengths.max())),
        kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7],
        len(distinct) / n, max(distinct.values()) / n, sum(map(eq, words, words[1:])) / n,
        sum(c for w, c in distinct.items() if w[-1] in SYMBOL_ENDS) / n,
        sum(c for w, c in distinct.items() if len(w) > 1 and w.isupper()) / n,
        math.log1p(n / max(1, len(lines))), len(set(lines)) / max(1, len(lines)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        distinct.get("|", 0) / n, float(text.rstrip()[-1] in ".?"),
    ]


def _table(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(x.as_py()) for x in texts], np.float64).reshape(-1, len(STATISTICS))


def with_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, one double column per statistic) of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _table(batch.column(1))
            yield pa.record_batch([batch.column(0), *[pa.array(x) for x in found.T]], ["id", *STATISTICS])

    text_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), text_column).mapInArrow(work, ", ".join([f"id {kind}", *[f"{x} double" for x in STATISTICS]]))


class Model(NamedTuple):
    """weights: FEATURES + 1 (the last is the constant) by the folds that were left out, and at last of all rows."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, table: np.ndarray) -> np.ndarray:
        scaled = np.clip((table - self.mean) / self.spread, -8, 8)
        waves = np.cos(scaled @ self.directions + self.phases) * math.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(table), 1))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.steps, self.levels)

    def scores(self, table: np.ndarray) -> np.ndarray:
        return self.calibrated(self.features(table) @ self.weights[:, -1])


def held_out(id_column: str | Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves this remainder, or the id is null."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def isotonic(counts: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Levels of the pooled neighbours that make the means ascend."""
    blocks: list[list[float]] = []
    for count, mean in zip(counts.tolist(), means.tolist(), strict=True):
        blocks.append([count, mean, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            c, m, k = blocks.pop()
            d = blocks[-1]
            blocks[-1] = [c + d[0], (c * m + d[0] * d[1]) / (c + d[0]), k + d[2]]
    return np.concatenate([np.empty(0), *[np.full(int(k), m) for _, m, k in blocks]])


def fit(marked: DataFrame, ridge: float = 1e-3, width: float = 4.0) -> Model:
    """Fit on rows (the statistics, fold int from 0, label 0/1). Without a row every score is 0.5."""
    means = marked.agg(F.count("*"), *[f(x) for x in STATISTICS for f in (F.avg, F.stddev_pop)]).first()
    random = np.random.default_rng(SEED)
    spread = np.array([x or 0.0 for x in means[2::2]])
    model = Model(
        np.array([x or 0.0 for x in means[1::2]]), np.where(spread > 1e-9, spread, 1.0),
        random.standard_normal((len(STATISTICS), FEATURES)) / width, random.uniform(0, 2 * math.pi, FEATURES),
        np.zeros((FEATURES + 1, FOLDS + 1)), np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )
    if not means[0]:
        return model

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x = model.features(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS]))
            y, fold = batch.column("label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            for k in range(FOLDS):
                own = x[fold == k]
                total[k] += own.T @ np.hstack([own, y[fold == k][:, None]])
        if not total.any():
            return
        cut = [x.tobytes() for x in np.array_split(total.ravel(), SLICES)]
        yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array(cut, pa.binary())], ["slice", "total"])

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # a partition without a slice sends nothing
        for batch in batches:
            for k, value in zip(batch.column("slice").to_pylist(), batch.column("total"), strict=True):
                totals[k] = totals.get(k, 0.0) + np.frombuffer(value.as_buffer(), np.float64)
        yield pa.record_batch([pa.array(list(totals), pa.int32()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["slice", "total"])

    parts = marked.select("fold", F.col("label").cast("double").alias("label"), *STATISTICS).mapInArrow(sums, "slice int, total binary")
    summed = parts.repartition(SLICES, "slice").mapInArrow(sum_up, "slice int, total binary").collect()  # each slice once: the size of one sum
    each = np.concatenate([np.frombuffer(x.total, np.float64) for x in sorted(summed, key=lambda x: x.slice)])
    each = each.reshape(FOLDS, FEATURES + 1, FEATURES + 2)
    penalty = np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9

    def solve(system: np.ndarray) -> np.ndarray:
        return np.linalg.solve(system[:, :-1] + ridge * max(1.0, system[-1, -2]) * penalty, system[:, -1])

    whole = each.sum(axis=0)
    model = model._replace(weights=np.stack([*[solve(whole - x) for x in each], solve(whole)], axis=1))

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.features(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS]))
            raw = (x * model.weights[:, batch.column("fold").to_numpy(zero_copy_only=False)].T).sum(axis=1)
            step = np.rint(np.clip(raw, -1, 2) * GRID).astype(np.int32)
            yield pa.record_batch([pa.array(step), batch.column("label").cast(pa.float64())], ["step", "label"])

    steps = marked.select("fold", "label", *STATISTICS).mapInArrow(outside, "step int, label double")
    found = steps.groupBy("step").agg(F.count("*").alias("n"), F.avg("label").alias("mean")).orderBy("step").collect()  # at most 3 * GRID + 1 rows
    levels = isotonic(np.array([x.n for x in found], float), np.array([x["mean"] for x in found]))
    return model._replace(steps=np.array([x.step for x in found]) / GRID, levels=np.clip(levels, 0.0, 1.0))


def learn(found: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on the labelled rows that are not held out (crc32 of the id as text, modulo 5, is not 0)."""
    marks = labels.where(F.col(label).isNotNull() & ~held_out("doc_id", 5, 0)).select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("label"))
    fold = (F.crc32(F.col("id").cast("string").cast("binary")) % 5 - 1).cast("int")
    return fit(found.join(marks, "id").withColumn("fold", fold))


def score(found: DataFrame, model: Model) -> DataFrame:
    """(id, score) of rows with statistics."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS])
            yield pa.record_batch([batch.column("id"), pa.array(model.scores(table))], ["id", "score"])

    return found.mapInArrow(work, f"id {found.schema['id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows whose score is at least `least`; all columns stay, nothing is shuffled."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(model.scores(_table(batch.column(text_column))) >= least))

    return docs.mapInArrow(work, docs.schema)
