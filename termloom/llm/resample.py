"""Target-distribution importance resampling: array-scored weights, ranks by a distributed LSD radix sort.

Every document's features are hashed into buckets. An array of gains, one for each bucket, compares how often the target's
texts and the corpus use it; a document's weight is the mean gain of its features, and seeded Gumbel noise turns weights into
a draw without replacement: the highest scores are drawn. Scores are ranked by stable counting-sort passes over the digits of
(score, id), from the least digit on. Rows lie in blocks of positions; a pass counts the digits of every block, turns the
counts into global prefix offsets and sends each row to its destination, which names its next block. No block holds more than
a fixed number of rows, whatever keys repeat, and no task sees more than one block at a time.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, text_batches

#: Digits of a sorting pass, and rows of a block.
DIGIT_BITS = 11
BLOCK_BITS = 17
#: Bytes of a text whose words are held at once.
PART_BYTES = 1 << 20
#: Bytes of words stay, A-Z in lower case; all other bytes separate words.
WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def feature_parts(text: bytes, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of features) of one part of a text after the other; a feature is a run of 1 to `longest` words."""
    clean, at, held = text.translate(WORD_BYTES), 0, []
    while at < len(clean):
        end = at + PART_BYTES
        if end < len(clean):
            cut = clean.rfind(b" ", at, end)
            cut = cut if cut > at else clean.find(b" ", end)
            end = cut if cut > 0 else len(clean)
        words = clean[at:end].split()
        both = held + words
        hashes = list(map(zlib.crc32, words))
        for n in range(2, longest + 1):
            first = max(0, len(held) - n + 1)
            hashes += [zlib.crc32(b" ".join(both[k : k + n])) for k in range(first, len(both) - n + 1)]
        yield len(words), np.array(hashes, np.uint32) % buckets
        held, at = both[max(0, len(both) - longest + 1) :] if longest > 1 else [], end


def bucket_counts(texts: DataFrame, text_column: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: one array per task, added up by Spark."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for _, found in feature_parts(text.as_py() or b"", longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["bucket", "n"])

    counted = texts.select(text_column).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for row in counted.collect():  # one row a bucket
        total[row.bucket] = row.n
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Thousandths of Gumbel noise from a seeded hash of an id, rounded down; a null id is hashed as an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, longest: int, seed: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n_features, weight, score, n_words) of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((4, batch.num_rows), np.int64)
            ids = batch.column(0).to_pylist()
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                n_words = n_features = total = 0
                for words, found in feature_parts(text.as_py() or b"", longest, len(gains)):
                    n_words, n_features, total = n_words + words, n_features + len(found), total + int(gains[found].sum())
                weight = total // n_features if n_features else 0
                out[:, k] = n_features, weight, weight + noise(seed, ids[k]), n_words
            yield pa.record_batch([batch.column(0), *map(pa.array, out)], ["doc_id", "n_features", "weight", "score", "n_words"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_features long, weight long, score long, n_words long")


class Digit(NamedTuple):
    """One pass: some bits of a key column, counted upwards from `base` (downwards if `falling`).

    Without a shift: 0 for a value, 1 for none.
    """

    column: str
    base: int = 0
    falling: bool = False
    shift: int | None = None

    def of(self, table: pa.Table) -> np.ndarray:
        column = table.column(self.column).combine_chunks()
        if self.shift is None:
            return column.is_null().to_numpy(zero_copy_only=False).astype(np.int32)
        values = column.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        base = np.int64(self.base).view(np.uint64)
        far = base - values if self.falling else values - base  # modulo 2 ** 64, so no range is too wide
        return ((far >> np.uint64(self.shift)) & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int32)


def passes_of(column: str, least: int, most: int, nulls: int = 0, falling: bool = False) -> list[Digit]:
    """The digits that tell the values of a column apart, least first; rows without a value come last."""
    bits = max(1, (most - least).bit_length())
    digits = [Digit(column, most if falling else least, falling, shift) for shift in range(0, bits, DIGIT_BITS)]
    return [*digits, Digit(column)] if nulls else digits


def _placed(rows: DataFrame, digit: Digit) -> DataFrame:
    """The rows with a position, in no order yet, and their first digit."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits = pa.array(digit.of(pa.Table.from_batches([batch])))
            yield pa.RecordBatch.from_arrays([*batch.columns, digits], [*batch.schema.names, "_digit"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.withColumn("_place", F.monotonically_increasing_id()).mapInArrow(work, f"{kinds}, _place long, _digit int")


def _moved(follow: Digit | None):
    """Counting sort of a block: rows in order of position, then to their digit's offset."""
    def work(rows: pa.Table, offsets: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("_place").to_numpy(), kind="stable")))
        digits = rows.column("_digit").to_numpy()
        order = np.argsort(digits, kind="stable")
        counts = np.bincount(digits, minlength=1 << DIGIT_BITS)
        nth = np.empty(len(digits), np.int64)
        nth[order] = np.arange(len(digits)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = np.zeros(1 << DIGIT_BITS, np.int64)
        start[offsets.column("_digit").to_numpy()] = offsets.column("_start").to_numpy()
        place = start[digits] + nth
        after = follow.of(rows) if follow else np.zeros(len(place), np.int32)
        kept = [name for name in rows.column_names if name not in ("_block", "_place", "_digit")]
        return pa.table([*[rows.column(name) for name in kept], pa.array(place), pa.array(after)], [*kept, "_place", "_digit"])

    return work


def radix_sorted(rows: DataFrame, digits: list[Digit]) -> DataFrame:
    """The rows with `_place`, their 0-based rank by the digits, the least significant first; equal rows in any order.

    Every pass is two tables in the shared folder: the counts of (block, digit), and the rows at their destinations.
    """
    spark, block = rows.sparkSession, F.shiftright("_place", BLOCK_BITS).alias("_block")
    now = stored(_placed(rows, digits[0]), "radix")
    for k, follow in enumerate([*digits[1:], None]):
        counts = stored(now.groupBy(block, "_digit").agg(F.count("*").alias("n")), "radix-counts")
        totals = {r["_digit"]: r.n for r in counts.groupBy("_digit").agg(F.sum("n").alias("n")).collect()}  # one row a digit
        bases, below = {}, 0
        for digit in sorted(totals):
            bases[digit], below = below, below + totals[digit]
        if not bases:
            break
        firsts = F.broadcast(spark.createDataFrame(list(bases.items()), "_digit int, base long"))
        earlier = F.sum("n").over(Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select("_block", "_digit", F.coalesce(earlier, F.lit(0)).alias("earlier")).join(firsts, "_digit")
        offsets = offsets.select("_block", "_digit", (F.col("base") + F.col("earlier")).alias("_start"))
        moved = now.withColumn("_block", block).groupBy("_block").cogroup(offsets.groupBy("_block")).applyInArrow(_moved(follow), now.schema)
        now = stored(moved, f"radix-{k}")
    return now.drop("_digit")


def resample(
    docs: DataFrame, target: DataFrame, part: float = 0.1, least_words: int = 20, longest: int = 1, buckets: int = 10_000,
    seed: int = 2024, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; the drawn ones have a rank, from 1.

    Of the rows with at least `least_words` words the share `part` (rounded down) with the highest scores is drawn; ties go to
    the smaller id, null ids last. Null and empty texts have no features, weight 0 and are never drawn for `least_words` > 0.
    Repeated rows each count and each may be drawn; an empty target or corpus counts as zeros. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    corpus, wanted = bucket_counts(docs, text_column, longest, buckets), bucket_counts(target, target_column, longest, buckets)
    rows = stored(scored(docs, bucket_gains(corpus, wanted), longest, seed, id_column, text_column), "scored")
    able = F.col("n_words") >= least_words
    rest = rows.where(~able).drop("n_words").withColumn("rank", F.lit(None).cast("long"))
    rows = rows.where(able).drop("n_words")
    facts = rows.agg(
        F.count("*"), F.count("doc_id"), *[f(c) for c in ("doc_id", "score") for f in (F.min, F.max)]
    ).first()
    total, with_id, *ends = facts
    if not total:
        return rest
    ids = passes_of("doc_id", ends[0], ends[1], total - with_id) if with_id else []
    ranked = radix_sorted(rows, [*ids, *passes_of("score", ends[2], ends[3], falling=True)])
    place = F.col("_place")
    drawn = ranked.withColumn("rank", F.when(place < int(Decimal(str(part)) * total), place + 1)).drop("_place")
    return drawn.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents whose id is drawn; options as in :func:`resample`. All rows of a drawn id are kept."""
    id_column = options.get("id_column", "doc_id")
    ranks = resample(docs, target, **options).where("rank is not null").select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(ranks, id_column, "left_semi").select(*docs.columns)
