"""Removal of byte strings that also start in an earlier document, by depth-limited radix passes over suffixes.

Only the first `length` bytes of a suffix matter, its window. Equal windows agree on any digit that is a function of their
bytes, so the passes take the most selective digit first. Digit 1 is the window's anchor, its k-gram of least hash: windows
that follow each other mostly share it, so a run of them is one record. Digit 2 is everything around the anchor that its
windows reach. Records equal in both digits are equal windows, all but those of the least document are repeats. Records
equal in digit 1 alone go through the last passes, window by window, on their bytes. A group that only one document has left
at any pass is over. What is equal after the last pass are exactly the repeated windows.

Records travel packed, as columns of bytes in one row for each batch and bucket. Equal records of a batch are settled there,
so a passage that many documents share is a record per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

LENGTH = 50
GRAM = 20
#: Bytes of text whose anchors are found at once, anchors that are packed together, and bytes of text behind a bucket.
PART_BYTES, PACKED, BUCKET_BYTES = 1 << 20, 600_000, 16 << 20
#: Records of an anchor that are compared in one task; beyond, their windows are grouped by Spark.
GROUP_ROWS = 4096
SEED = 13
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
COVERED, OPEN = 1, 2


def _bytes_table(which: int) -> np.ndarray:
    """64 random bits for each byte, odd."""
    return np.random.default_rng(SEED + which).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Sums:
    """Hashes of any substrings of a buffer from its running sums."""

    def __init__(self, buffer: np.ndarray, which: int):
        power = np.full(len(buffer) + 1, BASE)
        power[0] = 1
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_bytes_table(which)[buffer] * np.cumprod(power)[:-1], out=self.sums[1:])
        power[1:] = BASE_INVERSE
        self.back = np.cumprod(power)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def find_anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor, first window, windows, digit 1, digit 2) of the runs of windows that share an anchor."""
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    sums = Sums(buffer, 0)
    grams = np.arange(max(0, len(buffer) - gram + 1))
    order = mixed(sums(grams, grams + gram))
    at, reach, width = grams, 1, length - gram + 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(order[right] < order[left], right, left)
        reach += step
    windows = np.arange(len(at))
    own = np.searchsorted(ends, windows, side="right")
    inside = windows + length <= ends[np.minimum(own, len(ends) - 1)]
    windows, at, own = windows[inside], at[inside], own[inside]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (own[1:] != own[:-1])))) if len(at) else windows
    count = np.diff(np.append(first, len(at)))
    anchor, own, window = at[first], own[first], windows[first]
    low, high = np.maximum(anchor - (length - gram), starts[own]), np.minimum(anchor + length, ends[own])
    around = mixed(Sums(buffer, 1)(low, high)) ^ mixed((anchor - low).astype(np.uint64) + np.uint64(1))
    return own, anchor - starts[own], window - starts[own], count, mixed(order[anchor] + np.uint64(7)), around


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte of all: equal high bytes stand together and compress."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(value: bytes, dtype=np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view(dtype).ravel()


def place(anchor: np.ndarray, window: np.ndarray, count: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Anchor, the windows' first start before it, their number and the row's tag in one number."""
    return ((anchor << 32) | (tag << 12) | ((anchor - window) << 6) | count).astype(np.int64)


def placed(value: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first window, windows, tag)"""
    anchor = value >> 32
    return anchor, anchor - ((value >> 6) & 63), value & 63, (value >> 12) & 0xFFFFF


def _record_stage(buckets: int, length: int, gram: int):
    names = ["bucket", "settled", "digit", "around", "doc", "place"]

    def row(bucket: int, settled: bool, *columns: np.ndarray) -> list:
        return [bucket, settled, *[pack(x) for x in columns]]

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, digit, around, where = (np.concatenate([x[k] for x in held]) for k in range(4))
        order = np.lexsort((doc, around, digit))
        doc, digit, around, where = doc[order], digit[order], around[order], where[order]
        same = np.concatenate(([False], (digit[1:] == digit[:-1]) & (around[1:] == around[:-1])))
        least = doc[np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))]
        settled = same & (doc > least)
        rows = [row(int(doc[settled][0]) % buckets, True, np.empty(0, np.uint64), np.empty(0, np.uint64), doc[settled], where[settled])] if settled.any() else []
        doc, digit, around, where = (x[~settled] for x in (doc, digit, around, where))
        bucket = (digit >> np.uint64(40)).astype(np.int64) * buckets >> 24
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows += [row(b, False, *(x[cuts[b] : cuts[b + 1]] for x in (digit, around, doc, where))) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
        return pa.record_batch([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for batch in batches:
            docs, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            start, size = 0, 0
            texts: list[bytes] = []
            for k, value in enumerate(batch.column(2)):
                texts.append(value.as_py())
                size += len(texts[-1])
                if size >= PART_BYTES or k == batch.num_rows - 1:
                    own, anchor, window, count, digit, around = find_anchors(texts, length, gram)
                    where = place(anchor, window, count, tags[start:][own])
                    held.append((docs[start:][own], digit & np.uint64(0xFFFFFFFFFFFF0000), around, where))
                    waiting += len(own)
                    start, size, texts = k + 1, 0, []
                    if waiting >= PACKED:
                        yield packed(held)
                        held, waiting = [], 0
        if waiting:
            yield packed(held)

    return work


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets: what digit 2 settles, and what digit 1 leaves open. A task may hold some buckets."""
    buckets: dict[int, list[tuple[np.ndarray, ...]]] = {}

    def out(doc: np.ndarray, where: np.ndarray, kind: int) -> pa.RecordBatch:
        return pa.record_batch([pa.array(doc), pa.array(where), pa.array(np.full(len(doc), kind, np.int32))], ["doc", "place", "kind"])

    for batch in batches:
        for bucket, settled, digit, around, doc, where in zip(*[batch.column(k).to_pylist() for k in range(6)], strict=True):
            if settled:
                yield out(unpack(doc), unpack(where), COVERED)
            else:
                buckets.setdefault(bucket, []).append((unpack(digit, np.uint64), unpack(around, np.uint64), unpack(doc), unpack(where)))
    for parts in buckets.values():
        digit, around, doc, where = (np.concatenate([x[k] for x in parts]) for k in range(4))
        parts.clear()
        order = np.lexsort((doc, around, digit))
        digit, around, doc, where = digit[order], around[order], doc[order], where[order]
        fresh = np.concatenate(([True], digit[1:] != digit[:-1]))
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        shared = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first))[group]
        other = fresh | np.concatenate(([True], around[1:] != around[:-1]))
        kinds = np.add.reduceat(other.astype(np.int64), first)[group]
        least = doc[np.maximum.accumulate(np.where(other, np.arange(len(doc)), 0))]
        covered = shared & (doc > least)
        opened = shared & (kinds > 1) & ~covered
        yield out(doc[covered], where[covered], COVERED)
        yield out(doc[opened], where[opened], OPEN)


def _context_stage(length: int, gram: int):
    names = ["gram", "doc", "tag", "start", "bytes"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes that the windows of each open record reach, with its anchor's k-gram."""
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows: list[tuple] = []
                for doc, tag, text, places in zip(*[x.to_pylist() for x in batch.slice(at, 64).columns], strict=True):
                    raw = text.encode()
                    anchors, windows, counts, _ = (x.tolist() for x in placed(np.array(places, np.int64)))
                    rows += [(raw[a : a + gram], doc, tag, w, raw[w : w + n - 1 + length]) for a, w, n in zip(anchors, windows, counts, strict=True)]
                kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.record_batch([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)], names)

    return work


def _windows(rows: list[tuple], length: int) -> tuple[np.ndarray, ...]:
    """(d1, d2, doc, tag, start) of all windows of records (gram, doc, tag, start, bytes)."""
    sizes = np.array([len(r[4]) for r in rows])
    buffer = np.frombuffer(b"".join([r[4] for r in rows]), np.uint8)
    counts = sizes - length + 1
    own = np.repeat(np.arange(len(rows)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(sizes) - sizes)[own] + nth
    doc, tag, start = (np.array([r[k] for r in rows], np.int64)[own] for k in (1, 2, 3))
    return *[mixed(Sums(buffer, k)(at, at + length)).view(np.int64) for k in (2, 3)], doc, tag, start + nth


def _compare_stage(length: int, large_groups: bool):
    """Either the repeated runs that groups compared in one task have, or the windows of the groups too large for that."""
    names = ["doc", "tag", "start", "end", *["d1", "d2"][: 2 * large_groups]]

    def out(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray, *digits: np.ndarray) -> pa.RecordBatch:
        columns = [doc, *[x.astype(np.int32) for x in (tag, start, end)], *digits]
        return pa.record_batch([pa.array(x) for x in columns], names)

    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if large_groups:
            return
        d1, d2, doc, tag, start = _windows(rows, length)
        order = np.lexsort((doc, d2, d1))
        d1, d2, doc, tag, start = (x[order] for x in (d1, d2, doc, tag, start))
        fresh = np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
        found = doc > doc[np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))]
        doc, tag, start = doc[found], tag[found], start[found]
        order = np.lexsort((start, tag, doc))
        doc, tag, start = doc[order], tag[order], start[order]
        new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + 1)))) if len(doc) else np.empty(0, np.int64)
        last = np.append(new[1:], len(doc)) - 1 if len(doc) else new
        yield out(doc[new], tag[new], start[new], start[last] + length)

    def spelled(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows) if large_groups else 0, GROUP_ROWS):
            d1, d2, doc, tag, start = _windows(rows[at : at + GROUP_ROWS], length)
            yield out(doc, tag, start, start + length, d1, d2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by k-gram. Whole groups are compared together; the windows of a large group are spelled out."""
        held: list[tuple] = []
        large = None
        for batch in batches:
            rows = list(zip(*[x.to_pylist() for x in batch.columns], strict=True))
            if large is not None:
                n = next((k for k, r in enumerate(rows) if r[0] != large), len(rows))
                yield from spelled(rows[:n])
                rows = rows[n:]
            held += rows
            if len(held) >= 4 * GROUP_ROWS:
                n = next((k for k in range(len(held), 0, -1) if held[k - 1][0] != held[-1][0]), 0)
                if n:
                    yield from solved(held[:n])
                held = held[n:]
                if len(held) > GROUP_ROWS:
                    large = held[-1][0]
                    yield from spelled(held)
                    held = []
        if held:
            yield from solved(held)

    return work


def _remove_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            kept, removed, spans = [], [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist(), strict=True):
                raw, pieces, end, gone, runs = (text or "").encode(), [], 0, 0, 0
                for x in sorted((x["start"], x["end"]) for x in found or ()):
                    if x[0] > end or not runs:
                        pieces.append(raw[end : x[0]])
                        gone, runs, end = gone + x[1] - x[0], runs + 1, x[1]
                    elif x[1] > end:
                        gone, end = gone + x[1] - end, x[1]
                kept.append(b"".join([*pieces, raw[end:]]))
                removed.append(gone)
                spans.append(runs)
            yield pa.record_batch([part.column("doc"), pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept) of every row: its text as UTF-8 without the bytes that a string of `length`
    bytes covers which also starts in a document with a smaller id; n_spans counts the maximal removed runs.

    A null text is empty. Rows with a null id lose nothing and make no other row lose anything. Rows that repeat an id are
    separate texts of that id and do not count as smaller than each other. Other columns are not read.
    """
    if not 8 <= gram < length or length - gram > 62:
        raise ValueError("gram must be at least 8 and up to 62 less than the length")
    text = F.coalesce(F.col(text_column), F.lit(""))
    plain = docs.select(F.col(id_column).cast("long").alias("doc"), text.alias("text"))
    total, repeated = plain.agg(F.sum(F.octet_length("text")), F.count("doc") - F.count_distinct("doc")).first()
    tag = (F.xxhash64("text").bitwiseAND(F.lit(0xFFFFF)) if repeated else F.lit(0)).cast("int")
    rows = plain.select("doc", tag.alias("tag"), "text")
    buckets = max(8, -(-(total or 0) // BUCKET_BYTES))

    long_enough = rows.where(F.col("doc").isNotNull() & (F.octet_length("text") >= length)).select("doc", "tag", F.col("text").cast("binary").alias("text"))
    records = long_enough.mapInArrow(_record_stage(buckets, length, gram), "bucket int, settled boolean, digit binary, around binary, doc binary, place binary")
    marked = stored(records.repartition(buckets, "bucket").mapInArrow(_settle, "doc long, place long, kind int"), "suffixes")
    parts = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    marked = marked.select("doc", "place", "kind", F.shiftright(parts, 12).cast("int").alias("tag"))

    # The texts are dealt out once, and so are the records' bytes: Spark reuses these exchanges below.
    row = F.struct("doc", "tag").cast("struct<doc:bigint,tag:int>").alias("row")  # one type on both sides of the joins
    texts = rows.select(row, "text").repartition(buckets, "row")
    opened = marked.where(F.col("kind") == OPEN).groupBy(row).agg(F.collect_list("place").alias("places"))
    reach = texts.join(opened.hint("merge"), "row").select("row.doc", "row.tag", "text", "places").mapInArrow(_context_stage(length, gram), "gram binary, doc long, tag int, start int, bytes binary")
    reach = reach.repartition(buckets, "gram").sortWithinPartitions("gram")
    compared = reach.mapInArrow(_compare_stage(length, False), "doc long, tag int, start int, end int")
    windows = reach.mapInArrow(_compare_stage(length, True), "doc long, tag int, start int, end int, d1 long, d2 long")
    least = windows.groupBy("d1", "d2").agg(F.min("doc").alias("least"))
    large = windows.join(least, ["d1", "d2"]).where("doc > least").select("doc", "tag", "start", "end")
    first = (F.shiftright("place", 32) - F.shiftright("place", 6).bitwiseAND(F.lit(63))).cast("int")
    last = first + F.col("place").bitwiseAND(F.lit(63)).cast("int") - 1 + length
    covered = marked.where(F.col("kind") == COVERED).select("doc", "tag", first.alias("start"), last.alias("end"))
    spans = covered.unionByName(compared).unionByName(large)
    found = spans.groupBy(row).agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = texts.join(found.hint("merge"), "row", "left").select("row.doc", "text", "found")
    return joined.mapInArrow(_remove_stage, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
