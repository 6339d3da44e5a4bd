"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

Text is cut at blanks into chunks that no token crosses; a worker encodes each chunk that it has not met yet. The words of
new chunks go, by byte length, into padded matrices of ids. In each round every row merges its leftmost pair of least rank;
the rank of a pair comes from a hash table, rows without a pair leave, and the matrix gets one column narrower.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .shared import fresh, kept_by_worker, text_batches

#: Rank of a pair that is no token.
NO_PAIR = np.int32(2**31 - 1)
ID_BITS = 24
EMPTY = np.uint64(2**64 - 1)
#: Words of more bytes are merged one by one from a heap; a matrix would need a round for each of their bytes.
MATRIX_BYTES = 128
#: Text that is encoded at once.
PART_CHARS = 1 << 20
#: About the memory that a worker's remembered chunks and words take; longer ones than LONGEST characters are not remembered.
REMEMBERED_BYTES = 128 << 20
LONGEST = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def pair_table(ranks: dict[bytes, int]) -> dict:
    """What a worker needs: the pairs of tokens that make a token, hashed, and the tokens of all single bytes."""
    pairs = [
        (left << ID_BITS | right, rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
    ]
    found = np.array(pairs, np.int64).reshape(-1, 2)
    keys, values = found[:, 0].astype(np.uint64), found[:, 1].astype(np.int32)
    bits = max(4, int(2 * len(keys) + 1).bit_length())
    table_keys, table_values = np.full(1 << bits, EMPTY), np.full(1 << bits, NO_PAIR)
    at, rest, probes = _slots(keys, bits), np.arange(len(keys)), 0
    while len(rest):
        free = rest[table_keys[at[rest]] == EMPTY]
        table_keys[at[free]] = keys[free]
        table_values[at[free]] = values[free]
        won = table_keys[at[rest]] == keys[rest]
        table_values[at[rest[won]]] = values[rest[won]]
        rest = rest[~won]
        at[rest] = (at[rest] + 1) & ((1 << bits) - 1)
        probes += 1
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return {"keys": table_keys, "values": table_values, "bits": bits, "probes": probes, "single": single, "ranks": ranks}


def pair_ranks(table: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair of ids; a negative id (padding) is in no pair."""
    out = np.full(left.shape, NO_PAIR)
    real = np.flatnonzero((left >= 0) & (right >= 0))
    if not len(real):
        return out
    keys = (left.flat[real].astype(np.uint64) << np.uint64(ID_BITS)) | right.flat[real].astype(np.uint64)
    at = _slots(keys, table["bits"])
    for _ in range(table["probes"]):
        there = table["keys"][at]
        hit = there == keys
        out.flat[real[hit]] = table["values"][at[hit]]
        going = ~hit & (there != EMPTY)
        if not going.any():
            break
        real, keys, at = real[going], keys[going], (at[going] + 1) & ((1 << table["bits"]) - 1)
    return out


def merge_matrix(table: dict, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(word, ids) for words of similar length."""
    width = max(map(len, words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join([word.ljust(width, b"\0") for word in words]), np.uint8).reshape(len(words), width)
    ids = np.where(np.arange(width) < lengths[:, None], table["single"][raw], np.int32(-1))
    ranks = pair_ranks(table, ids[:, :-1], ids[:, 1:])
    rows = np.arange(len(words))
    while len(rows):
        n, width = ids.shape
        each = np.arange(n)
        at = ranks.argmin(axis=1) if width > 1 else np.zeros(n, np.int64)
        best = ranks[each, at] if width > 1 else np.full(n, NO_PAIR)
        over = best == NO_PAIR
        if over.any():
            real = ids[over] >= 0
            flat = ids[over][real].astype("<u4").tobytes()
            ends = (4 * np.cumsum(real.sum(axis=1))).tolist()
            for row, start, end in zip(rows[over].tolist(), [0, *ends], ends, strict=False):
                yield words[row], flat[start:end]
            rows, ids, ranks, at, best = rows[~over], ids[~over], ranks[~over], at[~over], best[~over]
            n, each = len(rows), each[: len(rows)]
            if not n:
                break
        ids[each, at] = best
        kept = np.arange(width - 1)
        ids = np.take_along_axis(ids, kept + (kept > at[:, None]), axis=1)
        kept = kept[:-1]
        ranks = np.take_along_axis(ranks, kept + (kept >= at[:, None]), axis=1)
        for shift in (-1, 0):
            near = np.flatnonzero((at + shift >= 0) & (at + shift < width - 2))
            where = at[near] + shift
            ranks[near, where] = pair_ranks(table, ids[near, where], ids[near, where + 1])


def merge_long(table: dict, word: bytes) -> list[int]:
    """Ids of one long word: pairs leave a heap by rank, then position, which is the order of the rounds."""
    tokens, ranks = [bytes([b]) for b in word], table["ranks"]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(word) and (rank := ranks.get(tokens[left] + tokens[right])) is not None:
            heapq.heappush(heap, (rank, left, tokens[left], tokens[right]))

    for k in range(len(word) - 1):
        offer(k)
    while heap:
        _, left, a, b = heapq.heappop(heap)
        right = after[left]
        if tokens[left] != a or right >= len(word) or tokens[right] != b:
            continue
        tokens[left], tokens[right] = a + b, b""
        after[left] = after[right]
        if after[right] < len(word):
            before[after[right]] = left
        if before[left] >= 0:
            offer(before[left])
        offer(left)
    out, k = [], 0
    while k < len(word):
        out.append(ranks[tokens[k]])
        k = after[k]
    return out


def encode_words(table: dict, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
    """Ids of each word as little-endian unsigned 32-bit integers. A word that is a token is not merged."""
    ranks, buckets, texts = table["ranks"], {}, {}
    for text in words:
        word = text.encode()
        if (whole := ranks.get(word)) is not None:
            yield text, whole.to_bytes(4, "little")
        elif len(word) > MATRIX_BYTES:
            yield text, np.array(merge_long(table, word), "<u4").tobytes()
        else:
            texts[word] = text
            buckets.setdefault((len(word) + 3) // 4, []).append(word)
    for same in buckets.values():
        for at in range(0, len(same), 20_000):
            yield from ((texts[word], ids) for word, ids in merge_matrix(table, same[at : at + 20_000]))


def entry_bytes(entries: dict[str, bytes]) -> int:
    """About the memory that the entries take in a dictionary."""
    return sum(sys.getsizeof(k) + sys.getsizeof(v) + 100 for k, v in entries.items())


class Encoder:
    """Encodes texts in a worker; remembers short chunks and words, up to a number of bytes."""

    def __init__(self, table: dict, pattern: str):
        self.table, self.words_of = table, regex.compile(pattern).findall
        self.tight, self.runs = re.compile(r"\s "), regex.compile(r"\s*\S+|\s+")
        self.after_blank: dict[str, bytes] = {}  # chunks without the blank before them
        self.as_is: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0

    def split(self, chunk: str) -> list[str]:
        """The pattern's words of a chunk; letters after at most one blank are one word."""
        return [chunk] if chunk[chunk[:1] == " " :].isalpha() else self.words_of(chunk)

    def learn(self, chunks: set[str], before: str) -> dict[str, bytes]:
        """Ids of chunks that are not known. Short words stay known; long ones only until these chunks are done."""
        words = {chunk: self.split(before + chunk) for chunk in chunks}
        new = dict(encode_words(self.table, {w for ws in words.values() for w in ws if w not in self.words}))
        self.words.update(new)
        get = self.words.__getitem__
        found = {chunk: get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for chunk, ws in words.items()}
        for word in [w for w in new if len(w) > LONGEST]:
            del self.words[word], new[word]
        self.held += entry_bytes(new)
        return found

    def look_up(self, known: dict[str, bytes], before: str, chunks: list[list[str]]) -> list[list[bytes]]:
        found = [list(map(known.get, x)) for x in chunks]
        new = self.learn({c for x, ids in zip(chunks, found, strict=True) if None in ids for c, i in zip(x, ids, strict=True) if i is None}, before)
        short = {c: i for c, i in new.items() if len(c) <= LONGEST}
        known.update(short)
        self.held += entry_bytes(short)
        return [[new[c] if i is None else i for c, i in zip(x, ids, strict=True)] if None in ids else ids for x, ids in zip(chunks, found, strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The pattern's words end before white space that follows other characters, so no word crosses these cuts."""
        if self.held > REMEMBERED_BYTES:
            for known in (self.after_blank, self.as_is, self.words):
                known.clear()
            self.held = 0
        tight = [bool(self.tight.search(x)) for x in texts]
        whole = [self.runs.findall(x) if t else [x.split(" ", 1)[0]] for x, t in zip(texts, tight, strict=True)]
        rest = [[] if t else x.split(" ")[1:] for x, t in zip(texts, tight, strict=True)]
        heads, tails = self.look_up(self.as_is, "", whole), self.look_up(self.after_blank, " ", rest)
        return [b"".join(a) + b"".join(b) for a, b in zip(heads, tails, strict=True)]


def parts(texts: pa.Array, most: int = PART_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) of about `most` characters; a null is an empty text."""
    start, held, size = 0, [], 0
    for k, value in enumerate(texts):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= most:
            yield start, held
            start, held, size = k + 1, [], 0
    if held:
        yield start, held


def with_column(df: DataFrame, name: str, keep: list[str] | None = None) -> tuple[list[str], StructType]:
    """The columns that stay when `name` is added (one of that name is replaced), and the new schema."""
    kept = [f for f in df.schema.fields if f.name.lower() != name.lower() and (keep is None or f.name in keep)]
    return [f.name for f in kept], StructType([*kept, StructField(name, BinaryType())])


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_column: str = "text", ids_column: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add the ids of every whole text, little-endian unsigned 32-bit integers in one binary value.

    vocabulary: path of a file of ranks, read by the driver and broadcast (a vocabulary is of fixed size). Null and empty
    texts get no ids (an empty value). Other columns stay (or those of `keep`); one named like `ids_column` is replaced. Rows stay one to one.
    """
    text_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(pair_table(read_ranks(vocabulary)))
    names, schema = with_column(docs, ids_column, keep)
    text, run = fresh(docs, "whole_text"), uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker("bpe", run, lambda: Encoder(table.value, pattern))
        for batch in batches:
            kept = [batch.column(name) for name in names]
            for start, texts in parts(batch.column(text)):
                ids = pa.array(encoder(texts), pa.binary())
                yield pa.record_batch([*[x.slice(start, len(texts)) for x in kept], ids], [*names, ids_column])

    return docs.select(*names, F.col(text_column).alias(text)).mapInArrow(work, schema)


def with_ids(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """`encode`, with the number of ids in `n_tokens`; columns of these two names are replaced."""
    out = encode(docs, vocabulary, pattern)
    return out.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(df: DataFrame, vocabulary: str, ids_column: str = "ids", out_column: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; a null gives an empty value. Other columns stay, as with `encode`."""
    ranks = read_ranks(vocabulary)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    names, schema = with_column(df, out_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.frombuffer(x.as_py() or b"", "<u4").tolist() for x in part.column(ids_column)]
                out = pa.array([b"".join([tokens[i] for i in x]) for x in ids], pa.binary())
                yield pa.record_batch([*[part.column(n) for n in names], out], [*names, out_column])

    return df.select(*names).mapInArrow(work, schema)
