"""SimHash near-dedup: fingerprints, a binary trie self-join within a Hamming radius, and connected classes.

Two fingerprints of at most `radius` differing bits agree on at least `blocks - radius` of `blocks` blocks of bits, so
every linked pair meets in a group of equal blocks. In a group, the sorted fingerprints are a binary trie whose nodes are
ranges; pairs of nodes go down together, each differing bit costs one, and a pair over the radius ends there. A group
sends on a star for each of its connected pieces, not its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, hex64, small_or_merged, stored, stored_with, text_batches

#: Rows of a group that one task joins at most; larger groups are cut into chunks, and pairs of chunks are joined.
GROUP_ROWS = 8192
#: Rows of whole groups joined at once.
AT_ONCE = 60_000
#: Node pairs of at most so many leaf pairs are compared directly.
LEAF_PAIRS = 64


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """64 majority bits over the XXH64 of all shingles of `width` words, repeats included; 0 without a word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1])).tolist()
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=False)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], np.uint64)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4) -> DataFrame:
    """(id, fp long) of every row. A null or blank text has fingerprint 0."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    text_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), text_column).mapInArrow(work, f"id {kind}, fp long")


def trie_pairs(values: np.ndarray, nodes: tuple[np.ndarray, ...], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at most `radius` bits apart, below the given pairs of nodes.

    values: uint64, ascending inside every node; nodes: arrays a_from, a_to, b_from, b_to of index ranges, either the same
    range twice or two ranges that do not overlap.
    """
    a0, a1, b0, b1 = (np.asarray(x, np.int64) for x in nodes)
    spent, left, right = np.zeros(len(a0), np.int64), [], []
    for bit in range(63, -2, -1):
        same = (a0 == b0) & (a1 == b1)
        keep = (a1 > a0) & (b1 > b0) & (spent <= radius) & ~(same & (a1 - a0 == 1))
        a0, a1, b0, b1, spent, same = (x[keep] for x in (a0, a1, b0, b1, spent, same))
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (bit < 0)
        if small.any():
            sa, sb = (a1 - a0)[small], (b1 - b0)[small]
            each = sa * sb
            owner = np.repeat(np.arange(len(each)), each)
            nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            i, j = a0[small][owner] + nth // sb[owner], b0[small][owner] + nth % sb[owner]
            near = (np.bitwise_count(values[i] ^ values[j]) <= radius) & ((i < j) | ~same[small][owner])
            left.append(i[near])
            right.append(j[near])
        a0, a1, b0, b1, spent, same = (x[~small] for x in (a0, a1, b0, b1, spent, same))
        if not len(a0):
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        cross = ~same  # of a node with itself, one of the two mixed pairs is enough
        a0, a1, b0, b1, spent = (
            np.concatenate((a0, am, a0, am[cross])), np.concatenate((am, a1, am, a1[cross])),
            np.concatenate((b0, bm, bm, b0[cross])), np.concatenate((bm, b1, b1, bm[cross])),
            np.concatenate((spent, spent, spent + 1, spent[cross] + 1)),
        )
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def local_stars(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, least value of its piece) for the pieces that the index pairs connect; least as unsigned."""
    ends, at = np.unique(np.concatenate((values[i], values[j])), return_inverse=True)
    u, v = at[: len(i)], at[len(i) :]
    label = np.arange(len(ends))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(ends))
    return ends[far], ends[label[far]]


def _joined(group: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of all groups: pairs of the group's rows, or of its rows of both sides where it has two; fp: unsigned."""
    order = np.lexsort((fp, side, group))
    group, side, fp = group[order], side[order], fp[order]
    fresh = np.concatenate(([True], group[1:] != group[:-1]))
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(group)]))
    middle = first + np.add.reduceat((side == 0).astype(np.int64), first)
    alone = side[last - 1] == 0  # one chunk with itself
    pairs = trie_pairs(fp, (first, np.where(alone, last, middle), np.where(alone, first, middle), last), radius)
    return local_stars(fp, *pairs)


def _links_stage(radius: int):
    def solve(parts: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(parts)
        group, side, fp = (table.column(k).to_numpy() for k in ("key", "side", "fp"))
        u, v = _joined(group, side, fp.view(np.uint64), radius)
        return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by key; whole groups are solved together, a group that is not over yet waits."""
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= AT_ONCE:
                key = batch.column("key").to_numpy()
                open_rows = int((key == key[-1]).sum())
                if open_rows < len(key):
                    rest = held[-1].slice(len(key) - open_rows)
                    held[-1] = held[-1].slice(0, len(key) - open_rows)
                    yield solve(held)
                    held, rows = [rest], open_rows
        if rows:
            yield solve(held)

    return work


def hamming_links(fps: DataFrame, radius: int = 4, blocks: int = 6, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Distinct (u, v), enough links to connect all distinct `fp` values that chains of pairs within the radius connect."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must exceed the radius")
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("turn", "part"))
    keyed = keyed.select("fp", F.xxhash64("turn", "part").alias("key"))  # a shared hash only joins two groups: more work, same links
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(large, "key").select("key", "fp", F.ceil(F.col("n") / group_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    paired = sized.withColumn("own", chunk).select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    tasks = paired.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")
    return tasks.repartition("key").sortWithinPartitions("key").mapInArrow(_links_stage(radius), "u long, v long").distinct()


def near_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """(id, fp, root, component_id) of every row: the least fingerprint and the least id that chains of fingerprints
    within `radius` bits reach.

    Null and blank texts have fingerprint 0 and are linked like any other. Repeated rows stay repeated. A null id never is a
    component_id unless its class has no other. An empty table gives an empty result. Other columns are not read.
    """
    marked = stored(fingerprints(docs, id_column, text_column, width), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("id").alias("least_id"))
    roots = components(hamming_links(classes.select("fp"), radius), "classes")
    rooted = classes.join(roots.hint("merge"), classes.fp == roots.u, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = rooted.join(named.hint("merge"), "root").select("fp", "root", "component_id")
    return marked.join(found.hint("merge"), "fp").select("id", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """Keep one document of each class: the one with the least doc_id, of rows of that id the least fingerprint; of rows
    that agree in both, one. Columns stay. A class whose ids are all null keeps one of its rows.

    Only rows whose id is null or repeated are told apart by their texts; all others are kept by their id alone.
    """
    marked = stored(fingerprints(docs, width=width), "fingerprints")
    # Least ids go up from rows to fingerprints to classes; no row is joined with its class.
    leasts = marked.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id")).alias("least"))
    roots = components(hamming_links(leasts.select("fp"), radius), "classes")
    rooted = leasts.join(roots.hint("merge"), leasts.fp == roots.u, "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct("least.nameless", "least.id", "fp")).alias("first")
    chosen, seen = stored_with(rooted.groupBy("root").agg(first).select("first.id", "first.fp"), "chosen")
    counts = marked.groupBy("id").agg(F.count("*").alias("n"))
    several, told = stored_with(counts.where("n > 1 or id is null").select("id"), "several")
    sole = chosen.where("id is not null").select(F.col("id").alias("doc_id"))
    if not told["rows"]:
        return docs.join(small_or_merged(sole, seen["rows"]), "doc_id", "left_semi").select(*docs.columns)
    sole = sole.join(small_or_merged(several.select(F.col("id").alias("doc_id")), told["rows"]), "doc_id", "left_anti")
    named = docs.join(small_or_merged(sole, seen["rows"]), "doc_id", "left_semi")

    marks = F.pandas_udf(lambda texts: texts.map(lambda x: fingerprint(x, width)), "long")
    rest = docs.join(several, docs.doc_id.eqNullSafe(several.id), "left_semi")
    rest = rest.select(F.struct(*docs.columns).alias("row"), "doc_id", marks("text").alias("fp"))
    wanted = chosen.select(F.col("id").alias("wanted_id"), F.col("fp").alias("wanted_fp"))
    rest = rest.join(wanted, rest.doc_id.eqNullSafe(wanted.wanted_id) & (rest.fp == wanted.wanted_fp), "left_semi")
    rest = rest.dropDuplicates(["doc_id", "fp"]).select("row.*")
    return named.select(*docs.columns).unionByName(rest)
