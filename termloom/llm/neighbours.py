"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids of a bounded sample sit in a nearest-neighbour graph that every task searches in memory. A vector joins the list
of its nearest centroid and of each other centroid whose distance is within a ratio of that; a query reads the lists within
its own, wider ratio, at most a number that grows with the square root of the lists: a fixed number would lose neighbours as
the table grows, a fixed part of the lists would make the work quadratic. The walk's beam is wider than what is read, at every
size. An extra coordinate turns the largest inner product into the least distance. Equal vectors are one
entry with its least ids, which loses no result: a query needs at most its count of neighbours plus itself of them. Lists
over a fixed size are cut into chunks, as are the queries that read one list, so that no task holds more than both sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import least_by_hash, stored

#: Vectors from which centroids are learned, and their bytes, at most; all vectors are indexed.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32 << 20
LIST_ROWS = 96
MOST_LISTS = 8192
CHUNK_ROWS = 4096
EDGES, BEAM = 24, 96
#: A beam has so many places for every list that is read.
BEAM_RATIO = 1.5
COPIES, COPY_RATIO = 6, 1.15
#: A query reads up to PROBES lists of an index of PROBE_LISTS, and a number that grows with the square root of larger ones.
PROBES, PROBE_LISTS, PROBE_RATIO = 64, 512, 1.6
ROUNDS = 8
SEED = 5


class Index(NamedTuple):
    centroids: np.ndarray
    edges: np.ndarray
    entries: np.ndarray
    largest: float

    def search(self, points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) that a best-first walk of the graph finds, nearest first; `most` are wanted."""
        n, beam = len(points), min(max(BEAM, math.ceil(BEAM_RATIO * most)), len(self.centroids))
        norms = (self.centroids**2).sum(axis=1)

        def distances(ids: np.ndarray) -> np.ndarray:
            return norms[ids] - 2 * np.einsum("nkd,nd->nk", self.centroids[ids], points)

        ids = np.tile(self.entries[:beam], (n, 1))
        far, open_ = distances(ids), np.ones(ids.shape, bool)
        if ids.shape[1] < beam:
            short = beam - ids.shape[1]
            ids = np.hstack([ids, np.full((n, short), -1)])
            far, open_ = np.hstack([far, np.full((n, short), np.inf)]), np.hstack([open_, np.zeros((n, short), bool)])
        rows = np.arange(n)
        while True:
            best = np.where(open_, far, np.inf).argmin(axis=1)
            going = np.flatnonzero(open_[rows, best])
            if not len(going):
                break
            at = best[going]
            open_[going, at] = False
            new = self.edges[ids[going, at]]
            met = (new[:, :, None] == ids[going][:, None, :]).any(axis=2)
            d = norms[new] - 2 * np.einsum("nkd,nd->nk", self.centroids[new], points[going])
            all_ids, all_far = np.hstack([ids[going], new]), np.hstack([far[going], np.where(met, np.inf, d)])
            all_open = np.hstack([open_[going], ~met])
            keep = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids[going], far[going], open_[going] = (np.take_along_axis(x, keep, axis=1) for x in (all_ids, all_far, all_open))
            open_[going] &= np.isfinite(far[going])
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        return ids, np.maximum(far + (points**2).sum(axis=1)[:, None], 0.0)

    def probes(self) -> int:
        """Lists that a query reads at most."""
        return max(PROBES, math.ceil(PROBES * math.sqrt(len(self.centroids) / PROBE_LISTS)))

    def lists(self, points: np.ndarray, most: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest lists whose distance is at most `ratio` times the least, `most` at the most."""
        ids, far = self.search(points, most)
        near = np.sqrt(far[:, :most]) <= ratio * np.sqrt(far[:, :1]) + 1e-12
        near &= ids[:, :most] >= 0
        row, column = np.nonzero(near)
        return row, ids[row, column]

    def stored_points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest**2 - (vectors**2).sum(axis=1), 0.0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def query_points(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors * (self.largest / np.sqrt((vectors**2).sum(axis=1)))[:, None]
        return np.hstack([scaled, np.zeros((len(vectors), 1))])


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    norms = (centroids**2).sum(axis=1)
    return np.concatenate([(norms - 2 * points[k : k + 2048] @ centroids.T).argmin(axis=1) for k in range(0, len(points), 2048)])


def build(sample: np.ndarray, largest: float, lists: int) -> Index:
    """k-means that moves empty centroids into the largest lists, and the graph of the nearest centroids."""
    random = np.random.default_rng(SEED)
    index = Index(np.empty((0, 0)), np.empty((0, 0), np.int64), np.empty(0, np.int64), largest)
    points = index.stored_points(sample)
    centroids = points[random.permutation(len(points))[:lists]].copy()
    for _ in range(ROUNDS):
        own = _nearest(points, centroids)
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
        crowded = np.argsort(-counts, kind="stable")
        for empty, large in zip(np.flatnonzero(~full), crowded, strict=False):
            centroids[empty] = points[random.choice(np.flatnonzero(own == large))]
    norms, k = (centroids**2).sum(axis=1), min(EDGES, len(centroids) - 1)
    edges = np.zeros((len(centroids), max(1, k)), np.int64)
    for at in range(0, len(centroids) if k else 0, 1024):
        far = norms - 2 * centroids[at : at + 1024] @ centroids.T
        far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
        edges[at : at + 1024] = np.argpartition(far, k - 1, axis=1)[:, :k]
    if k > 3:  # a few random edges keep distant parts of the graph in reach
        edges[:, -2:] = random.integers(0, len(centroids), (len(centroids), 2))
    entries = random.permutation(len(centroids))[: min(16, len(centroids))]
    return index._replace(centroids=centroids, edges=edges, entries=entries)


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and all components are finite numbers."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _spread(df: DataFrame, index, queries: bool) -> DataFrame:
    """(list, key, v): a row for each list that a vector joins, or a query reads."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                vectors = _matrix(part.column("v"))
                points = own.query_points(vectors) if queries else own.stored_points(vectors)
                row, lists = own.lists(points, *((own.probes(), PROBE_RATIO) if queries else (COPIES, COPY_RATIO)))
                rows = part.take(pa.array(row))
                yield pa.record_batch([pa.array(lists, pa.int64()), rows.column("key"), rows.column("v")], ["list", "key", "v"])

    return df.select("key", "v").mapInArrow(work, "list long, key long, v array<double>")


def _chunked(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a chunk number, and the number of chunks of each list."""
    sizes = df.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias(f"{name}s"))
    chunk = F.pmod(F.xxhash64("key"), F.col(f"{name}s")).cast("int").alias(name)
    return df.join(sizes, "list").select("list", "key", "v", chunk), sizes


def _best_of(count: int):
    def work(queries: pa.Table, posts: pa.Table) -> pa.Table:
        q, v = _matrix(queries.column("v").combine_chunks()), _matrix(posts.column("v").combine_chunks())
        query_keys, keys = queries.column("key").to_numpy(), posts.column("key").to_numpy()
        out: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(q) if len(v) else 0, 256):
            rough = q[at : at + 256] @ v.T
            if len(v) > count:
                limit = np.partition(rough, len(v) - count, axis=1)[:, len(v) - count]
                limit -= 1e-9 * np.maximum(1.0, np.abs(limit))
            else:
                limit = np.full(len(rough), -np.inf)
            for k in range(len(rough)):
                near = np.flatnonzero(rough[k] >= limit[k])
                score = (v[near] * q[at + k]).sum(axis=1)  # the same order of sums for every row
                best = np.lexsort((keys[near], -score))[:count]
                out.append((np.full(len(best), query_keys[at + k]), keys[near][best], score[best]))
        columns = [np.concatenate([x[c] for x in out]) if out else np.empty(0, t) for c, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table([pa.array(x) for x in columns], ["query", "key", "score"])

    return work


def nearest(vectors: DataFrame, is_query: Column, count: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the `count` nearest found of each query row, the row's own id left out.

    Rows with a null id or an unusable vector (see `usable`) take no part, nor do vectors of another length than the most
    common one (of equally common, the least). Rows of one id are one, that of the least vector. Of equal scores the smaller id
    comes first.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.select("id", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("v"), "asks")  # -0.0 is 0.0
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == lengths[0].n)
    rows = stored(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")), "vectors")
    first = Window.partitionBy("v").orderBy("id")
    least = rows.select("v", "id").withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= count + 1)
    entries = stored(least.groupBy("v").agg(F.min("id").alias("key"), F.collect_list("id").alias("ids")), "entries")  # count + 1 ids at most
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, largest = entries.agg(F.count("*"), F.max(norm)).first()
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * lengths[0].n)))
    sample = _matrix(least_by_hash(entries.select("key", "v"), F.xxhash64("key"), wanted).select("v").toArrow().column("v").combine_chunks())
    lists = max(1, min(MOST_LISTS, len(sample), -(-total // LIST_ROWS)))
    index = spark.sparkContext.broadcast(build(sample, float(largest), lists))

    asked = rows.where("asks").select("id", "v").join(entries.select("v", "key"), "v").select("id", "key")
    asked = stored(asked, "queries")
    posts, post_chunks = _chunked(stored(_spread(entries, index, False), "posts"), "chunk")
    probes, probe_chunks = _chunked(stored(_spread(entries.join(asked.select("key").distinct(), "key"), index, True), "probes"), "part")
    posts = posts.join(probe_chunks, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    probes = probes.join(post_chunks, "list").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    task = ["list", "chunk", "part"]
    met = probes.select(*task, "key", "v").groupBy(*task).cogroup(posts.select(*task, "key", "v").groupBy(*task))
    hits = met.applyInArrow(_best_of(count + 1), "query long, key long, score double")
    hits = hits.groupBy("query", "key").agg(F.max("score").alias("score"))

    def top(df: DataFrame, by: str, tie: str, most: int) -> DataFrame:
        order = Window.partitionBy(by).orderBy(F.desc("score"), tie)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    found = top(hits, "query", "key", count + 1).join(entries.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
    found = top(found, "query", "vec_id", count + 1).drop("rank")
    answers = found.join(asked.select(F.col("key").alias("query"), F.col("id").alias("query_id")), "query").where("vec_id <> query_id")
    return top(answers.select("query_id", "vec_id", "score"), "query_id", "vec_id", count).select("query_id", "rank", "vec_id", "score")
