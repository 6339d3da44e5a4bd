"""Importance resampling, hard negatives and shards against SQL and plain versions, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import compare
import helpers
import numpy as np
import pytest

from termloom.llm import negatives, resample, sharding
from termloom.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op8_suffix_dedup", "op11_importance_resampling", "op12_hard_negatives"])
def test_query_equals_sql(spark, name):
    assert compare.assert_same(QUERIES[name](spark, DATA), compare.star_database(DATA), ORACLE[name]) > 100


# ---- importance resampling -----------------------------------------------------------------------


def plain_features(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return len(words), runs


def plain_resample(rows, target, longest, buckets, least_words, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in plain_features(text, longest)[1])
    t = Counter(bucket(f) for text in target for f in plain_features(text, longest)[1])
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out, able = [], []
    for k, (doc_id, text) in enumerate(rows):
        words, found = plain_features(text, longest)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(found), weight, score, None])
        if words >= least_words:
            able.append((-score, doc_id is None, doc_id or 0, k))
    for rank, (*_, k) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[k][4] = rank
    return Counter(map(tuple, out))


@pytest.mark.parametrize(("longest", "least_words", "percent"), [(1, 20, 50), (3, 1, 100), (2, 0, 30)])
def test_resample_odd_rows(spark, monkeypatch, longest, least_words, percent):
    monkeypatch.setattr(resample, "PART_BYTES", 64)
    docs = helpers.odd_documents(spark)
    target = [helpers.prose(9, 50), None, "", "Two WORDS"]
    found = resample.resample(
        docs, spark.createDataFrame([(t,) for t in target], "text string"), percent / 100, least_words, longest, 97
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_resample(rows, target, longest, 97, least_words, percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in found.collect()) == want


def test_resample_without_rows(spark):
    none, docs = helpers.no_documents(spark), helpers.odd_documents(spark)
    assert resample.resample(none, docs).count() == 0
    assert resample.resample(docs, none).where("rank is not null").count() == 0  # 10 per cent of 6 rows
    assert resample.draw(docs, none, part=0.5).columns == docs.columns


@pytest.mark.parametrize("spread", [1, 7, 1 << 40, 1 << 63])
def test_radix_ranks(spark, monkeypatch, spread):
    """Many small blocks, hot keys, repeated rows, ids over the whole range and null ids."""
    monkeypatch.setattr(resample, "BLOCK_BITS", 5)
    dice = random.Random(spread)
    rows = [(dice.randrange(-spread, spread) if dice.random() < 0.95 else None, dice.choice([3, 3, 3, -5000, 70])) for _ in range(1500)]
    rows += [(-spread, 1), (spread - 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(7)
    digits = [*resample.passes_of("doc_id", -spread, spread - 1, 1), *resample.passes_of("score", -5000, 70, falling=True)]
    found = resample.radix_sorted(df, digits).orderBy("_place").collect()
    assert [r["_place"] for r in found] == list(range(len(rows)))
    assert [(r.doc_id, r.score) for r in found] == sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))


# ---- hard negatives ------------------------------------------------------------------------------


def plain_negatives(rows, positives, count, low, high):
    usable = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a in (i for i in usable if i % 5 == 0):
        score = {i: sum(x * y for x, y in zip(usable[a][1], v, strict=False)) for i, (_, v) in usable.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if usable[i][0] == usable[a][0]][:positives]:
            fit = [i for i in order if usable[i][0] != usable[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(fit[:count], 1)]
    return Counter(out)


def odd_vectors(seed, size, scale):
    dice = random.Random(seed)
    rows = [(k, dice.randrange(3), [scale * dice.choice([dice.uniform(-1, 1), 0.25]) for _ in range(size)]) for k in range(150)]
    rows += [(k, dice.randrange(3), rows[3][2]) for k in range(150, 260)]  # ties
    rows += [rows[10], (11, 0, rows[12][2]), (20, None, rows[1][2]), (25, 1, None), (30, 2, [None] * size), (None, 1, rows[2][2])]
    rows += [(300, 1, [float("nan")] * size), (305, 1, [float("inf")] * size), (310, 1, [0.0] * size), (315, 1, []), (320, 2, rows[5][2][:1])]
    return rows


@pytest.mark.parametrize(("size", "scale"), [(3, 1.0), (16, 1.0), (2, 3e5), (1, 1e-9), (5, 4000.0)])
def test_hard_negatives_odd_rows(spark, monkeypatch, size, scale):
    monkeypatch.setattr(negatives, "ROWS", 50)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 3000)  # several chunks of anchors
    rows = odd_vectors(size, size, scale)
    schema = "vec_id long, label int, embedding array<double>, id string, v string, slot int"
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(5)
    from pyspark.sql import functions as F

    found = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), 4, 3, 50, 95)
    assert Counter(tuple(r) for r in found.collect()) == plain_negatives(rows, 4, 3, 50, 95)


def test_hard_negatives_without_rows(spark):
    from pyspark.sql import functions as F

    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(none, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0
    huge = spark.createDataFrame([(0, 1, [3e38]), (1, 1, [1.0]), (5, 2, [0.7])], none.schema)
    assert negatives.hard_negatives(huge, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0


@pytest.mark.parametrize("largest", [1, 3, 300, 70_000, 1 << 29])
def test_packed_products_are_exact(largest):
    dice = np.random.default_rng(largest)
    a, b = dice.integers(-largest, largest + 1, (9, 6)), dice.integers(-largest, largest + 1, (31, 6))
    a[0], b[0], b[1] = largest, largest, -largest
    packing = negatives.Packing.of(6 * largest * largest, largest)
    assert packing.fields == 64 // packing.width
    assert (packing.products(a, packing.pack(b), len(b)) == a @ b.T).all()


# ---- shards --------------------------------------------------------------------------------------


def check_shards(docs, found, count, tolerance, group_bytes=None):
    """Gapless slots, near equal bytes, neighbours with equal texts; returns the sizes."""
    sizes, slots, homes = [0] * count, defaultdict(list), defaultdict(set)
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append((r.slot, r.text))
        homes[r.text or ""].add(r.shard)
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in docs)
    assert all(r.size == len((r.text or "").encode()) + 16 for r in found)
    for rows in slots.values():
        rows.sort(key=lambda x: x[0])
        assert [s for s, _ in rows] == list(range(len(rows)))
        assert sum(a[1] != b[1] for a, b in zip(rows, rows[1:], strict=False)) == len({t or "" for _, t in rows}) - 1 or None in {t for _, t in rows}
    below, largest = 0, max(r.size for r in found)
    for k, size in enumerate(sizes[:-1], 1):
        below += size
        ideal = sum(sizes) / count
        assert abs(below - k * ideal) <= max(tolerance * ideal, largest / 2) + 1
    return sizes, homes


def test_shards_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = sharding.shards(docs, 40, ["doc_id", "text"]).collect()
    check_shards(docs.collect(), found, 40, sharding.TOLERANCE)


@pytest.mark.parametrize("range_rows", [10, 300, 500_000])
def test_shards_with_hot_text_and_hot_id(spark, monkeypatch, range_rows):
    """A text of a third of all rows, and an id of another third with one text, are cut; other groups stay whole."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(sharding, "PROBES", 64)
    dice = random.Random(1)
    rows = [(k, "same " * 20) for k in range(1000)] + [(7, "the very same row " * 5)] * 1000
    rows += [(dice.choice([k, -k, None]), helpers.prose(k // 3, 20)) for k in range(1000)] + [(1, None), (1, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sharding.shards(docs, 7, ["doc_id", "text"], tolerance=0.02).collect()
    sizes, homes = check_shards(docs.collect(), found, 7, 0.02)
    assert sum(len(h) > 1 for h in homes.values()) <= 2 and len(homes["same " * 20]) > 1


def test_shards_of_few_rows(spark, tmp_path):
    assert sharding.shards(helpers.no_documents(spark), 5, ["doc_id", "text"]).count() == 0
    docs = helpers.odd_documents(spark).drop("id", "key")
    found = sharding.shards(docs, 40, docs.columns).collect()
    check_shards(docs.collect(), found, 40, sharding.TOLERANCE)
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
    assert len(list((tmp_path / "out").glob("shard=*"))) <= 3
