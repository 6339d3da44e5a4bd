"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check.

DataFrame functions only. Windows are runs of as many words as an item has. A window that is similar enough shares most of
its shingles with the item, so only windows that hold that many of some item's shingles get a fingerprint; this loses no
window that the last check would keep. Two fingerprints within the radius have a block of bits in which few bits differ:
the items' blocks are listed with all such variants, and a window meets an item on an equal block. Candidates within the
radius are compared exactly, shingles weighted by their counts.

Texts are compared by their words: runs of letters and digits, in lower case.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small_or_merged, stored, stored_with

WIDTH = 5
SIMILARITY = 0.8
#: At similarity 0.8, two fingerprints differ in about 10 of 64 bits, with a spread of 3.
RADIUS = 23
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS


def words_of(text: Column) -> Column:
    """Words of a text; a null or wordless text has none. Separators at the ends leave empty strings, which go."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    found = F.when(F.get(found, F.lit(0)) == "", F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(found)
    return F.when(F.try_element_at(found, F.lit(-1)) == "", F.slice(found, 1, F.size(found) - 1)).otherwise(found)


def text_key() -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text, F.lit(2)).alias("k2")]


def shingle_rows(df: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """(keys, p, width, hash) for the shingles of `words` of each width, one row per place."""
    placed = df.select(*keys, "words", F.posexplode("words").alias("p", "word"))
    parts = [
        placed.where(F.col("p") + width <= F.size("words")).select(
            *keys, "p", F.lit(width).alias("width"), F.xxhash64("word", *[F.get("words", F.col("p") + k) for k in range(1, width)]).alias("hash")
        )
        for width in widths
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def majority_bits(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fp) from one row per shingle with its `hash`: a bit is set if over half of the rows have it."""
    counted = hashes.groupBy(*keys).agg(
        F.count("*").alias("rows"), *[F.sum(F.shiftrightunsigned("hash", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    )
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("rows"), F.lit((1 << b) - ((1 << 64) if b == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, fp.alias("fp"))


def block_values(fp: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int") for b in range(BLOCKS)])


def strings(words: Column, start: Column, width: Column, n: Column) -> Column:
    """The shingles of `n` words from `start` (from 0) as texts."""
    return F.transform(F.sequence(F.lit(0), n - width), lambda i: F.array_join(F.slice(words, start + i + 1, width), " "))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(k1, k2, item_id, start, n_words, similarity): the best window of each text that holds an item, texts by `text_key`.

    An item with fewer than five words is one shingle; an item without a word matches nothing. A text shorter than an item is
    one window. Of equally similar windows the first counts. Repeated texts are one text; repeated items each match.
    """
    if not 0 < similarity <= 1 or not 0 <= radius < 64:
        raise ValueError("similarity must be in (0, 1], radius in [0, 64)")
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.size("words")
    width = F.least(n, F.lit(WIDTH))
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "words", n.alias("n"), width.alias("width"), (n - width + 1).alias("m"))
    items, seen = stored_with(items, "items", **{f"w{k}": F.max(F.col("width") == k) for k in range(1, WIDTH + 1)})
    widths = [k for k in range(1, WIDTH + 1) if seen[f"w{k}"]] or [WIDTH]
    need = F.ceil(F.lit(similarity - 1e-9) * F.col("m")).cast("int")
    index = shingle_rows(items, ["item", "n", "m"], widths).join(items.select("item", F.col("width").alias("own")), "item").where("width = own")
    index, seen = stored_with(index.select("hash", "item", "n", "m", "width").distinct(), "item-shingles")
    index = small_or_merged(index, seen["rows"])

    texts = docs.select(*text_key(), words_of(F.col("text")).alias("words"))
    hits = shingle_rows(texts, ["k1", "k2"], widths).select("k1", "k2", "p", "hash").join(index, "hash")
    held = hits.groupBy("k1", "k2", "item", "n", "m").agg(F.count("*").alias("hits")).where(F.col("hits") >= need)
    held, seen = stored_with(held.select("k1", "k2", "item", "n", "m", "hits"), "held")

    # From here on: texts with enough shingles of an item only.
    keyed = docs.select(*text_key(), "text").join(small_or_merged(held.select("k1", "k2").distinct(), seen["rows"]), ["k1", "k2"])
    keyed = stored(keyed.dropDuplicates(["k1", "k2"]).select("k1", "k2", words_of(F.col("text")).alias("words")), "texts")
    places = shingle_rows(keyed, ["k1", "k2"], widths).select("k1", "k2", "p", "hash").join(index, "hash")
    places = places.join(held.select("k1", "k2", "item"), ["k1", "k2", "item"])
    # Per text and item: the places of one text, as many as it has words at most.
    runs = places.groupBy("k1", "k2", "item", "n", "m", "width").agg(F.array_sort(F.collect_set("p")).alias("ps"))
    runs = runs.withColumn("need", need).where(F.size("ps") >= F.col("need"))
    span = F.col("n") - F.col("width")
    # A window from `low` to `high` holds the places i to i + need - 1.
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("ps") - F.col("need")),
        lambda i: F.struct(F.greatest(F.get("ps", i + F.col("need") - 1) - span, F.lit(0)).alias("low"), F.get("ps", i).alias("high")),
    )
    starts = runs.select("k1", "k2", "n", "width", F.explode(ranges).alias("r")).where("r.low <= r.high")
    starts = starts.select("k1", "k2", "n", "width", F.explode(F.sequence("r.low", "r.high")).alias("s"))
    windows = starts.join(keyed, ["k1", "k2"])
    last = F.greatest(F.size("words") - F.col("n"), F.lit(0))
    windows = windows.withColumn("s", F.least("s", last)).withColumn("own", F.least("n", F.size("words") - F.col("s"))).where("own >= width")
    windows = windows.select("k1", "k2", "n", "s", strings(F.col("words"), F.col("s"), F.col("width"), F.col("own")).alias("shingles")).dropDuplicates(["k1", "k2", "n", "s"])
    windows = stored(windows, "windows")

    id4 = ["k1", "k2", "n", "s"]
    marked = majority_bits(windows.select(*id4, F.explode("shingles").alias("shingle")).select(*id4, F.xxhash64("shingle").alias("hash")), id4)
    item_shingles = items.select("item", "n", "m", F.explode(strings(F.col("words"), F.lit(0), F.col("width"), F.col("n"))).alias("shingle"))
    item_marks = majority_bits(item_shingles.select("item", "n", F.xxhash64("shingle").alias("hash")), ["item", "n"])
    flips = sorted({sum(1 << b for b in bits) for size in range(radius // BLOCKS + 1) for bits in itertools.combinations(range(BLOCK_BITS), min(size, BLOCK_BITS))})
    variants = item_marks.select("item", "n", F.col("fp").alias("item_fp"), F.posexplode(block_values(F.col("fp"))).alias("block", "value"))
    variants = variants.select("item", "n", "item_fp", "block", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda x: x.bitwiseXOR(F.col("value")))).alias("value"))
    variants, seen = stored_with(variants, "item-blocks")
    variants = small_or_merged(variants, seen["rows"])
    near = marked.select(*id4, "fp", F.posexplode(block_values(F.col("fp"))).alias("block", "value")).join(variants, ["n", "block", "value"])
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*id4, "item").distinct()

    weights = windows.select(*id4, F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")).groupBy(*id4, "size", "shingle").agg(F.count("*").alias("w"))
    item_weights = item_shingles.groupBy("item", "m", "shingle").agg(F.count("*").alias("v"))
    common = near.join(weights, id4).join(item_weights, ["item", "shingle"])
    alike = common.groupBy(*id4, "item", "size", "m").agg(F.sum(F.least("w", "v")).alias("common"))
    alike = alike.withColumn("similarity", F.col("common") / (F.col("size") + F.col("m") - F.col("common"))).where(F.col("similarity") >= similarity)
    best = alike.groupBy("k1", "k2", "item").agg(F.max(F.struct("similarity", (-F.col("s")).alias("back"))).alias("best"))
    found = best.join(items.select("item", "item_id", F.col("n").alias("n_words")), "item")
    return found.select("k1", "k2", "item_id", (-F.col("best.back")).alias("start"), "n_words", F.col("best.similarity").alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): one row for each row of `docs` and each item that it holds."""
    found, seen = stored_with(matches(docs, benchmark), "matches")
    return docs.select("doc_id", *text_key()).join(small_or_merged(found, seen["rows"]), ["k1", "k2"]).select("doc_id", "item_id", "start", "n_words", "similarity")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no item; all columns stay, also of rows with null texts or ids."""
    k1, k2 = fresh_pair(docs)
    found, seen = stored_with(matches(docs, benchmark).select("k1", "k2").distinct(), "matches")
    found = small_or_merged(found.toDF(k1, k2), seen["rows"])
    keys = [key.alias(name) for key, name in zip(text_key(), (k1, k2), strict=True)]
    return docs.select("*", *keys).join(found, [k1, k2], "left_anti").select(*docs.columns)


def fresh_pair(docs: DataFrame) -> tuple[str, str]:
    """Two column names that the table does not have."""
    taken = {x.lower() for x in docs.columns}
    ends = (str(k) for k in itertools.count() if not {f"k1_{k}", f"k2_{k}"} & taken)
    end = next(ends)
    return f"k1_{end}", f"k2_{end}"
