"""The registered queries: each dealt operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html, langid, negatives, neighbours, pii, quality, resample, sharding, simhash, suffixes, unigram
from .shared import hex64, stored


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    vocabulary = unigram.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram.count_tokens(table(spark, directory, "documents"), vocabulary, keep=["doc_id"])


def op2_pii(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    marked = pii.with_spans(docs, pii.fit(docs))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [F.size(F.array_remove(kinds, other)) for other in range(len(pii.KINDS))]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{name}") for n, name in zip(counts, pii.KINDS, strict=True)]
    spans = pii.as_text(F.col("spans")).alias("spans")
    return marked.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), spans)


def op3_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, directory, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.decode(ids, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    found = langid.label(docs, langid.fit(docs), keep=["doc_id"])
    return found.select("doc_id", quality.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op5_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op6_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    found = stored(quality.with_statistics(table(spark, directory, "documents")), "statistics")
    model = quality.learn(found, table(spark, directory, "labels"))
    return quality.score(found, model).select(
        F.col("id").alias("doc_id"),
        quality.held_out("id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_simhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    classes = simhash.near_classes(table(spark, directory, "documents"))
    return classes.select(F.col("id").alias("doc_id"), hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op8_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    kept = suffixes.remove_repeats(table(spark, directory, "documents"))
    return kept.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages")
    network = html.fit(pages)
    texts = html.extract(pages, network, keep=["page_id", "url"])
    return texts.withColumns({"n_chars": F.length("text").cast("long"), "pages_learned": F.lit(network.pages)})


def op10_nearest_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return neighbours.nearest(table(spark, directory, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_importance_resampling(spark: SparkSession, directory: str) -> DataFrame:
    return resample.resample(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, directory, "embeddings"), F.col("vec_id") % 50 == 0, moved)


def op13_sharding(spark: SparkSession, directory: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    dealt = sharding.shards(table(spark, directory, "documents"), 40, ["doc_id", crc])
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}

#: DuckDB SQL of the queries that SQL can express. Op8 spells all windows of all texts as hex digits; for op11 the CRC-32 of
#: the features is spelled out, byte by byte.
ORACLE: dict[str, str] = {
    "op8_suffix_dedup": """
        WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        blocks AS (
            SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 1049) AS part
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49, 1000)) AS b FROM raw WHERE length(h) >= 100)),
        windows AS (
            SELECT doc_id, b + i AS p, substr(part, 2 * i + 1, 100) AS w
            FROM (SELECT doc_id, b, part, unnest(range(length(part) // 2 - 49)) AS i FROM blocks)),
        least AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1),
        marked AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM windows JOIN least USING (w) WHERE doc_id > least),
        numbered AS (SELECT doc_id, p, count(*) FILTER (gap IS NULL OR gap > 50) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
        runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM numbered GROUP BY doc_id, run),
        after AS (SELECT *, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM runs),
        pieces AS (
            SELECT doc_id, min(a) AS first, sum(z - a) AS gone, count(*) AS n,
                string_agg(substr(h, 2 * z + 1, 2 * (coalesce(next, length(h) // 2) - z)), '' ORDER BY a) AS rest
            FROM after JOIN raw USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
            sha256(unhex(CASE WHEN n IS NULL THEN h ELSE substr(h, 1, 2 * first) || rest END)) AS kept_sha256
        FROM raw LEFT JOIN pieces USING (doc_id)""",
    "op11_importance_resampling": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        texts AS (
            SELECT 's' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
        words AS (
            SELECT kind, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
        spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
        hashed AS (
            SELECT word, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
            FROM spelled, crc),
        counted AS (SELECT bucket, count(*) FILTER (kind = 's') AS s, count(*) FILTER (kind = 't') AS t FROM words JOIN hashed USING (word) GROUP BY bucket),
        sums AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM counted),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
            FROM counted, sums),
        weights AS (
            SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE kind = 's' GROUP BY doc_id),
        noisy AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(
                -1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM documents LEFT JOIN weights USING (doc_id)),
        placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS drawn
            FROM noisy WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
        FROM noisy LEFT JOIN placed USING (doc_id)""",
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
            CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored n USING (anchor_id)
        WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 3""",
}
