"""The stages of the corpus pipeline: columns, odd rows, and their decisions."""

import collections

import corpus_pipeline
import helpers
import numpy as np
import public_tokenizers
import test_duplicates
import tiktoken
from pyspark.sql import functions as F

from termloom.llm import bpe, pii
from termloom.llm.queries import QUERIES
from termloom.llm.shared import stored

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        counts.append(docs.count())
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] >= counts[3] == counts[4] == counts[5] > 0
    assert docs.where("n_tokens is null or octet_length(ids) <> 4 * n_tokens").count() == 0


def test_stages_over_odd_and_no_documents(spark):
    for docs in (helpers.odd_documents(spark), helpers.no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def shingle_counts(text):
    words = test_duplicates.re.findall(r"[^\W_]+", (text or "").lower())
    width = min(5, len(words))
    return collections.Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1)), width


def plain_contaminated(docs, items):
    """All windows of all texts, but for pairs whose whole texts share too few shingles for any window."""
    found = set()
    for item in items:
        target, width = shingle_counts(item[1])
        for doc in docs if width else ():
            words = test_duplicates.re.findall(r"[^\W_]+", (doc[1] or "").lower())
            whole = collections.Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
            if (whole & target).total() >= 0.8 * target.total() - 1e-9:
                found |= {d for d, _ in test_duplicates.plain_matches([doc], [item])}
    return found


def test_stages_equal_plain_versions(spark):
    """Each stage on its own input, whole: who stays, what the texts become, which ids come out."""
    docs, texts = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        outputs.append((docs, docs := stored(stage(spark, docs, DATA), name)))

    def rows(df):
        return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    before, after = map(rows, outputs[0])  # the same rows are learned from as in the registered query
    good = QUERIES["op6_quality_classifier"](spark, DATA).where("predicted = 1")
    assert after == {d: before[d] for d in {r.doc_id for r in good.collect()}}

    before, after = map(rows, outputs[1])
    fps = {d: test_duplicates.plain_fingerprint(t) for d, t in before.items()}
    nodes = sorted(set(fps.values()))
    links = [(a, b) for k, a in enumerate(nodes) for b in nodes[k + 1 :] if (a ^ b).bit_count() <= 4]
    root, least = test_duplicates.classes_of(nodes, links), {}
    for d, fp in fps.items():
        least[root[fp]] = min(d, least.get(root[fp], d))
    assert after == {d: before[d] for d in least.values()}

    before, after = map(rows, outputs[2])
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    gone = plain_contaminated(before.items(), items)
    assert gone and after == {d: t for d, t in before.items() if d not in gone}

    before, after = map(rows, outputs[3])
    marked = pii.with_spans(outputs[3][0], pii.fit(outputs[3][0]))
    for doc, spans in marked.select("row.doc_id", pii.as_text(F.col("spans"))).collect():
        text = before[doc]
        for kind, start, end in reversed([x.split(":") for x in spans.split(",") if x]):
            text = f"{text[: int(start)]}[{kind.upper()}]{text[int(end) :]}"
        texts[doc] = text
    assert after == texts != before

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in outputs[4][1].collect()}
    assert found == {d: public.encode_ordinary(t or "") for d, t in after.items()}
