"""Token counts and byte-level BPE against the public libraries."""

import hashlib
import random

import helpers
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models, normalizers

from termloom.llm import bpe, unigram

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab'sS  \n\t\x1c\x85\xa0é漢Ⅷ½²1２_-!𝒳́क्षा　\r▁etr"


def odd_texts(count: int) -> list[str]:
    dice = random.Random(3)
    made = ["".join(dice.choice(ALPHABET) for _ in range(dice.randint(0, 40))) for _ in range(count)]
    return [*made, "a" * 3000, " " * 900, "ab" * 700, "!?" * 300, "\n \n  x  ", " lead", "trail ", *[t for t in helpers.ODD_TEXTS if t]]


@pytest.fixture(scope="module")
def table():
    return bpe.pair_table(bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def public():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_public_library(table, public):
    texts = odd_texts(3000)
    own = bpe.Encoder(table, public_tokenizers.PATTERN)(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in own] == [public.encode_ordinary(x) for x in texts]


def test_long_words_merge_alike_from_the_heap(table):
    words = [b"abab" * 20, b"thethethe" * 10, bytes(range(97, 123)) * 4, b"zzzzzzz" * 15]
    by_rounds = {w: np.frombuffer(ids, "<u4").tolist() for w, ids in bpe.merge_matrix(table, words)}
    assert {w: bpe.merge_long(table, w) for w in words} == by_rounds


def test_a_full_memory_starts_anew(table, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 2)
    encoder = bpe.Encoder(table, public_tokenizers.PATTERN)
    first = encoder(["some words here", "and some more"])
    assert encoder(["some words here", "and some more"]) == first


def test_texts_without_blanks_are_not_remembered(table, public):
    """Long chunks and words give the public library's ids, and the memory stays as small as its short entries."""
    encoder, dice = bpe.Encoder(table, public_tokenizers.PATTERN), random.Random(8)
    texts = ["".join(chr(dice.randrange(0x4E00, 0x9FA5)) for _ in range(700)) for _ in range(40)] + ["short words", "x" * 90 + "," + "yz" * 50]
    for _ in range(2):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder(texts)] == [public.encode_ordinary(t) for t in texts]
    known = [encoder.after_blank, encoder.as_is, encoder.words]
    assert sum(map(bpe.entry_bytes, known)) == encoder.held < 4000 and max(len(k) for x in known for k in x) <= bpe.LONGEST


def test_counting_remembers_short_segments_only():
    counter = unigram.Counter(unigram.Vocabulary({"▁": -2.0, "a": -1.0, "aa": -1.5}, True))
    assert counter("aa " + "a" * 999 + " aa") == counter("aa " + "a" * 999 + " aa")
    assert counter.as_is.keys() | counter.after_blank.keys() <= {"aa", "▁aa"}


def test_round_trip_over_odd_documents(spark):
    docs = helpers.odd_documents(spark)
    out = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    again = bpe.encode(out, RANKS, public_tokenizers.PATTERN)  # `ids` is there already and is replaced
    assert again.columns == [*docs.columns, "decoded", "ids"]
    assert bpe.encode(helpers.no_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_equal_the_public_library():
    vocabulary = unigram.read_vocabulary(PIECES)
    listed = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *vocabulary.pieces.items()]
    public = Tokenizer(models.Unigram(listed, 0, True))
    public.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts, counter = odd_texts(3000), unigram.Counter(vocabulary)
    assert [counter(t)[0] for t in texts] == [len(x.ids) for x in public.encode_batch(texts, add_special_tokens=False)]


def best_by_hand(text: str, vocabulary: unigram.Vocabulary) -> tuple[int, float]:
    """Plain dynamic programming; runs of unknown characters are one piece where bytes are no pieces."""
    unknown = min(vocabulary.pieces.values()) - unigram.UNKNOWN_PENALTY
    best = [(0.0, 0, False)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            known = piece in vocabulary.pieces
            if not known and end - start > 1:
                continue
            score, count, lost = best[start]
            found = score + (vocabulary.pieces[piece] if known else unknown)
            if best[end] is None or found > best[end][0]:
                more = 1 if known else len(piece.encode()) if vocabulary.byte_fallback else 0 if lost else 1
                best[end] = (found, count + more, not known)
    return best[-1][1], best[-1][0]


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_plain_dynamic_programming_with_ties(fallback):
    vocabulary = unigram.Vocabulary({"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "▁a": -5.0, "ba": -4.0, "aba": -6.0, "▁▁": -6.0}, fallback)
    counter, dice = unigram.Counter(vocabulary), random.Random(8)
    for _ in range(500):
        text = "".join(dice.choice("aab  zé\n") for _ in range(dice.randint(1, 12)))
        assert counter(text) == best_by_hand("▁" + text.replace(" ", "▁"), vocabulary), repr(text)


def test_counts_over_odd_documents(spark):
    docs, vocabulary = helpers.odd_documents(spark), unigram.read_vocabulary(PIECES)
    out = unigram.count_tokens(docs, vocabulary)  # `score` is there already and is replaced
    rows = {(r.doc_id, r.id): (r.n_tokens, r.text) for r in out.collect()}
    counter = unigram.Counter(vocabulary)
    assert len(rows) == docs.count() and sorted(out.columns) == sorted([*docs.columns, "n_tokens"])
    assert all(n == counter(text or "")[0] for n, text in rows.values())
    assert unigram.count_tokens(helpers.no_documents(spark), vocabulary).count() == 0


def test_op3_digests(spark):
    from termloom.llm.queries import op3_byte_bpe

    got = {r.doc_id: r for r in op3_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for doc in docs:
        ids = public.encode_ordinary(doc.text or "")
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()
