"""Language of texts by a linear-chain conditional random field over their words.

A word is a run of letters, in lower case. Its features are affixes, character n-grams and its entry in a lexicon of the
learning rows' words, hashed to rows of a weight table; learned transitions link the words of a segment, so a text may
switch its language. Forward-backward gives every word its distribution over the languages; their mean is the text's.
Words are cut into segments of equal length, which run through forward-backward as one matrix.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import parts
from .quality import held_out
from .shared import fresh, kept_by_worker, least_by_hash

#: Learning rows that reach the driver at most, and words used of each. All other steps cover all rows and whole texts.
SAMPLE_ROWS = 2400
SAMPLE_WORDS = 120
#: Words that stand together in what is used of a longer row.
RUN_WORDS = 12
BUCKETS = 1 << 16
NOTHING = BUCKETS
#: Words with a weight of their own: seen so often in the learning rows.
LEXICON_COUNT = 3
SEGMENT = 64
ROUNDS, RATE, DECAY = 5, 0.2, 1e-6
#: Part of the learning segments that are stitched from two languages.
MIXED = 0.5
SEED = 11
REMEMBERED = 800_000

WORD = regex.compile(r"\p{L}+")


def _mixed(grams: np.ndarray, salt: int) -> np.ndarray:
    """Rows of the weight table for n-grams given as code points in the last axis."""
    h = np.full(grams.shape[:-1], salt, np.uint64)
    for k in range(grams.shape[-1]):
        h = (h ^ grams[..., k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def features(words: list[str], lexicon: frozenset[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """(places in `words`, their rows of the weight table) for words of similar length; NOTHING fills a row up.

    A word between its end marks has all n-grams of 1 to 3 characters, affixes of 3 and 4, its lexicon entry, a constant.
    """
    groups: dict[int, list[int]] = {}
    for place, word in enumerate(words):
        groups.setdefault(-(-len(word) // 4) * 4, []).append(place)
    for width, places in groups.items():
        own = [words[k] for k in places]
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        codes = np.frombuffer("".join([w.ljust(width, "\0") for w in own]).encode("utf-32-le"), np.uint32).reshape(len(own), width).astype(np.uint64)
        marked = np.hstack([np.full((len(own), 1), ord("<"), np.uint64), codes, np.zeros((len(own), 2), np.uint64)])
        each = np.arange(len(own))
        marked[each, lengths + 1] = ord(">")
        columns = []
        for n in (1, 2, 3):
            grams = np.lib.stride_tricks.sliding_window_view(marked, n, axis=1)
            inside = np.arange(grams.shape[1]) + n <= lengths[:, None] + 2
            columns.append(np.where(inside, _mixed(grams, n), NOTHING))
        for n in (4, 5):
            take = lengths[:, None] + 2 - n + np.arange(n)
            end = _mixed(np.take_along_axis(marked, np.maximum(take, 0), axis=1), 10 + n)
            columns.append(np.where(take[:, 0] >= 0, end, NOTHING)[:, None])
        columns.append(np.where(lengths >= 3, _mixed(marked[:, :4], 20), NOTHING)[:, None])
        columns.append(np.array([[zlib.crc32(w.encode()) % BUCKETS if w in lexicon else NOTHING, 0] for w in own], np.int64))
        yield places, np.hstack(columns)


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # BUCKETS + 1 x languages; the last row is zero
    moves: np.ndarray  # languages x languages, the log-weight of a transition
    lexicon: frozenset[str]

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)))
        for places, rows in features(words, self.lexicon):
            out[places] = self.weights[rows].sum(axis=1) / np.sqrt((rows != NOTHING).sum(axis=1))[:, None]
        return out


def forward_backward(emissions: np.ndarray, real: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals and expected transitions; emissions: segments x words x languages; real: words that are no padding.

    Every step is scaled to sum to one, so long segments lose nothing.
    """
    length = emissions.shape[1]
    seen = np.where(real[..., None], np.exp(emissions - emissions.max(axis=2, keepdims=True)), 1.0)
    step = np.exp(moves - moves.max())
    forward, backward = seen.copy(), np.ones_like(seen)
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        forward[:, t] *= forward[:, t - 1] @ step
        forward[:, t] /= forward[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        value = (seen[:, t + 1] * backward[:, t + 1]) @ step.T
        backward[:, t] = np.where(real[:, t + 1, None], value / value.sum(axis=1, keepdims=True), 1.0)
    words = forward * backward
    words *= real[..., None] / words.sum(axis=2, keepdims=True)
    ahead = seen[:, 1:] * backward[:, 1:]
    joint = forward[:, :-1, :, None] * step * ahead[:, :, None, :]
    joint *= (real[:, 1:] / joint.sum(axis=(2, 3)))[..., None, None]
    return words, joint.sum(axis=(0, 1))


def train(texts: list[tuple[list[str], str]]) -> Model:
    """Fit on (words, language) pairs; half of the segments are stitched from texts of two languages."""
    languages = sorted({language for _, language in texts})
    random = np.random.default_rng(SEED)
    by = [[w for text, own in texts if own == language for w in text] for language in languages]
    counts = Counter(w for words in by for w in set(words))
    often = Counter(w for words in by for w in words)
    lexicon = frozenset(w for w in counts if often[w] >= LEXICON_COUNT)
    model = Model(languages, np.zeros((NOTHING + 1, len(languages))), np.zeros((len(languages), len(languages))), lexicon)
    if len(languages) < 2:
        return model
    spans = []  # (words, labels)
    for label, words in enumerate(by):
        for at in range(0, len(words), SEGMENT):
            spans.append((words[at : at + SEGMENT], [label] * len(words[at : at + SEGMENT])))
    order = random.permutation(len(spans))
    for k, other in zip(order[: int(MIXED * len(order))], random.permutation(len(spans)), strict=False):
        (a, la), (b, lb) = spans[k], spans[other]
        cut = int(random.integers(1, SEGMENT))
        spans[k] = (a[:cut] + b[cut:], la[:cut] + lb[cut:])
    distinct = sorted({w for words, _ in spans for w in words})
    vocabulary = {distinct[k]: row[row != NOTHING] for places, rows in features(distinct, lexicon) for k, row in zip(places, rows, strict=True)}
    grown, moved = np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)
    for _ in range(ROUNDS):
        order = random.permutation(len(spans))
        for at in range(0, len(order), 64):
            batch = [spans[k] for k in order[at : at + 64]]
            real = np.zeros((len(batch), SEGMENT), bool)
            gold = np.zeros((len(batch), SEGMENT), np.int64)
            emissions = np.zeros((len(batch), SEGMENT, len(languages)))
            for i, (words, labels) in enumerate(batch):
                real[i, : len(words)], gold[i, : len(words)] = True, labels
            rows = [vocabulary[w] for words, _ in batch for w in words]
            flat, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
            emissions[real] = np.add.reduceat(model.weights[flat], np.cumsum(lengths) - lengths, axis=0) / lengths[:, None] ** 0.5
            found, pairs = forward_backward(emissions, real, model.moves)
            slope = (np.eye(len(languages))[gold] * real[..., None]) - found
            each = np.repeat(slope[real] / lengths[:, None] ** 0.5, lengths, axis=0)
            touched, to = np.unique(flat, return_inverse=True)
            total = np.stack([np.bincount(to, each[:, k], len(touched)) for k in range(len(languages))], axis=1)
            grown[touched] += total**2
            model.weights[touched] += RATE * total / np.sqrt(grown[touched]) - DECAY * model.weights[touched]
            seen = np.zeros_like(pairs)
            both = real[:, 1:]
            np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
            moved += (seen - pairs) ** 2
            model.moves[:] += RATE * (seen - pairs) / np.sqrt(moved)
    return model


class Labeller:
    """Labels texts in a worker; remembers the emissions of words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)))

    def places(self, texts: list[list[str]]) -> list[list[int]]:
        known = self.known
        new = sorted(set().union(*texts).difference(known))
        if len(known) + len(new) > len(self.table):
            self.table = np.vstack([self.table, np.zeros((len(self.table) + len(new), self.table.shape[1]))])
        self.table[len(known) : len(known) + len(new)] = self.model.emissions(new)
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        return [list(map(known.__getitem__, words)) for words in texts]

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, score) of each text; the score is the mean probability of the language over the words."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if not self.model.languages:
            return [("und", 0.0)] * len(texts)
        places = self.places([WORD.findall(text.lower()) for text in texts])
        counts = np.array([len(x) for x in places])
        segments = -(-counts // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), segments)
        grid = np.zeros((len(owner), SEGMENT), np.int64)
        real = np.zeros((len(owner), SEGMENT), bool)
        row = 0
        for own, n in zip(places, segments.tolist(), strict=True):
            grid[row : row + n].flat[: len(own)] = own
            real[row : row + n].flat[: len(own)] = True
            row += n
        sums = np.zeros((len(texts), len(self.model.languages)))
        for at in range(0, len(owner), 4096):
            part = slice(at, at + 4096)
            words, _ = forward_backward(self.table[grid[part]], real[part], self.model.moves)
            np.add.at(sums, owner[part], words.sum(axis=1))
        best = sums.argmax(axis=1)
        return [(self.model.languages[k], min(1.0, float(s[k] / n))) if n else ("und", 0.0) for k, s, n in zip(best.tolist(), sums, counts.tolist(), strict=True)]


def learning_rows(docs: DataFrame) -> Column:
    """Rows whose text and language may be learned from."""
    return ~held_out("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def sampled_words(text: Column) -> Column:
    """A text's words, blank-joined; of more than SAMPLE_WORDS, runs from all over the text, the least by a hash of their place and the text."""
    words = F.split(text, r"\s+")
    last = F.floor((F.size(words) - 1) / RUN_WORDS).cast("int")
    places = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(F.xxhash64(k, text).alias("hash"), k.alias("place")))
    least = F.array_sort(F.transform(F.slice(F.array_sort(places), 1, SAMPLE_WORDS // RUN_WORDS), lambda x: x["place"]))
    runs = F.transform(least, lambda k: F.array_join(F.slice(words, k * RUN_WORDS + 1, RUN_WORDS), " "))
    return F.when(F.size(words) <= SAMPLE_WORDS, F.array_join(words, " ")).otherwise(F.array_join(runs, " "))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `sample_rows` learning rows, as many of each language, the least by a hash of id and text."""
    rows = docs.where(learning_rows(docs)).select("lang", "doc_id", "text")
    languages = [x.lang for x in rows.select("lang").distinct().collect()]
    share = -(-sample_rows // max(1, len(languages)))
    sample: list[tuple[list[str], str]] = []
    for language in sorted(languages):
        own = rows.where(F.col("lang") == language)
        best = least_by_hash(own, F.xxhash64(F.col("doc_id").cast("string"), "text"), share).select(sampled_words(F.col("text")).alias("text")).collect()
        sample += [(WORD.findall(x.text.lower()), language) for x in best]
    return train(sample)


def label(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(the columns of `keep`, lang_pred, score) of every row from its whole text alone.

    Null texts and texts without a letter are `und` with score 0, and so is everything where nothing was learned.
    """
    names = keep or []
    shared, run = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    schema = ", ".join([*[f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names], "lang_pred string, score double"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = kept_by_worker("langid", run, lambda: Labeller(shared.value))
        for batch in batches:
            for start, texts in parts(batch.column(len(names))):
                found = labeller(texts)
                kept = [batch.column(k).slice(start, len(texts)) for k in range(len(names))]
                yield pa.record_batch([*kept, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*names, "lang_pred", "score"])

    return docs.select(*names, F.col(text_column).alias(fresh(docs, "whole_text"))).mapInArrow(work, schema)
