"""Token counts of a unigram vocabulary: Viterbi over Aho-Corasick matches that carries the best score and piece count.

Scores add up in double precision from the left. Of the paths to a place, the first to reach the best score stays: the
longest last piece wins a tie, as in the public tokenizers. A character without a piece of its own costs ten less than the
least score and counts as its bytes (byte fallback) or, with other such characters next to it, as one piece.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .bpe import parts
from .shared import fresh, kept_by_worker

#: The mark that stands for a blank inside pieces.
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: About the memory that a worker's remembered segments take; longer ones than LONGEST characters are not remembered.
REMEMBERED_BYTES = 128 << 20
LONGEST = 64


class Vocabulary(NamedTuple):
    pieces: dict[str, float]
    byte_fallback: bool
    dummy_prefix: bool = True


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces with their scores of a public model file; control, unknown and byte pieces match no text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    fallback = any(model.is_byte(i) for i in range(model.get_piece_size()))
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in ids}, fallback)


class Counter:
    """Counts pieces of texts in a worker; remembers short segments, up to a number of bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.matches.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.matches.make_automaton()
        self.unknown = min(vocabulary.pieces.values(), default=0.0) - UNKNOWN_PENALTY
        inner = any(BLANK in piece.lstrip(BLANK) for piece in vocabulary.pieces)
        #: Where no piece has a blank after another character, every path passes each such place.
        self.cut_blanks = not inner and (vocabulary.byte_fallback or BLANK in vocabulary.pieces)
        #: Where no piece has a line end, every path passes both its sides.
        self.cut_lines = self.cut_blanks and vocabulary.byte_fallback and not any("\n" in piece for piece in vocabulary.pieces)
        self.segment = re.compile(f"{BLANK}*[^{BLANK}\n]+|\n|{BLANK}+" if self.cut_lines else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.after_blank: dict[str, tuple[int, float]] = {}
        self.as_is: dict[str, tuple[int, float]] = {}
        self.held = 0

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one segment."""
        n, fallback, unknown = len(text), self.vocabulary.byte_fallback, self.unknown
        score, count, lost = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)

        def take_unknown(start: int, best: float | None) -> None:
            found = score[start] + unknown
            if best is None or found > best:
                score[start + 1], lost[start + 1] = found, True
                count[start + 1] = count[start] + (len(text[start].encode()) if fallback else 0 if lost[start] else 1)

        at, best, single = 0, None, True
        for last, (length, value) in self.matches.iter(text) if self.vocabulary.pieces else ():
            if last >= at:  # the matches that end at `at` are over
                if not single:
                    take_unknown(at - 1, best)
                for place in range(at, last):  # no match ends there
                    take_unknown(place, None)
                at, best, single = last + 1, None, False
            start = at - length
            found = score[start] + value
            if best is None or found > best:
                score[at] = best = found
                count[at], lost[at] = count[start] + 1, False
            if length == 1:
                single = True
        if not single:
            take_unknown(at - 1, best)
        for place in range(at, n):
            take_unknown(place, None)
        return count[n], score[n]

    def look_up(self, known: dict[str, tuple[int, float]], segments: list[str], before: str) -> tuple[int, float]:
        total, value, get = 0, 0.0, known.get
        for segment in segments:
            found = get(segment)
            if found is None:
                found = self.best(before + segment)
                if len(segment) <= LONGEST:
                    known[segment] = found
                    self.held += sys.getsizeof(segment) + 220  # the pair, its two numbers and the place in the dictionary
            total += found[0]
            value += found[1]
        return total, value

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if self.held > REMEMBERED_BYTES:
            self.after_blank.clear()
            self.as_is.clear()
            self.held = 0
        text = text.replace(BLANK, " ")
        text = " " + text if self.vocabulary.dummy_prefix else text
        if not self.cut_blanks:
            return self.best(text.replace(" ", BLANK))
        if "  " in text or " \n" in text or "\n " in text or text[-1] == " " or text[0] != " " or not self.cut_lines:
            return self.look_up(self.as_is, self.segment.findall(text.replace(" ", BLANK)), "")
        lines = text.split("\n")
        words = [line.split(" ") for line in lines]
        heads = [x[0] for x in words if x[0]] + ["\n"] * (len(lines) - 1)
        a, b = self.look_up(self.as_is, heads, ""), self.look_up(self.after_blank, [w for x in words for w in x[1:]], BLANK)
        return a[0] + b[0], a[1] + b[1]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", count_column: str = "n_tokens", score_column: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Add piece count (long) and score (double) of the best segmentation of every whole text.

    The vocabulary is broadcast (its size is fixed). A null or empty text has 0 pieces and score 0. Rows stay one to one, other
    columns (or those of `keep`) stay; columns with the names of the two new ones are replaced.
    """
    shared, run = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex
    new = [count_column, score_column]
    kept = [f for f in docs.schema.fields if f.name.lower() not in {x.lower() for x in new} and (keep is None or f.name in keep)]
    names, text = [f.name for f in kept], fresh(docs, "whole_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_by_worker("unigram", run, lambda: Counter(shared.value))
        for batch in batches:
            columns = [batch.column(name) for name in names]
            for start, texts in parts(batch.column(text)):
                found = [counter(x) for x in texts]
                counts, scores = pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64())
                yield pa.record_batch([*[x.slice(start, len(texts)) for x in columns], counts, scores], [*names, *new])

    schema = StructType([*kept, StructField(count_column, LongType()), StructField(score_column, DoubleType())])
    return docs.select(*names, F.col(text_column).alias(text)).mapInArrow(work, schema)
