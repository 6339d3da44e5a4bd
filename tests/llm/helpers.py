"""Small inputs and plain versions for the tests of the training-data operators."""

from __future__ import annotations

import random

WORDS = "the of and to in is it that was for on are with as his they be at one have this from or had by hot but some what there".split()


def prose(seed: int, words: int) -> str:
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + (dice.choice("aeiou") * dice.randint(0, 2)) for _ in range(words))


#: Nulls, empty and blank texts, repeats, ties, a long text, odd characters; more columns with clashing names.
ODD_TEXTS = [None, "", "   \n\t ", "one", "two words", prose(1, 300), prose(1, 300), prose(2, 40), "é漢字 𝒳   ½²\x1c\x85", "x" * 5000, "no  double\n\n spaces ", prose(3, 8000)]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key long, score string, whole_text string, clean string"


def odd_documents(spark):
    rows = [(k, t, "en" if k % 2 else None, "src", len(t) if t else None, f"i{k}", k, "s", "w", "c") for k, t in enumerate(ODD_TEXTS)]
    rows += [(5, ODD_TEXTS[5], "en", "src", 1, "again", 1, "s", "w", "c"), (None, "a row without an id, " + prose(4, 30), "de", None, 1, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
