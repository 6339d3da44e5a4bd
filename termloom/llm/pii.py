"""Personal data: base rules, and further spans from wide generators that boosted trees score.

DataFrame functions only; a text never leaves its row and nothing is shuffled but counts. Generators propose spans of loose
forms, which may overlap each other and the base spans. Their format and context become a few small whole numbers, so all
candidates of a corpus are one table of feature values with counts, bounded by the number of values. Gradient-boosted trees
are fitted to it on the driver. Checked base spans of a candidate's kind stand for the same span in a loose form: they are
the positives, described without what only a base form shows. Failed checks and spans of another kind are the negatives; a
loose span that passes is unlabelled, however frequent. Per kind, the least score that keeps the wanted precision on
labelled spans of texts the trees have not seen is the threshold. The trees become a SQL expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh

KINDS = ("email", "ip", "card", "phone")
#: The base forms. Possessive where no later part could need a character back, so that long runs need no stack; the first
#: group of email and ip starts where a run starts, or where the last match ended, as every leftmost match does.
BASE = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text with a match of the base form must hold; cheaper to look for.
BASE_GATES = (r"@", r"[0-9]\.[0-9]+\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){13}", r"\+[0-9]")
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_AT = r"(?:\x20?@\x20?|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
#: Loose forms of the same kinds: written-out mail addresses, defanged addresses, cards with other separators, phones without +.
LOOSE = (
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,5}}",
    r"(?<![0-9])[0-9]{1,3}(?:\[?\.\]?[0-9]{1,3}){3}(?![0-9])",
    r"(?<![0-9])[0-9]{4}(?:[\x20._/-]?[0-9]{2,6}){2,4}(?![0-9])",
    r"(?<![0-9])\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
)
LOOSE_GATES = (r"(?i)@|[\[({ ]at[\])} ]", r"[0-9]\]?\.\[?[0-9]+\[?\.", r"[0-9]{4}[\x20._/-]?[0-9]{2}", r"[0-9]{3}[\x20./-][0-9]{4}")
CUES = (
    r"(?i)(?:mail|contact|write|reach|from)", r"(?i)(?:\bip\b|host|server|address)", r"(?i)(?:card|visa|pay|credit|debit|account)",
    r"(?i)(?:tel|phone|call|fax|mobile|cell)",
)
CONTEXT = 24
#: Items of a fold between two copies of its result; base spans of a text that are compared one by one; code points of a text's
#: chunks, and of a text that is cut into them.
BLOCK_ITEMS, FEW, CHUNK, LONG = 256, 8, 1024, 8192
FEATURES = ("kind", "digits", "checked", "cue", "before", "after")
ROUNDS, DEPTH, RATE = 16, 2, 0.5
PRECISION = 0.95


def folded(items: Column, begin: Column, made: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Array of what a running position makes of each item; `step`: (position, item) -> (next position, array to append).

    The items are taken in blocks, so appending copies a block and not all that was made before; `made` is the result's type.
    """
    none = F.array().cast(made)

    def state(at: Column, found: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), found.alias("found"))

    def one(now: Column, item: Column) -> Column:
        at, new = step(now["at"], item)
        return state(at, F.concat(now["found"], new))

    def fold(own: Column) -> Column:
        def block(now: Column, k: Column) -> Column:
            inner = F.aggregate(F.slice(own, k * BLOCK_ITEMS + 1, BLOCK_ITEMS), state(now["at"], none), one)
            return F.aggregate(F.array(inner), now, lambda old, new: state(new["at"], F.concat(old["found"], new["found"])))

        blocks = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK_ITEMS).cast("int"))
        short = F.aggregate(own, state(begin, none), one, lambda x: x["found"])
        long = F.aggregate(blocks, state(begin, none), block, lambda x: x["found"])
        return F.when(F.size(own) <= BLOCK_ITEMS, short).otherwise(long)

    # A lambda binds the items, and above a block's result, to a name: they are worked out once.
    return F.coalesce(F.get(F.transform(F.array(items), fold), F.lit(0)), none)


def located(text: Column, pattern: str, gate: str) -> Column:
    """Array of (start, end, match) of the leftmost matches that do not overlap, in code points, end exclusive."""
    whole = F.lit(r"\G([\s\S]*?)(" + pattern + ")")  # \G: one pass, also where no further match follows
    pieces = F.when(text.rlike(gate), F.arrays_zip(F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"), F.regexp_extract_all(text, whole, F.lit(2)).alias("match")))

    def step(at: Column, piece: Column) -> tuple[Column, Column]:
        start = at + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        return end, F.array(F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match")))

    return folded(pieces, F.lit(0), "array<struct<start:int,end:int,match:string>>", step)


def chunks_of(text: Column) -> Column:
    """A long text in pieces of CHUNK code points, so that a part of it is found without counting from its start."""
    return F.when(F.length(text) > LONG, F.regexp_extract_all(text, F.lit(f"[\\s\\S]{{1,{CHUNK}}}"), F.lit(0)))


def part_of(text: Column, chunks: Column, start: Column, length: Column) -> Column:
    """`length` code points of the text from `start` (from 0)."""
    first = F.floor(start / CHUNK).cast("int")
    near = F.array_join(F.slice(chunks, first + 1, F.floor((start + length) / CHUNK).cast("int") - first + 1), "")
    return F.when(chunks.isNull(), F.substring(text, start + 1, length)).otherwise(F.substring(near, start - first * CHUNK + 1, length))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second from the right doubled, ends in 0."""
    def step(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(k % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def passes(kind: int, match: Column) -> Column:
    digits = digits_of(match)
    return (
        F.lit(True),
        match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False),
        F.length(digits).between(10, 15),
    )[kind]


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of all base spans, by start, then kind; kind: place in KINDS."""
    def of(kind: int) -> Column:
        right = F.filter(located(text, BASE[kind], BASE_GATES[kind]), lambda x: passes(kind, x["match"]))
        return F.transform(right, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    return F.array_sort(F.concat(*map(of, range(len(KINDS)))))


def kinds_of(base: Column) -> Column:
    """The base spans of each kind: ascending, and none overlaps the next."""
    def of(kind: int) -> Column:
        return F.filter(base, lambda b: b["kind"] == kind)

    return F.array(*map(of, range(len(KINDS))))


def below(spans: Column, side: str, value: Column, equal: bool) -> Column:
    """How many of the ascending spans have their start or end below the value (or equal to it), by binary search."""
    top = F.floor(F.log2(F.size(spans))).cast("int")

    def step(at: Column, k: Column) -> Column:
        further = at + F.call_function("shiftleft", F.lit(1), top - k)
        found = F.get(spans, further - 1)[side]
        return F.when((further <= F.size(spans)) & ((found <= value) if equal else (found < value)), further).otherwise(at)

    return F.when(F.size(spans) == 0, 0).otherwise(F.aggregate(F.sequence(F.lit(0), top), F.lit(0), step))


def hull(spans: Column, x: Column) -> tuple[Column, Column]:
    """Start of the first and end of the last of one kind's spans that a candidate touches; null if it touches none."""
    last = below(spans, "start", x["end"], False)
    first = below(spans, "end", x["start"], True) + 1
    touched = first <= last
    return F.when(touched, F.get(spans, first - 1)["start"]), F.when(touched, F.get(spans, last - 1)["end"])


def _char_class(char: Column) -> Column:
    return F.when(char.rlike(r"^[\p{L}\p{N}]"), 1).when(char.rlike(r"^\S"), 2).otherwise(0)


def touches(base: Column, kinds: Column, x: Column) -> Column:
    """Whether a candidate touches a base span of any kind."""
    few = F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    many = F.exists(kinds, lambda own: F.coalesce(F.get(own, below(own, "start", x["end"], False) - 1)["end"] > x["start"], F.lit(False)))
    return F.when(F.size(base) <= FEW, few).otherwise(many)


def candidates(text: Column, chunks: Column, base: Column, kinds: Column) -> Column:
    """Array of (start, end, the FEATURES, touched, label) of all generators' spans.

    What joins a candidate's parts is no feature, and context is that of the base spans of its kind that it touches, if any: a
    plus sign or a plain dot would tell base forms from loose ones. The label is 1 if it touches a base span of its kind, 0 if
    it touches only one of another kind or fails its check, else null.
    """
    def described(kind: int, x: Column, own_start: Column, own_end: Column) -> Column:
        start, end = F.least(x["start"], own_start), F.greatest(x["end"], own_end)
        match, digits = x["match"], F.length(digits_of(x["match"]))
        octets = match.rlike(rf"^{OCTET}(?:\[?\.\]?{OCTET}){{3}}$")
        checked = (
            match.rlike(r"[A-Za-z]{2,}$") & ~(match.rlike(r"(?i)\x20at\x20") & match.rlike(r"\.[A-Za-z0-9-]+$")),  # 'at home.Then' is prose
            octets,
            F.when(digits.between(13, 19), luhn(digits_of(match))).otherwise(False),
            ~match.rlike(r"^\(?(?:000|555)"),
        )[kind]
        before = part_of(text, chunks, F.greatest(start - CONTEXT, F.lit(0)), F.least(start, F.lit(CONTEXT)))
        touched = touches(base, kinds, x)
        values = [
            F.lit(kind),
            F.when(digits < 10, 0).when(digits == 10, 1).when(digits < 13, 2).when(digits < 16, 3).when(digits == 16, 4).otherwise(5),
            checked.cast("int"),
            before.rlike(CUES[kind]).cast("int"),
            _char_class(F.substring(before, -1, 1)),
            _char_class(part_of(text, chunks, end, F.lit(1))),
        ]
        named = [f.cast("int").alias(name) for f, name in zip(values, FEATURES, strict=True)]
        label = F.when(own_start.isNotNull(), 1).when(touched | ~F.coalesce(checked, F.lit(False)), 0)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), *named, touched.alias("touched"), label.alias("label"))

    def of(kind: int) -> Column:
        own = F.get(kinds, F.lit(kind))

        def placed(x: Column) -> Column:
            start, end = hull(own, x)
            return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), start.alias("own_start"), end.alias("own_end"))

        found = F.transform(located(text, LOOSE[kind], LOOSE_GATES[kind]), placed)
        return F.transform(found, lambda x: described(kind, x, x["own_start"], x["own_end"]))

    return F.concat(*map(of, range(len(KINDS))))


def with_candidates(docs: DataFrame, keep: list[Column], text_column: str) -> DataFrame:
    """The columns `keep` with text, base and found (see `candidates`) of every row; a null text is an empty text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = docs.select(*keep, text.alias("text"), chunks_of(text).alias("chunks"), base_spans(text).alias("base"))
    found = found.withColumn("kinds", kinds_of(F.col("base")))
    return found.withColumn("found", candidates(*map(F.col, ("text", "chunks", "base", "kinds"))))


Tree = tuple  # (feature, limit, tree up to the limit, tree above it), or (value,)


def grow(rows: list[tuple], slopes: list[tuple[float, float]], depth: int) -> Tree:
    """The tree that lowers the logistic loss most; rows: feature values; slopes: first and second derivatives."""
    g, h = sum(s[0] for s in slopes), sum(s[1] for s in slopes)
    leaf = (RATE * g / (h + 1.0),)
    best, cut = g * g / (h + 1.0) + 1e-9, None
    for f in range(len(FEATURES)) if depth else ():
        for limit in sorted({r[f] for r in rows})[:-1]:
            a = [s for r, s in zip(rows, slopes, strict=True) if r[f] <= limit]
            ga, ha = sum(s[0] for s in a), sum(s[1] for s in a)
            gain = ga * ga / (ha + 1.0) + (g - ga) ** 2 / (h - ha + 1.0)
            if gain > best:
                best, cut = gain, (f, limit)
    if not cut:
        return leaf
    f, limit = cut
    low = [k for k, r in enumerate(rows) if r[f] <= limit]
    high = [k for k, r in enumerate(rows) if r[f] > limit]
    return (f, limit, *[grow([rows[k] for k in side], [slopes[k] for k in side], depth - 1) for side in (low, high)])


def value_of(tree: Tree, row: tuple) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def boost(table: list[tuple[tuple, float, float]]) -> list[Tree]:
    """Trees for (feature values, count, positives); their sum is a log-odds."""
    total, positive = sum(x[1] for x in table), sum(x[2] for x in table)
    trees: list[Tree] = [(math.log((positive + 0.5) / (total - positive + 0.5)),)]
    rows, scores = [x[0] for x in table], [trees[0][0]] * len(table)
    for _ in range(ROUNDS):
        odds = [1 / (1 + math.exp(-s)) for s in scores]
        tree = grow(rows, [(x[2] - x[1] * p, x[1] * p * (1 - p)) for x, p in zip(table, odds, strict=True)], DEPTH)
        trees.append(tree)
        scores = [s + value_of(tree, r) for s, r in zip(scores, rows, strict=True)]
    return trees


def as_sql(tree: Tree, x: Column) -> Column:
    if len(tree) == 1:
        return F.lit(float(tree[0]))
    return F.when(x[FEATURES[tree[0]]] <= tree[1], as_sql(tree[2], x)).otherwise(as_sql(tree[3], x))


class Model:
    """Trees and a threshold per kind (None: nothing of the kind is added)."""

    def __init__(self, trees: list[Tree], thresholds: list[float | None]):
        self.trees, self.thresholds = trees, thresholds

    def accepts(self, x: Column) -> Column:
        score = F.lit(0.0)
        for tree in self.trees:
            score = score + as_sql(tree, x)
        limit = F.lit(math.inf)
        for kind, threshold in enumerate(self.thresholds):
            if threshold is not None:
                limit = F.when(x["kind"] == kind, F.lit(threshold)).otherwise(limit)
        return score >= limit


def fit(docs: DataFrame, text_column: str = "text", precision: float = PRECISION) -> Model:
    """Count the labelled candidates of all texts by feature values, boost on half of the texts, set thresholds on the other.

    A kind without a positive on the other half takes its threshold from all texts; without any, nothing of it is added.
    """
    found = with_candidates(docs, [], text_column).select((F.xxhash64("text") % 2 == 0).alias("seen"), "found")
    # outer: the filter that explode infers would be pushed down and find the candidates anew
    rows = found.select("seen", F.explode_outer("found").alias("x")).select("seen", "x.*").where("label is not null")
    counted = rows.groupBy(*FEATURES).agg(*[F.sum(F.when(part, value).otherwise(0)).alias(name) for name, part, value in (
        ("n", F.col("seen"), 1), ("hits", F.col("seen"), F.col("label")), ("held_n", ~F.col("seen"), 1), ("held_hits", ~F.col("seen"), F.col("label")),
    )])
    width = len(FEATURES)
    table = [(tuple(r[:width]), *r[width:]) for r in counted.orderBy(*FEATURES).collect()]  # at most the number of feature values, 864
    if not table:
        return Model([], [None] * len(KINDS))
    trees = boost([(x, n, hits) for x, n, hits, _, _ in table if n] or [(x, n, hits) for x, _, _, n, hits in table])
    thresholds: list[float | None] = []
    for kind in range(len(KINDS)):
        own = [x for x in table if x[0][0] == kind]
        own = [(x, n, hits) for x, _, _, n, hits in own] if any(x[4] for x in own) else [(x, n + m, hits) for x, n, hits, m, _ in own]
        scored = sorted(((sum(value_of(t, x) for t in trees), n, hits) for x, n, hits in own if n), reverse=True)
        total = right = 0
        threshold = None
        for score, n, hits in scored:
            total, right = total + n, right + hits
            if right >= precision * total:
                threshold = score - 1e-9
        thresholds.append(threshold)
    return Model(trees, thresholds)


def with_spans(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """(row, base, spans): the row as a struct, its base spans, and all spans as arrays of (start, kind, end).

    Candidates that touch a base span add nothing and are left out; of added spans that overlap, all stay. A null text is an
    empty text. Rows stay one to one.
    """
    found = with_candidates(docs, [F.struct(*docs.columns).alias("row")], text_column)
    added = F.filter("found", lambda x: model.accepts(x) & ~x["touched"])
    added = F.transform(added, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return found.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of the first, in brackets."""
    names = F.array(*[F.lit(f"[{x.upper()}]") for x in KINDS])
    none = F.array().cast("array<struct<at:int,start:int,kind:int>>")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        run = F.array(F.struct(at.alias("at"), x["start"].alias("start"), x["kind"].alias("kind")))
        return F.greatest(at, x["end"]), F.when(x["start"] < at, none).otherwise(run)

    runs = folded(spans, F.lit(0), "array<struct<at:int,start:int,kind:int>>", step)
    chunks = chunks_of(text)
    # Folds of one item bind the chunks and runs to names, so that they are worked out once.
    def joined(found: Column) -> Column:
        gaps = F.transform(found["runs"], lambda x: F.concat(part_of(text, found["chunks"], x["at"], x["start"] - x["at"]), F.get(names, x["kind"])))
        end = F.aggregate(spans, F.lit(0), lambda last, x: F.greatest(last, x["end"]))
        return F.concat(F.array_join(gaps, ""), part_of(text, found["chunks"], end, F.length(text) - end))

    bound = F.transform(F.array(F.struct(runs.alias("runs"), chunks.alias("chunks"))), joined)
    return F.when(F.size(spans) == 0, text).otherwise(F.get(bound, F.lit(0)))


def redact(docs: DataFrame) -> DataFrame:
    """Replace personal data in `text`; all columns and rows stay, and n_chars, where there is one, is set anew."""
    marked = with_spans(docs, fit(docs))
    clean = fresh(docs, "clean")
    out = marked.select("row.*", redacted(F.col("row.text"), F.col("spans")).alias(clean))
    new = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
