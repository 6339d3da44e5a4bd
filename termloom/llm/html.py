"""Main text of web pages: a bidirectional LSTM in numpy labels the blocks of a page.

A page is cut into blocks, the runs of text between block-level tags. A block is read as a vector: its tag path (tags with
their classes and ids, hashed), its words (hashed) and a few proportions. The network reads the blocks of a page in both
directions, so every block is judged in the context of the whole page. It learns from a bounded sample of pages that have a
main element; their containers are renamed and other boilerplate is put between their blocks, so that it does not rely on
one template. At prediction time only the network decides.
"""

from __future__ import annotations

import html
import random
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, kept_by_worker

#: Pages that reach the driver to learn from, and their UTF-8 bytes together, at most. All pages are labelled, and whole.
SAMPLE_PAGES, SAMPLE_BYTES = 200, 8 << 20
#: Blocks that the network learns from in one run; longer pages are learned from in several.
RUN_BLOCKS = 300
PATH_SIZE, WORD_SIZE, HIDDEN = 160, 32, 24
EPOCHS, RATE, VARIANTS = 8, 0.01, 3
#: Pages that run through the network together, and their blocks (padding included) at most.
PAGES_AT_ONCE, BLOCKS_AT_ONCE = 128, 60_000
SEED = 7

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+")
#: Elements of HTML by how they are read.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title".split())
#: Raw elements whose content is no markup; nothing but their own closing tag ends them.
PLAIN = frozenset("script style noscript iframe textarea title".split())
CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Containers of the main text, and of everything else, for the weak labels and the made-up variants.
MAIN = ("article", "main")
OTHER = frozenset("nav header footer aside form button select menu dialog".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement banner sponsor promo cookie cookies notice consent popup modal sidebar related share social menu nav navigation "
    "breadcrumb breadcrumbs comment comments reply replies newsletter subscribe footer header widget disclaimer login search".split()
)
MAIN_PATHS = ("article", "main", "main>article", "div.content", "div#content", "div.post", "div.entry", "section.article", "div.story", "div.main>div.text", "div#main", "")
OTHER_PATHS = (
    "nav>ul>li", "div.menu>ul>li", "header>div", "header>h1", "div.header>p", "footer>p", "div.footer>div", "footer", "aside>p", "aside.sidebar>div", "div.sidebar>ul>li",
    "div.cookie>p", "div.notice>p", "div.consent>div", "div.ad", "div.advert>p", "div.banner>p", "div.promo>div", "form>p", "form>div", "form.search>div",
    "section.comments>div.comment>p", "div.comments>div>p", "ol.comments>li>p", "div#comments>p", "div.related>ul>li", "div.share>p", "div.newsletter>p", "ul.breadcrumb>li",
)


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    linked: float


def _steps(tag: str, attributes: str) -> str:
    """tag, then its class, id and role words, blank-joined."""
    words = [w for m in ATTRIBUTE.finditer(attributes) for w in NAME.findall((m[2] or m[3] or m[4] or "").lower())] if attributes else []
    return " ".join([tag, *words])


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; raw elements, comments and white space alone make none."""
    out: list[Block] = []
    path: list[str] = []
    texts: list[str] = []
    at = links = linked = 0
    skip = ""
    closings: dict[str, tuple[int, int]] = {}

    def closing(tag: str) -> tuple[int, int]:
        """(start, end) of the next closing tag from here on; the page's length where there is none."""
        if closings.get(tag, (-1, -1))[0] < at:
            m = CLOSING[tag].search(page, at)
            closings[tag] = m.span() if m else (len(page), len(page))
        return closings[tag]

    def close() -> None:
        nonlocal linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                out.append(Block(tuple(path), text, min(1.0, linked / len(text))))
            texts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skip:
            texts.append(text)
            linked += len(text) if links else 0

    def leave(tag: str) -> None:
        for k in range(len(path) - 1, -1, -1):
            if path[k].split(" ", 1)[0] == tag:
                del path[k:]
                return

    while token := TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        end, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            if token[0].startswith("<![CDATA[") and not skip:
                add(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        tag = name.lower()
        if skip:
            skip = "" if end and tag == skip else skip
            if tag in PLAIN and not end and not attributes.endswith("/") and closing(tag)[0] < closing(skip)[0]:
                at = closing(tag)[1]
            continue
        if tag == "head":
            close()  # what a head may hold is raw or without text, so a head needs no end
            continue
        if tag == "body":
            continue
        if tag in RAW and not end:
            if tag not in INLINE:
                close()
            if not attributes.endswith("/"):
                if tag in PLAIN:
                    at = closing(tag)[1]
                else:
                    skip = tag
            continue
        if tag == "a":
            links = max(0, links + (-1 if end else 1))
        if tag in INLINE:
            if tag == "br":
                add(" ")
            continue
        close()
        links = 0
        if end:
            leave(tag)
        elif tag not in VOID and not attributes.endswith("/"):
            if path and path[-1].split(" ", 1)[0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd"):
                path.pop()  # these end where another block starts
            if tag in ("li", "tr", "td", "th", "option") and path and path[-1].split(" ", 1)[0] == tag:
                path.pop()
            path.append(_steps(tag, attributes))
    add(page[at:])
    close()
    return out


def _row(table: np.ndarray, at: int, name: str, value: float) -> None:
    h = zlib.crc32(name.encode())
    table[at + h % PATH_SIZE] += value if h & (1 << 30) else -value


def vectors(found: list[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words, proportions."""
    out = np.zeros((len(found), PATH_SIZE + WORD_SIZE + 8), np.float32)
    rows: dict[tuple[str, ...], np.ndarray] = {}
    for k, block in enumerate(found):
        row = rows.get(block.path)
        if row is None:
            row = rows[block.path] = np.zeros(PATH_SIZE, np.float32)
            names = {name for step in block.path for name in _names(step)}
            for name in names:
                _row(row, 0, "in " + name, 1.0)
            if block.path:
                _row(row, 0, "leaf " + block.path[-1].split(" ", 1)[0], 1.0)
        out[k, :PATH_SIZE] = row
        words = block.text.lower().split()
        hashed = np.bincount([zlib.crc32(w.encode()) % WORD_SIZE for w in words], minlength=WORD_SIZE)
        out[k, PATH_SIZE : PATH_SIZE + WORD_SIZE] = hashed / len(words) ** 0.5 / 4
        text, n = block.text, len(block.text)
        out[k, -8:] = (
            np.log1p(n) / 8, np.log1p(len(words)) / 6, block.linked, sum(map(text.count, ".,;:!?")) / n * 10,
            float(text[-1] in ".!?"), k / len(found), float(k == 0), float(not block.path),
        )
    return out


def _names(step: str) -> list[str]:
    """The names of a step: its tag, and its class and id words (the same name wherever it stands)."""
    tag, *words = step.split(" ")
    return [tag, *words]


class Network(NamedTuple):
    """Input, state and bias weights of both directions, the weights of the output, and how many pages were learned from."""

    ahead: tuple[np.ndarray, np.ndarray, np.ndarray]
    back: tuple[np.ndarray, np.ndarray, np.ndarray]
    out: np.ndarray
    pages: int = 0

    def scores(self, x: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Log-odds that blocks are main text; x: blocks x pages x values, real: blocks that are no padding."""
        a, _ = _run(self.ahead, x, real, range(len(x)))
        b, _ = _run(self.back, x, real, range(len(x) - 1, -1, -1))
        return np.concatenate([a, b, np.ones((*a.shape[:2], 1), a.dtype)], axis=2) @ self.out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _run(weights: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray, real: np.ndarray, order, learning: bool = False) -> tuple[np.ndarray, list]:
    """The outputs of one direction; when learning, with what the slopes need of every step."""
    inputs, state, bias = weights
    size = state.shape[0]
    z_in = x @ inputs + bias
    h = c = np.zeros((x.shape[1], size), x.dtype)
    out, kept = np.zeros((len(x), x.shape[1], size), x.dtype), []
    for t in order:
        z = z_in[t] + h @ state
        gates, g = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        m = real[t][:, None]
        new = f * c + i * g
        shown = np.tanh(new)
        if learning:
            kept.append((t, i, f, o, g, c, h, shown, m))
        c, h = np.where(m, new, c), np.where(m, o * shown, h)
        out[t] = h
    return out, kept


def _slopes(weights: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray, kept: list, above: np.ndarray) -> list[np.ndarray]:
    """Derivatives of the loss by the weights of one direction, from those by its outputs."""
    inputs, state, bias = weights
    d_in, d_state, d_bias = np.zeros_like(inputs), np.zeros_like(state), np.zeros_like(bias)
    dh = dc = np.zeros((x.shape[1], state.shape[0]))
    for t, i, f, o, g, c, h, shown, m in reversed(kept):
        dh = dh + above[t]
        through = np.where(m, dh, 0.0)
        d_new = np.where(m, dc, 0.0) + through * o * (1 - shown**2)
        dz = np.hstack([d_new * g * i * (1 - i), d_new * c * f * (1 - f), through * shown * o * (1 - o), d_new * i * (1 - g**2)])
        d_in += x[t].T @ dz
        d_state += h.T @ dz
        d_bias += dz.sum(axis=0)
        dh = np.where(m, 0.0, dh) + dz @ state.T
        dc = np.where(m, d_new * f, dc)
    return [d_in, d_state, d_bias]


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, sequences))
    x = np.zeros((length, len(sequences), sequences[0].shape[1]), np.float32)
    real = np.zeros((length, len(sequences)), bool)
    for k, rows in enumerate(sequences):
        x[: len(rows), k], real[: len(rows), k] = rows, True
    return x, real


def weak_labels(found: list[Block]) -> list[bool] | None:
    """Main text is inside a main element and in no other container; None for a page without a main element."""
    def main(block: Block) -> bool:
        names = [_names(step) for step in block.path]
        first = next((k for k, n in enumerate(names) if n[0] in MAIN), None)
        return first is not None and not any(n[0] in OTHER or OTHER_NAMES & set(n[1:]) for n in names)

    labels = [main(x) for x in found]
    return labels if any(labels) else None


def variant(found: list[Block], labels: list[bool], texts: list[str], dice: random.Random) -> tuple[list[Block], list[bool]]:
    """The page with its main container renamed and made-up boilerplate around and between its blocks."""
    def steps(path: str) -> tuple[str, ...]:
        """The steps of a path; none for the empty path, a page whose text is in no container."""
        return tuple(re.sub(r"[.#]", " ", step) for step in path.split(">") if step)

    container = steps(dice.choice(MAIN_PATHS))
    out: list[tuple[Block, bool]] = []

    def extra(inside: bool) -> None:
        path = (*container, *steps(dice.choice(OTHER_PATHS))) if inside else steps(dice.choice(OTHER_PATHS))
        for _ in range(dice.choice((1, 1, 2, 4))):
            words = dice.choice(texts).split()
            text = " ".join(words[: dice.choice((1, 2, 6, 30, 200))])
            out.append((Block(path, text, 1.0 if path[-1] == "li" and dice.random() < 0.7 else 0.0), False))

    for k, (block, label) in enumerate(zip(found, labels, strict=True)):
        if label:
            start = next(i for i, step in enumerate(block.path) if step.split(" ")[0] in MAIN)
            block = block._replace(path=(*container, *block.path[start + 1 :]))
        if dice.random() < 0.15 or k == 0:
            extra(label and dice.random() < 0.6)
        if label or dice.random() < 0.7:
            out.append((block, label))
    for _ in range(dice.choice((0, 1, 3))):
        extra(dice.random() < 0.4)
    return [x[0] for x in out], [x[1] for x in out]


def train(pages: list[str]) -> Network:
    """Fit on the sampled pages and their variants, on all their blocks.

    Without a page that has a main element, the variants of a few made-up lines must do; `pages` is 0 then.
    """
    dice, noise = random.Random(SEED), np.random.default_rng(SEED)
    size = PATH_SIZE + WORD_SIZE + 8
    shapes = [(size, 4 * HIDDEN), (HIDDEN, 4 * HIDDEN), (4 * HIDDEN,)] * 2 + [(2 * HIDDEN + 1,)]
    weights = [noise.standard_normal(s) * (0.1 if len(s) > 1 else 0.0) for s in shapes]
    cut = [x for x in ((b, weak_labels(b)) for b in map(blocks, pages)) if x[1]]
    learned = len(cut)
    if not cut:
        lines = [Block(("article", "p"), f"A line of text, number {k}, that ends here.", 0.0) for k in range(6)]
        cut = [(lines, [True] * len(lines))] * 20
    texts = [b.text for found, _ in cut for b in found]
    examples = [x for found, labels in cut for x in [(found, labels), *[variant(found, labels, texts, dice) for _ in range(VARIANTS)]]]
    whole = [(vectors(found), np.array(labels)) for found, labels in examples]
    runs = [(v[k : k + RUN_BLOCKS], labels[k : k + RUN_BLOCKS]) for v, labels in whole for k in range(0, len(v), RUN_BLOCKS)]
    data = sorted(runs, key=lambda x: len(x[0]))
    first, second, steps = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        for at in noise.permutation(range(0, len(data), 16)).tolist():
            batch = data[at : at + 16]
            x, real = padded([v for v, _ in batch])
            gold = np.zeros(real.shape)
            for k, (_, labels) in enumerate(batch):
                gold[: len(labels), k] = labels
            ahead, kept_a = _run(tuple(weights[:3]), x, real, range(len(x)), True)
            back, kept_b = _run(tuple(weights[3:6]), x, real, range(len(x) - 1, -1, -1), True)
            seen = np.concatenate([ahead, back, np.ones((*ahead.shape[:2], 1))], axis=2)
            slope = (_sigmoid(seen @ weights[6]) - gold) * real / max(1, real.sum())
            above = slope[..., None] * weights[6]
            slopes = [
                *_slopes(tuple(weights[:3]), x, kept_a, above[..., :HIDDEN]),
                *_slopes(tuple(weights[3:6]), x, kept_b, above[..., HIDDEN : 2 * HIDDEN]),
                np.einsum("tbk,tb->k", seen, slope),
            ]
            steps += 1
            for k, d in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.99 * second[k] + 0.01 * d**2
                weights[k] = weights[k] - RATE * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-8)
    small = [w.astype(np.float32) for w in weights]
    return Network(tuple(small[:3]), tuple(small[3:6]), small[6], learned)


def main_texts(network: Network, pages: list[str | None]) -> list[str]:
    """The main text of each page: its blocks with positive log-odds, line by line."""
    found = [blocks(page or "") for page in pages]
    out = [""] * len(pages)
    order = sorted((k for k, x in enumerate(found) if x), key=lambda k: len(found[k]))
    while order:
        take = max(1, min(PAGES_AT_ONCE, BLOCKS_AT_ONCE // len(found[order[-1]])))
        part, order = order[-take:], order[:-take]
        scores = network.scores(*padded([vectors(found[k]) for k in part]))
        for place, k in enumerate(part):
            out[k] = "\n".join(b.text for b, s in zip(found[k], scores[: len(found[k]), place].tolist(), strict=True) if s > 0)
    return out


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, html) of the pages that weak labels can be had for, each distinct page once per task."""
    seen: set[int] = set()
    for batch in batches:
        for hash_, page in zip(batch.column("hash").to_pylist(), batch.column("html"), strict=True):
            if hash_ not in seen:
                seen.add(hash_)
                if weak_labels(blocks(page.as_py())):
                    yield pa.record_batch([pa.array([hash_], pa.int64()), pa.array([page.as_py()], pa.string())], ["hash", "html"])


def sample(pages: DataFrame, html_column: str = "html") -> list[str]:
    """At most SAMPLE_PAGES distinct pages with main text in a main element, the least by a hash of their html.

    Copies count once; a page that would take the sample over SAMPLE_BYTES, the driver's share, is left out, whatever its
    length is. Only hashes of pages that may have a main element are sorted; where too few of the first ones have
    weak labels, more follow, four times as many each time, until the bound is reached or no page is left.
    """
    rows = pages.where(F.length(html_column) > 0).select(F.xxhash64(html_column).alias("hash"), F.col(html_column).alias("html"))
    rest, found, take, room = rows, [], 2 * SAMPLE_PAGES, SAMPLE_BYTES
    while len(found) < SAMPLE_PAGES:
        likely = rest.where(F.col("html").rlike(r"(?i)<(?:article|main)[\s/>]"))
        n, last = likely.select("hash").distinct().orderBy("hash").limit(take).agg(F.count("*"), F.max("hash")).first()
        if not n:
            break
        part = likely.where(F.col("hash") <= last).mapInArrow(_labelled, "hash long, html string").dropDuplicates(["hash"])
        fitting = []
        for x in part.select("hash", F.octet_length("html").alias("size")).orderBy("hash").limit(SAMPLE_PAGES - len(found)).collect():
            if x["size"] <= room:
                fitting.append(x["hash"])
                room -= x["size"]
        found += [x.html for x in part.where(F.col("hash").isin(fitting)).orderBy("hash").collect()] if fitting else []
        if n < take:
            break
        rest, take = rows.where(F.col("hash") > last), 4 * take
    return found


def fit(pages: DataFrame, html_column: str = "html") -> Network:
    """Train on the sampled pages."""
    return train(sample(pages, html_column))


def extract(pages: DataFrame, network: Network, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """(the columns of `keep`, text) of every page. A null or blank page has an empty text. Rows stay one to one."""
    names = keep or []
    shared, run = pages.sparkSession.sparkContext.broadcast(network), uuid.uuid4().hex
    schema = ", ".join([*[f"`{n}` {pages.schema[n].dataType.simpleString()}" for n in names], "text string"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept_by_worker("html", run, lambda: shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                texts = main_texts(own, part.column(len(names)).to_pylist())
                yield pa.record_batch([*part.columns[: len(names)], pa.array(texts, pa.string())], [*names, "text"])

    return pages.select(*names, F.col(html_column).alias(fresh(pages, "whole_page"))).mapInArrow(work, schema)
