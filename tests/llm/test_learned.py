"""Classifiers, personal data, main texts and neighbours against plain versions and on held-out rows."""

import hashlib
import random
import re

import helpers
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termloom.llm import html, langid, neighbours, pii, quality, queries

DATA = "/root/testdata/sf0.001"


# ---- quality --------------------------------------------------------------------------------------


def test_isotonic_is_the_best_ascending_fit():
    levels = quality.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.2, 0.8, 0.5, 0.9]))
    assert levels.tolist() == pytest.approx([0.2, 0.6, 0.6, 0.9])


def test_summed_normal_equations_equal_one_solve(spark):
    docs = spark.createDataFrame([(k, helpers.prose(k, 20 + k) + (" ###" * (k % 7) if k % 3 == 0 else "")) for k in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(120)], "doc_id long, quality int, toxic int")
    found = quality.with_statistics(docs)
    model = quality.learn(found, labels)
    rows = found.join(labels, F.col("id") == F.col("doc_id")).where(~quality.held_out("id", 5, 0)).collect()
    x = model.features(np.array([[r[c] for c in quality.STATISTICS] for r in rows]))
    y = np.array([r.quality for r in rows], float)
    penalty = np.eye(x.shape[1]) * 1e-3 * len(rows)
    penalty[-1, -1] = 1e-9 * 1e-3 * len(rows)
    assert np.allclose(x @ np.linalg.solve(x.T @ x + penalty, x.T @ y), x @ model.weights[:, -1], atol=1e-5)


def test_one_sum_reaches_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "Some words. " * (k % 7) + "!" * (k % 3)) for k in range(200)], "doc_id long, text string").repartition(40)
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(200)], "doc_id long, quality int")
    found, sent, collect = quality.with_statistics(docs), [], type(docs).collect

    def seen(df):
        rows = collect(df)
        sent.extend(len(x.total) for x in rows if "total" in x)
        return rows

    monkeypatch.setattr(type(docs), "collect", seen)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        quality.learn(found, labels)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sent) == quality.SLICES and sum(sent) == 8 * quality.FOLDS * (quality.FEATURES + 1) * (quality.FEATURES + 2)


def test_quality_on_held_out_rows(spark):
    rows = queries.op6_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(rows, on="doc_id")
    held = labels[labels.held_out]
    assert ((held.predicted == held.quality).mean() > 0.97) and rows.score.between(0, 1).all() and len(rows) == 1000
    assert (rows.predicted == (rows.score >= 0.3)).all()


def test_quality_of_odd_and_no_rows(spark):
    docs = helpers.odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.with_statistics(docs)
    assert quality.score(found, quality.learn(found, labels)).where("score between 0 and 1").count() == docs.count()
    unlabelled = quality.learn(found, labels.limit(0))
    kept = quality.keep_good(docs, unlabelled)
    assert kept.columns == docs.columns and kept.count() == docs.count()  # nothing learned: 0.5, all stay
    assert quality.keep_good(helpers.no_documents(spark), unlabelled).count() == 0


# ---- language -------------------------------------------------------------------------------------


def test_forward_backward_equals_all_paths():
    random_ = np.random.default_rng(1)
    emissions, moves = random_.normal(size=(1, 4, 3)), random_.normal(size=(3, 3))
    words, pairs = np.zeros((4, 3)), np.zeros((3, 3))
    total = 0.0
    for path in np.ndindex(3, 3, 3, 3):
        weight = np.exp(sum(emissions[0, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += weight
        for t, y in enumerate(path):
            words[t, y] += weight
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += weight
    got_words, got_pairs = langid.forward_backward(np.concatenate([emissions, np.zeros((1, 2, 3))], axis=1), np.array([[True] * 4 + [False] * 2]), moves)
    assert np.allclose(got_words[0, :4], words / total) and np.allclose(got_pairs, pairs / total) and not got_words[0, 4:].any()


def test_languages_on_held_out_rows_and_switched_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = langid.label(docs, model, keep=["doc_id", "lang"]).withColumn("held_out", quality.held_out("doc_id", 4, 2)).toPandas()
    held = rows[rows.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    texts = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 600)).first().text.split()[:60] for lang in ("en", "de")}
    labeller = langid.Labeller(model)
    mixed = [w for w in langid.WORD.findall(" ".join(texts["en"][:30] + texts["de"][:30]).lower())][: langid.SEGMENT]
    places = labeller.places([mixed])[0]
    words, _ = langid.forward_backward(labeller.table[np.array([places])], np.ones((1, len(places)), bool), model.moves)
    found = [model.languages[k] for k in words[0].argmax(axis=1)]
    assert found[:20].count("en") >= 14 and found[-20:].count("de") >= 14


def test_sampled_words_come_from_all_over_a_text(spark):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (3, 120, 121, 5000)]
    found = [r.s.split() for r in spark.createDataFrame([(t,) for t in texts], "text string").select(langid.sampled_words(F.col("text")).alias("s")).collect()]
    assert [" ".join(x) for x in found[:2]] == texts[:2] and all(100 < len(x) <= 120 for x in found[2:])
    places = [int(w[1:]) for w in found[3]]
    assert places == sorted(set(places)) and places[-1] > 2500 and sum(p >= 120 for p in places) >= 96


def test_words_are_letters_only():
    assert langid.WORD.findall("\u00b2 \u00bd \u2167 \u2460 12 _") == [] and langid.WORD.findall("a\u00b2b caf\u00e9 \u6f22") == ["a", "b", "caf\u00e9", "\u6f22"]


def test_language_of_odd_and_no_rows(spark):
    docs = helpers.odd_documents(spark)
    model = langid.fit(docs)
    rows = {r.doc_id: r for r in langid.label(docs, model, keep=["doc_id", "whole_text"]).collect()}
    assert [rows[k].lang_pred for k in (0, 1, 2)] == ["und"] * 3 and rows[0].score == 0.0
    nothing = langid.fit(helpers.no_documents(spark))
    assert {r.lang_pred for r in langid.label(docs, nothing).collect()} == {"und"}


# ---- personal data --------------------------------------------------------------------------------


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match)


RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
)


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k, (_, rule, check) in enumerate(RULES) for m in re.finditer(rule, text or "") if check(m[0]))


def test_base_spans_equal_the_rules(spark):
    dice = random.Random(4)
    parts = ["a.b", "@", "x-y.com", ".", "1.2.3.4", "255.256.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (212) 555-0123", "+", "12", " ", "-", "_", "é", "𝒳", "000000001.02.3.4", "\n", "a@b.c_d@e.f"]
    texts = ["".join(dice.choice(parts) for _ in range(dice.randint(1, 14))) for _ in range(1500)]
    texts += [*[t for t in helpers.ODD_TEXTS if t], "9" * 30_000, "a" * 30_000 + "@b.c", "a@" + "b." * 8000 + "c", "1." * 8000 + "1", "+1" + " " * 9000 + "2"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").repartition(8)
    rows = frame.select("k", pii.base_spans(F.col("text")).alias("s")).collect()
    assert {r.k: [(x.start, x.kind, x.end) for x in r.s] for r in rows} == {k: plain_spans(t) for k, t in enumerate(texts)}


def test_long_texts_with_thousands_of_spans(spark):
    """Blocks of folds, chunks of text and binary search give what the plain rules and a plain replacement give."""
    dice = random.Random(8)
    parts = ["mail a.b@c.org", "host 10.0.0.7", "pay 4111 1111 1111 1111", "call +49 30 1234567", "call 212-555-0143", "x at y dot org", "\U0001d4b3 漢", "1.2.3.999"]
    text = " ".join(dice.choice(parts) + " " * dice.randrange(3) for _ in range(6000))
    docs = spark.createDataFrame([(1, text), (2, " ".join(parts))], "doc_id long, text string")
    marked = pii.with_spans(docs, pii.fit(docs)).select("row.doc_id", "base", "spans", pii.redacted(F.col("row.text"), F.col("spans")).alias("clean"))
    for row in marked.collect():
        whole = text if row.doc_id == 1 else " ".join(parts)
        assert [tuple(x) for x in row.base] == plain_spans(whole)
        spans, at, out = [tuple(x) for x in row.spans], 0, []
        assert set(map(tuple, row.base)) <= set(spans) and spans == sorted(spans)
        for start, kind, end in spans:
            if start >= at:
                out += [whole[at:start], f"[{pii.KINDS[kind].upper()}]"]
            at = max(at, end)
        assert row.clean == "".join(out) + whole[at:]


def test_trees_score_alike_in_sql_and_plain(spark):
    dice = random.Random(2)
    rows = [tuple(dice.randint(0, 3) for _ in pii.FEATURES) for _ in range(200)]
    trees = pii.boost([(r, 3.0, 3.0 * (r[1] > 1 and r[4] == 0)) for r in rows])
    assert all((sum(pii.value_of(t, r) for t in trees) > 0) == (r[1] > 1 and r[4] == 0) for r in rows)
    frame = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in pii.FEATURES)).select(F.struct("*").alias("x"))
    score = sum((pii.as_sql(t, F.col("x")) for t in trees[1:]), pii.as_sql(trees[0], F.col("x")))
    assert [r[0] for r in frame.select(score).collect()] == pytest.approx([sum(pii.value_of(t, r) for t in trees) for r in rows])


def test_op2_counts_digests_and_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op2_pii(spark, DATA).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_spans(texts[row.doc_id])
        named = [f"{RULES[k][0]}:{a}:{b}" for a, k, b in base]
        assert hashlib.sha256(",".join(named).encode()).hexdigest() == row.base_sha256
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert set(named) <= set(row.spans.split(",") if row.spans else [])


def test_redaction(spark):
    docs = helpers.odd_documents(spark)
    more = [("mail a.b@c.org or call +1 (212) 555-0123 now", "mail [EMAIL] or call [PHONE] now"), ("1.2.3.4", "[IP]"), ("nothing here 4.0.", "nothing here 4.0."), ("𝒳 4111 1111 1111 1111!", "𝒳 [CARD]!")]
    frame = docs.unionByName(spark.createDataFrame([(100 + k, t, len(t)) for k, (t, _) in enumerate(more)], "doc_id long, text string, n_chars long"), allowMissingColumns=True)
    rows = pii.redact(frame)
    assert rows.columns == docs.columns
    by = {r.doc_id: r for r in rows.collect()}
    assert [by[100 + k].text for k in range(len(more))] == [w for _, w in more]
    assert by[100].n_chars == len(more[0][1]) and by[0].text is None and by[7].text == helpers.ODD_TEXTS[7]
    assert pii.redact(helpers.no_documents(spark)).count() == 0


@pytest.mark.parametrize("times", [1, 40])
def test_loose_forms_are_added_however_frequent(spark, times):
    """Loose forms once, or far more often than their base forms; what fails a check stays."""
    base = [f"mail a{k}.b@site.org now, call +1 (212) 555-01{k:02} or see host 10.0.{k}.1 today, card 4111 1111 1111 1111 here" for k in range(40)]
    loose = [f"mail a{k} [at] site [dot] org now, call (212) 555-01{k:02} or see host 10[.]0[.]{k}[.]1 today, card 4111.1111.1111.1111 here" for k in range(40)]
    plain = ["write jo at site dot org soon", "call 212-555-0123 soon"] * 20
    wrong = [f"mail a{k} at 3.{k} now, call 000-555-01{k:02} or see host 10[.]0[.]{k}[.]999 today, card 4111.1111.1111.1112 here" for k in range(40)]
    prose = [f"he was at home.Then {k} came" for k in range(20)]
    texts = base + [t + " x" * n for n in range(times) for t in loose + plain] + wrong + prose
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    rows = pii.with_spans(docs, pii.fit(docs)).select("row.text", pii.redacted(F.col("row.text"), F.col("spans")).alias("clean"), F.size("spans").alias("n"), F.size("base").alias("b")).collect()
    by = {r.text: r for r in rows}
    assert {by[t].n for t in loose} == {4} and {by[t].b for t in loose} == {0}
    assert {by[t].clean for t in loose} == {"mail [EMAIL] now, call [PHONE] or see host [IP] today, card [CARD] here"}
    assert {by[t].clean for t in plain} == {"write [EMAIL] soon", "call [PHONE] soon"}
    assert {by[t].n for t in wrong + prose} == {0}


# ---- pages ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def network(spark):
    return html.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_slopes_of_the_network_equal_differences():
    noise = np.random.default_rng(0)
    weights = tuple(noise.normal(size=s) * 0.5 for s in ((5, 12), (3, 12), (12,)))
    x, real, above = noise.normal(size=(4, 2, 5)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool), noise.normal(size=(4, 2, 3))

    def loss(w):
        return float((html._run(w, x, real, range(4))[0] * above).sum())

    slopes = html._slopes(weights, x, html._run(weights, x, real, range(4), True)[1], above)
    for k, at in ((0, (2, 7)), (1, (1, 4)), (2, (10,))):
        moved = [w.copy() for w in weights]
        moved[k][at] += 1e-6
        assert (loss(tuple(moved)) - loss(weights)) / 1e-6 == pytest.approx(slopes[k][at], rel=1e-3, abs=1e-5)


def test_main_texts_of_pages_not_learned_from(spark, network):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").orderBy(F.desc("page_id")).limit(200).collect()
    found = html.main_texts(network, [p.html for p in pages])
    right = 0
    for page, text in zip(pages, found, strict=True):
        blocks = html.blocks(page.html)
        right += text == "\n".join(b.text for b, main in zip(blocks, html.weak_labels(blocks) or [False] * len(blocks), strict=True) if main)
    assert right >= 196


def test_another_template(network):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site name</h1><a href=x>Home</a></header>
    <div class="cookie-notice"><p>We use cookies to improve. Accept them.</p></div><div class="content"><h1>A title of the piece</h1>
    <p>First paragraph of the main text, with words &amp; marks &#233;.</p><aside class="related"><ul><li><a>Other story</a></li></ul></aside>
    <p>Second  paragraph of the main
    text, <b>longer</b> than the first one.</p><form><p>Enter your email</p><input></form></div>
    <section class="comments"><div class="comment"><p>I like this very much.</p></div></section><footer>&copy; 2024 Site</footer>"""
    want = "A title of the piece\nFirst paragraph of the main text, with words & marks é.\nSecond paragraph of the main text, longer than the first one."
    assert html.main_texts(network, [page]) == [want]


def test_odd_pages(spark, network):
    odd = [None, "", " \n", "<p>", "<" * 50, "<a title='x", "<!-- open", "<script>var x = '<p>'", "<p>" * 3000 + "x", "&#xZZ; &unknown; <b", "<article><p>" + "word " * 50_000]
    frame = spark.createDataFrame([(k, f"u{k}", t) for k, t in enumerate(odd)], "page_id long, url string, html string")
    rows = html.extract(frame, network, keep=["page_id", "url"]).collect()
    assert len(rows) == len(odd) and all(r.text is not None for r in rows) and [rows[k].text for k in range(3)] == ["", "", ""]
    empty = html.fit(frame.limit(0))
    assert html.extract(frame.limit(0), empty).count() == 0
    assert [b.text for b in html.blocks("<p>one<br>two <i>three</i><script>x</script> four<p>five")] == ["one two three", "four", "five"]


def test_text_after_raw_elements_and_open_heads():
    """Scripts and styles are no markup; a head ends without its closing tag."""
    pages = {
        "<script>for(i=0;i<n;i++){f(i)}</script><p>Body</p><script>g()</script><p>End</p>": ["Body", "End"],
        "<script>var x = '<!-- <a b=\"';</SCRIPT ><p>Body</p>": ["Body"],
        "<style>a>b{content:'<x'}</style><p>Body</p>": ["Body"],
        "<textarea><p>not this</textarea><p>Body": ["Body"],
        "<title>a <b and </titles> c</title><p>Body": ["Body"],
        "<svg><script>if(a<b){}</script><text>no</text></svg><p>Body": ["Body"],
        "<svg><title>open</svg><p>Body<title>x</title>": ["Body"],
        "<head><title>x</title><body><article><p>Body</p></article>": ["Body"],
        "<html><head><title>x</title><meta charset=a><link href=b><style>p{}</style><article><p>Body</p></article>": ["Body"],
        "<head><title>x</title><script>if(a<b){}</script></head><body><p>Body</p>": ["Body"],
        "<p>Body</p><script>var x = '<p>'": ["Body"],
    }
    assert {page: [b.text for b in html.blocks(page)] for page in pages} == pages
    assert html.blocks("<head><title>x</title><body><article><p>Body")[0].path == ("article", "p")


def test_sample_counts_distinct_pages_with_main_text(spark, monkeypatch):
    """Many copies of each page, and many pages without a main element or with an empty one."""
    monkeypatch.setattr(html, "SAMPLE_PAGES", 20)
    good = [f"<body><nav>n</nav><article class=x><p>Text of page {k}.</p></article>" for k in range(24)]
    bad = [f"<body><p>Page {k}</p>" for k in range(200)] + [f"<main></main><p>Page {k}</p>" for k in range(200)]
    frame = spark.createDataFrame([(x,) for x in good * 100 + bad * 3 + [None, ""]], "html string").repartition(8)
    found = html.sample(frame)
    assert len(found) == len(set(found)) == 20 and set(found) <= set(good)
    assert sorted(html.sample(frame.where(F.col("html").isin(good[:7])))) == sorted(good[:7])
    assert html.sample(frame.where(F.col("html").isin(bad))) == []


def long_page(k):
    """400 menu links, then the article: over 60,000 characters, and its main text starts at block 400."""
    menu = "".join(f"<li><a href='/{k}/{n}'>Section {n} of list {n % 7} with some more words to make the link long enough</a></li>" for n in range(400))
    body = "".join(f"<p>Paragraph {n} of story {k} tells at some length, in whole sentences, what happened on day {n * k}.</p>" for n in range(30))
    return f"<html><body><nav><ul>{menu * 2}</ul></nav><article>{body}</article><footer>Imprint and contact</footer></body></html>"


def test_long_pages_are_learned_from_whole(spark):
    pages = spark.createDataFrame([(k, "u", long_page(k)) for k in range(12)], "page_id long, url string, html string")
    assert len(long_page(1)) > 60_000 and len(html.sample(pages)) == 12
    network = html.fit(pages)
    assert network.pages == 12
    found = html.main_texts(network, [long_page(99)])[0].split("\n")
    assert len(found) >= 28 and all(x.startswith("Paragraph") for x in found)


def test_a_page_over_the_driver_share_is_not_learned_from(spark, monkeypatch):
    monkeypatch.setattr(html, "SAMPLE_BYTES", 3 * len(long_page(1)))
    pages = spark.createDataFrame([(k, "u", long_page(k)) for k in range(6)], "page_id long, url string, html string")
    assert 2 <= len(html.sample(pages)) <= 3
    assert html.fit(pages.limit(0)).pages == 0


# ---- neighbours -----------------------------------------------------------------------------------


def plain_neighbours(rows, count):
    fine = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8}
    out = {}
    for query in fine:
        if query % 20 == 0:
            scores = sorted((-float((fine[i] * fine[query]).sum()), i) for i in fine if i != query)
            out[query] = [(i, -s) for s, i in scores[:count]]
    return out


def test_neighbours_with_ties_and_unusable_vectors(spark):
    noise = np.random.default_rng(3)
    rows = [(k, (noise.normal(size=8) * noise.choice([0.5, 1, 3])).astype(np.float32).tolist()) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(200)] + [(20, rows[20][1])]
    rows += [(600, None), (620, [0.0] * 8), (640, [float("nan")] + [1.0] * 7), (660, [1.0, None] + [1.0] * 6), (680, [float("inf")] * 8), (700, [1.0] * 5), (None, [1.0] * 8), (720, [-0.0] + [1.0] * 7), (721, [0.0] + [1.0] * 7)]
    frame = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, label long")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, count=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = plain_neighbours(dict((i, v) for i, v in rows).items(), 20)
    assert got.keys() == want.keys()
    for query, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [i for _, i, _ in found] == [i for i, _ in want[query]]
        assert [s for _, _, s in found] == pytest.approx([s for _, s in want[query]], abs=1e-9)


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (5, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 5, 4.0)]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(frame.limit(0), F.lit(True)).columns == ["query_id", "rank", "vec_id", "score"]


def test_rows_of_one_id_are_one(spark):
    """The least vector counts, for queries and candidates."""
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 1.0]), (7, [0.5, 0.5]), (7, [0.25, 2.0]), (7, [0.25, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 7, 0.25), (0, 2, 20, 0.0), (20, 1, 7, 2.0), (20, 2, 0, 0.0)]


@pytest.mark.parametrize(("lists", "unit", "least"), [(3, False, 1.0), (200, False, 0.95), (3000, False, 0.85), (3000, True, 0.99)])
def test_the_walk_finds_the_lists_that_all_distances_give(lists, unit, least):
    """Vectors of very different lengths are harder: queries lie aside of the points then."""
    dice = np.random.default_rng(lists)
    points = dice.normal(size=(max(lists, 50), 16))
    points = points / np.sqrt((points**2).sum(axis=1))[:, None] if unit else points
    index = neighbours.build(points, float(np.sqrt((points**2).sum(axis=1)).max()), lists)
    asked = index.query_points(dice.normal(size=(40, 16)))
    most = index.probes()
    ids, far = index.search(asked, most)
    want = ((asked[:, None, :] - index.centroids[None]) ** 2).sum(axis=2)
    met = sum(len(set(ids[k][:most].tolist()) & set(np.argsort(want[k])[:most].tolist())) for k in range(40))
    assert met >= least * 40 * min(most, lists)
    known = ids[:, 0]
    assert np.allclose(far[:, 0], want[np.arange(40), known])


def test_probes_grow_slower_than_lists():
    def read(lists):
        return neighbours.Index(np.zeros((lists, 1)), None, None, 1.0).probes()

    assert read(100) == read(512) == neighbours.PROBES and read(8192) == 4 * neighbours.PROBES


def test_recall_over_many_lists(spark, monkeypatch):
    """With far more lists than a query reads."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 8)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[k]
        scores[k] = -np.inf
        hits += len(got[ids[k]] & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits / (20 * len(got)) >= 0.9


def test_recall_where_64_lists_are_a_small_part(spark, tmp_path):
    """200,000 unit vectors without clusters, 2,084 lists as shipped, against brute force."""
    vectors = np.random.default_rng(1).normal(size=(200_000, 64))
    vectors /= np.sqrt((vectors**2).sum(axis=1))[:, None]
    column = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, 64, dtype=np.int32), vectors.ravel())
    pq.write_table(pa.table({"vec_id": np.arange(len(vectors)), "embedding": column}), str(tmp_path / "v.parquet"), row_group_size=12_500)
    frame = spark.read.parquet(str(tmp_path / "v.parquet")).repartition(16)
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 2000 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for k in range(0, len(vectors), 2000):
        scores = vectors @ vectors[k]
        scores[k] = -np.inf
        hits += len(got[k] & set(np.argsort(-scores)[:20].tolist()))
    print(f"recall {hits / (20 * len(got)):.4f}")
    assert hits / (20 * len(got)) >= 0.96
