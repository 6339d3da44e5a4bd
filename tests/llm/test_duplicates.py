"""SimHash near-dedup, decontamination and removal of repeated strings against plain versions."""

import collections
import hashlib
import random
import re

import helpers
import numpy as np
import pytest
import xxhash

from termloom.llm import decontaminate, shared, simhash, suffixes


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [*helpers.ODD_TEXTS, "UPPER Case É words here", "a\x0bb\x0cc d e"]:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def near_fingerprints(seed, count):
    """Random fingerprints, chains of near ones, and one dense family."""
    dice = random.Random(seed)
    fps = [dice.getrandbits(64) for _ in range(count)]
    for base in fps[: count // 3]:
        for _ in range(dice.choice((1, 2, 6))):
            base ^= sum(1 << b for b in dice.sample(range(64), dice.randint(1, 5)))
            fps.append(base)
    core = dice.getrandbits(64)
    fps += [core ^ sum(1 << b for b in dice.sample(range(64), dice.randint(0, 6))) for _ in range(count // 2)]
    return sorted(set(fps))


def classes_of(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in nodes}


def test_trie_pairs_are_all_pairs_within_the_radius():
    values = np.array(near_fingerprints(1, 300), np.uint64)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 4}
    i, j = simhash.trie_pairs(values, ([0], [len(values)], [0], [len(values)]), 4)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)


@pytest.mark.parametrize("group_rows", [8192, 7])
def test_links_connect_what_the_radius_connects(spark, group_rows):
    """Also when every group is cut into chunks, whose pairs are joined."""
    fps = near_fingerprints(2, 200)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    links = simhash.hamming_links(spark.createDataFrame([(x,) for x in signed], "fp long"), group_rows=group_rows).collect()
    near = [(a, b) for k, a in enumerate(signed) for b in signed[k + 1 :] if ((a ^ b) % 2**64).bit_count() <= 4]
    assert all(((r.u ^ r.v) % 2**64).bit_count() for r in links)
    assert classes_of(signed, [(r.u, r.v) for r in links]) == classes_of(signed, near)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1100)] + [(7, 2000), (3000, 2999)]
    found = {r.u: r.root for r in shared.components(spark.createDataFrame(edges, "u long, v long").distinct(), "t").collect()}
    want = classes_of({x for e in edges for x in e}, edges)
    assert found == {x: root for x, root in want.items() if x != root}
    assert shared.components(spark.createDataFrame([], "u long, v long"), "t").count() == 0


def test_classes_over_odd_documents(spark):
    docs = helpers.odd_documents(spark)
    rows = simhash.near_classes(docs).collect()
    assert len(rows) == docs.count()
    by = {r.id: r for r in rows}
    assert by[0].fp == by[1].fp == by[2].fp == 0 and by[2].component_id == 0  # null, empty, blank
    assert by[6].component_id == 5 and by[None].component_id is None
    kept = simhash.drop_near_copies(docs)
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns and max(ids.values()) == 1 and ids[None] == 1
    assert ids[0] == 1 and not ids[1] and not ids[6] and ids[11] == 1
    assert simhash.drop_near_copies(helpers.no_documents(spark)).count() == 0


def test_null_ids_keep_one_row_of_each_class(spark):
    texts = [helpers.prose(k, 50) for k in (1, 1, 2)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(4, texts[2])], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.text) for r in simhash.drop_near_copies(docs).collect()) == sorted([(True, texts[0]), (False, texts[2])])


def test_repeated_ids_with_other_texts_lose_no_class(spark):
    """(5, A), (5, B), (3, B): class A keeps (5, A), class B (3, B); of repeated rows one stays."""
    a, b = helpers.prose(1, 60), helpers.prose(2, 60)
    for rows in ([(5, a), (5, b), (3, b)], [(5, b), (3, b), (5, a), (5, a)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(tuple(r) for r in simhash.drop_near_copies(docs).collect()) == [(3, b), (5, a)]


# ---- decontamination ------------------------------------------------------------------------------


def plain_matches(docs, items):
    def words(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def weights(own, width):
        return collections.Counter(tuple(own[k : k + width]) for k in range(len(own) - width + 1))

    out = {}
    for doc, text in docs:
        own = words(text)
        for item, sample in items:
            item_words = words(sample)
            width, n = min(5, len(item_words)), len(item_words)
            if not width:
                continue
            target, best = weights(item_words, width), 0.0
            for start in range(max(1, len(own) - n + 1)):
                window = weights(own[start : start + n], width)
                common = sum((window & target).values())
                best = max(best, common / (sum(window.values()) + sum(target.values()) - common))
            if best >= 0.8:
                out[doc, item] = best
    return out


def changed(text, dice, edits):
    words = text.split()
    for _ in range(edits):
        k = dice.randrange(len(words))
        words[k : k + 1] = dice.choice(([], ["zzz"], [words[k], "qq"]))
    return " ".join(words)


def test_matches_equal_all_windows(spark):
    dice = random.Random(5)
    items = [(k, helpers.prose(100 + k, dice.choice((3, 5, 8, 30, 60)))) for k in range(25)]
    items += [(90, None), (91, " .,"), (92, items[0][1]), (93, "word " * 40)]
    docs = []
    for k in range(60):
        passage = changed(items[k % 25][1], dice, k // 25)
        text = f"{helpers.prose(500 + k, dice.choice((0, 5, 80)))} {passage.upper() if k % 3 else passage}. {helpers.prose(900 + k, 20)}"
        docs.append((k, text))
    docs += [(70, items[3][1]), (71, None), (72, ""), (73, "word " * 300), (74, helpers.prose(1, 500)), (75, items[20][1].replace(" ", "### ")), (76, " ".join(items[4][1].split()[:-1]))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_matches(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(*frames).collect()}
    missed = want.keys() - got.keys()
    assert not got.keys() - want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert not missed  # the radius is wide enough for these
    kept = {r.doc_id for r in decontaminate.drop_contaminated(*frames).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_decontamination_of_odd_documents(spark):
    docs = helpers.odd_documents(spark)
    items = spark.createDataFrame([(1, helpers.ODD_TEXTS[7]), (None, None)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.contaminated(helpers.no_documents(spark), items).count() == 0


def test_hamming_blocks_meet_within_the_radius():
    """Two fingerprints within the radius differ in few bits of some block."""
    assert decontaminate.RADIUS // decontaminate.BLOCKS == 2


# ---- repeated strings -----------------------------------------------------------------------------


def plain_removal(docs, length):
    first, out = {}, []
    for doc, text in sorted((d, t or "") for d, t in docs if d is not None):
        raw = text.encode()
        for k in range(len(raw) - length + 1):
            first.setdefault(raw[k : k + length], doc)
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1 if doc is not None else 0):
            if first[raw[k : k + length]] < doc:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def passages(seed, count):
    dice = random.Random(seed)
    shared_ones = [helpers.prose(1000 + k, dice.choice((8, 12, 30))) for k in range(6)] + ["a" * 120, "ab" * 60, "é" * 40]
    docs = []
    for k in range(count):
        parts = [helpers.prose(seed * 7919 + k * 31 + j, dice.randint(0, 25)) for j in range(3)]
        for _ in range(dice.choice((0, 1, 3))):
            own = dice.choice(shared_ones)
            parts.insert(dice.randint(0, len(parts)), own[dice.choice((0, 0, 3)) : len(own) - dice.choice((0, 0, 5))])
        docs.append((k * 3 % count if seed % 2 else k, dice.choice((" ", "\n", "")).join(parts)))
    docs += [(count + 5, docs[0][1]), (count + 6, docs[1][1] + "!"), (count + 7, ""), (count + 8, None), (count + 9, "x" * 49), (count + 10, "x" * 50), (count + 11, "x" * 51)]
    return docs


@pytest.mark.parametrize(("seed", "group_rows"), [(1, 4096), (2, 4096), (4, 1)])
def test_removal_equals_all_windows(spark, monkeypatch, seed, group_rows):
    """Also when every shared anchor counts as too large a group for one task."""
    monkeypatch.setattr(suffixes, "GROUP_ROWS", group_rows)
    docs = passages(seed, 120)
    out = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = collections.Counter((r.doc, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect())
    assert got == plain_removal(docs, 50)
    assert sum(n for _, _, n, _, _ in got) > 1000


def test_removal_with_repeated_and_null_ids(spark):
    docs = [*passages(6, 30), (3, helpers.prose(77, 40)), (3, helpers.prose(77, 40)), (None, passages(6, 30)[0][1]), (90, helpers.prose(77, 40))]
    out = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = collections.Counter((r.doc, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect())
    assert got == plain_removal(docs, 50)


def test_removal_of_odd_and_no_documents(spark):
    docs = helpers.odd_documents(spark)
    rows = suffixes.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    assert [bytes(r.kept) for r in rows if r.doc == 6] == [b""]
    assert suffixes.remove_repeats(helpers.no_documents(spark)).count() == 0
