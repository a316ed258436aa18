"""Decontamination, near duplicates and repeated strings against brute force."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.llm import bwt_dedup, decontaminate, ngram_join

from .conftest import ODD

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def random_texts(rng, n, words):
    out = []
    for _ in range(n):
        out.append([rng.choice(words) for _ in range(rng.randint(0, 80))])
    for k in range(0, n, 3):  # near copies
        near = list(rng.choice(out))
        for _ in range(rng.randint(0, 3)):
            if near:
                near[rng.randrange(len(near))] = rng.choice(words)
        out[k] = near
    return [" ".join(t) for t in out]


def windows_hit(text, items):
    w = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, itext in items:
        iw = ITEM_WORD.findall((itext or "").translate(LOWER))
        n = min(13, len(iw))
        wins = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k:k + n]) in wins:
                hit |= set(range(k, k + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_decontamination_equals_brute_force(spark, texts):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ärger", "ÄRGER", "the"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 13, 14, 40, 60])]
    items += [(50, items[6][1]), (51, None), (52, ""), (53, "THE  the"), (54, "é" * 3)]
    rows = [(i, t) for i, t in enumerate(random_texts(rng, 40, vocabulary))]
    rows += [(100, "x " * 30 + items[6][1] + " y" * 30), (101, items[7][1].upper()), (102, "a " + items[4][1] + " " + items[4][1]),
             *[(200 + (i or 0), t) for i, t in ODD], (100, "same id, other text"), (None, items[6][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc string")
    got = decontaminate.decontaminate(texts(*rows), bench).collect()
    want = Counter()
    for i, t in rows:
        n, hit, found, bad = windows_hit(t, items)
        want[i, n, hit, len(found), tuple(found), bad] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in got) == want
    assert decontaminate.decontaminate(texts(*rows).limit(0), bench).count() == 0
    clean = decontaminate.decontaminate(texts(*rows), bench.limit(0))
    assert clean.count() == len(rows) and clean.where("contaminated or n_hit > 0").count() == 0


def test_items_that_share_an_id_or_have_none_are_found(spark, texts):
    first, second, third = (" ".join(f"{c}{k}" for k in range(13)) for c in "pqr")
    bench = spark.createDataFrame([("a", first), ("a", second), ("a", second), (None, third)], "item_id string, text string")
    docs = texts((1, f"x {second} y"), (2, f"{third} z"), (3, "x y z"), (4, second + " " + third))
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (13, ["a"], True), 2: (13, [], True), 3: (0, [], False), 4: (26, ["a"], True)}


def test_words_repeated_over_and_over(spark, texts):
    """Grids and other periodic texts against brute force, and one of 20,000 equal words."""
    rng = random.Random(3)
    patterns = [["a"], ["a", "b"], ["a", "b", "c"], ["0", "1", "0"], ["a", "a", "b"]]
    items = [(k, " ".join((patterns[k % 5] * 80)[:n])) for k, n in enumerate([60, 40, 13, 12, 31, 7, 5, 80])]
    rows = [(k, " ".join(rng.choice([["x"], []]) + (rng.choice(patterns) * 60)[rng.randint(0, 3):rng.randint(20, 120)]
                         + (rng.choice(patterns) * 40)[:rng.randint(0, 60)])) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"])
           for r in decontaminate.decontaminate(texts(*rows), bench).collect()}
    assert got == {i: windows_hit(t, items) for i, t in rows}
    long = spark.createDataFrame([("one", "word " * 2000), ("two", "word " * 1500 + "end")], "item_id string, text string")
    got = decontaminate.decontaminate(texts((1, "word " * 20_000), (2, "other " + "word " * 12)), long).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["items"]) for r in got) == [(1, 20_000, ["one", "two"]), (2, 0, [])]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()


def linked(a, b):
    n = len(a & b)
    return bool(n) and 100 * n >= 90 * (len(a) + len(b) - n)


def test_near_duplicates_equal_brute_force(spark, texts, monkeypatch):
    rng = random.Random(6)
    base = [f"v{i}" for i in range(400)]
    rows = []
    for size in (3, 4, 9, 12, 15, 22, 30, 60, 120, 300):
        origin = [rng.choice(base) for _ in range(size)]
        for _ in range(9):
            near = list(origin)
            for _ in range(rng.randint(0, max(1, size // 40 + 1))):
                near[rng.randrange(size)] = rng.choice(base)
            rows.append((len(rows) * 7 % 1000, " ".join(near)))
    rows += [(2000 + (i or 0), t) for i, t in ODD]
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    want = Counter((doc, len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows))
    got = ngram_join.near_duplicates(texts(*rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    # All candidate pairs at once, and by rounds as long as these help.
    for pairs in (1e9, 0):
        monkeypatch.setattr(ngram_join, "PAIRS_A_ROW", pairs)
        got = ngram_join.near_duplicates(texts(*rows)).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert ngram_join.near_duplicates(texts(*rows).limit(0)).count() == 0


@pytest.mark.parametrize("rule", [ngram_join.CONTRACT, ngram_join.STAGE, ngram_join.Rule(5, 70, 100), ngram_join.Rule(2, 95, 100)])
def test_linked_sets_meet_in_their_prefixes(rule):
    """The prefix filter loses no pair, at all sizes and just above the limit, whatever the order."""
    rng = np.random.default_rng(5)
    tried = 0
    for n in [*range(1, 60), 90, 150, 400, 1500]:
        for _ in range(12):
            classes = rng.integers(0, 4, 1 << ngram_join.BUCKET_BITS).astype(np.uint64)
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            b = np.setdiff1d(a, rng.choice(a, rng.integers(0, int(n * (1 - rule.num / rule.den)) + 1), replace=False))
            b = np.union1d(b, rng.integers(0, 1 << 63, rng.integers(0, int(n * 0.15) + 1)).astype(np.uint64))
            both = len(np.intersect1d(a, b))
            if len(b) and rule.den * both >= rule.num * (len(a) + len(b) - both) and not np.array_equal(a, b):
                tried += 1
                x, y = (ngram_join.ordered(s, classes) for s in sorted((a, b), key=len))
                _, xp, yp = np.intersect1d(x[:rule.probed(len(x))], y[:rule.probed(len(y))], return_indices=True)
                assert len(xp) >= max(1, rule.shared(len(x), len(y))), n
                most = np.minimum(xp, yp) + 1 + np.minimum(len(x) - xp - 1, len(y) - yp - 1)
                differ = sum(int(v).bit_count() for v in (ngram_join.parities(a) ^ ngram_join.parities(b)).view(np.uint64))
                assert differ <= len(x) + len(y) - 2 * both
                assert (most * (rule.den + rule.num) >= (len(x) + len(y)) * rule.num).all()
    assert tried > 100


def test_stage_drops_copies_of_80_to_90_percent(spark, texts):
    rng = random.Random(12)
    fresh = lambda n: [f"z{rng.randrange(10**6)}" for _ in range(n)]
    origin = fresh(200)
    rows = [(1, origin), (2, origin + fresh(26)), (3, origin + fresh(48)), (4, origin[:100] + fresh(12) + origin[112:]),
            (5, origin[:50] + fresh(17) + origin[67:]), (6, origin + fresh(60)), (7, origin[:50] + fresh(40) + origin[90:]), (8, fresh(200))]
    out = ngram_join.keep_one(spark, texts(*[(i, " ".join(w)) for i, w in rows]), None)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 6, 7, 8]


@pytest.fixture
def compared(monkeypatch):
    """Number of pairs each round compares."""
    counts, own = [], ngram_join._linked

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return own(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    return counts


def test_near_copies_are_connected_by_few_pairs(spark, texts, compared):
    rng = random.Random(8)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(3000):
        near = list(base)
        near[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(near)))
    got = ngram_join.near_duplicates(texts(*rows)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 3000
    assert sum(compared) < 10 * 3000


@pytest.mark.parametrize("small", [1, 4, 32])
@pytest.mark.parametrize("changes", [4, 12])
def test_families_around_the_limit_equal_brute_force(spark, texts, monkeypatch, small, changes):
    """Members of a family linked to some of it, groups of few and of many nodes, sizes that differ."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rng = random.Random(changes)
    rows = []
    for family in range(4):
        base = [f"f{family}b{k}" for k in range(40 + 60 * family)]
        for _ in range(40):
            near = base[:len(base) - rng.choice([0, 0, 1, 3, 8])]
            for _ in range(rng.randint(0, changes)):
                near[rng.randrange(len(near))] = rng.choice([f"e{rng.randrange(10**6)}", f"c{rng.randrange(4)}"])
            rows.append((len(rows), " ".join(near)))
    sets, low = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]) and low[i] != low[j]:
                old, new = max(low[i], low[j]), min(low[i], low[j])
                low = [new if k == old else k for k in low]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(texts(*rows)).collect()}
    assert got == dict(enumerate(low))


def test_copies_too_far_from_each_other_hardly_meet(spark, texts, monkeypatch):
    """One text with other changes in each copy: no copy is linked, nearly none is paired."""
    counts, own = [], ngram_join._candidates

    def counted(met, *rest):
        counts.append(met.count())
        return own(met, *rest)

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    rng = random.Random(3)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for i in range(1500):
        near = list(base)
        for k in rng.sample(range(200), 7):
            near[k] = f"e{i}x{k}"
        rows.append((i, " ".join(near)))
    got = ngram_join.near_duplicates(texts(*rows)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 1500
    assert sum(counts) < 10 * 1500


@pytest.mark.parametrize("rule", [ngram_join.CONTRACT, ngram_join.STAGE])
def test_unrelated_texts_with_one_notice_do_not_meet(spark, texts, compared, rule):
    rng = random.Random(9)
    notice = " ".join(f"n{k}" for k in range(19))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + notice) for i in range(3000)]
    got = ngram_join.near_duplicates(texts(*rows), rule).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 3000
    assert sum(compared) < 3000


def removed(rows):
    """(doc, bytes, removed, runs, kept) of each row, by the rule's words."""
    starts = defaultdict(lambda: 1 << 60)
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for k in range(len(raw) - 49):
                starts[raw[k:k + 50]] = min(starts[raw[k:k + 50]], doc)
    out = Counter()
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        if doc is not None:
            for k in range(len(raw) - 49):
                if starts[raw[k:k + 50]] < doc:
                    gone[k:k + 50] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc, len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()] += 1
    return out


def test_repeated_strings_equal_brute_force(spark, texts, monkeypatch):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = []
    for i in range(60):
        own = "".join(rng.choice("abcdefgh éß\n") for _ in range(rng.randint(0, 150)))
        a = rng.randint(0, 300)
        rows.append(((i * 37) % 101, own + passage[a:a + rng.choice([40, 49, 50, 51, 90, 200])] + own[::-1]))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, "Und " * 100), (503, "Und " * 60 + "x" + "Und " * 30),
             (504, "y" * 50), (505, "y" * 51), (506, "short"), (507, "short"), (rows[0][0], passage),
             *[(600 + i if i else None, t) for i, t in ODD if i != 7], (700, "long " * 3000), (701, "long " * 2999)]
    want = removed(rows)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans")
    for settings in ({}, {"GROUP": 0}, {"PIECE": 64, "SHARD": 300, "MERGED": 1000, "SPAN": 32, "GROUP": 400, "RUN": 7}):
        for name, value in settings.items():
            monkeypatch.setattr(bwt_dedup, name, value)
        got = bwt_dedup.remove_repeats(texts(*rows)).collect()
        assert Counter((*(r[n] for n in names), bytes(r["kept"])) for r in got) == want
    assert bwt_dedup.remove_repeats(texts(*rows).limit(0)).count() == 0


def test_one_passage_in_many_texts_is_never_one_group(spark, texts, monkeypatch):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, "".join(rng.choice("ab") for _ in range(60)) + passage + "".join(rng.choice("ab ") for _ in range(60)))
            for i in rng.sample(range(10_000), 3000)]
    sizes = []
    merged = bwt_dedup._merged

    def watched(strings):
        sizes.append(strings.groupBy("owner", "span").agg(F.sum(F.octet_length("data")).alias("n")).agg(F.max("n")).first()[0])
        return merged(strings)

    monkeypatch.setattr(bwt_dedup, "_merged", watched)
    got = bwt_dedup.remove_repeats(texts(*rows)).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans")
    assert Counter((*(r[n] for n in names), bytes(r["kept"])) for r in got) == removed(rows)
    assert sizes[0] is None or sizes[0] <= bwt_dedup.GROUP


def test_repeats_of_all_texts_are_worked_on_in_turns(spark, texts, monkeypatch):
    rng = random.Random(6)
    whole = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(whole)] + [(100 + i, t[:500] + "#" + t[500:]) for i, t in enumerate(whole)]
    sizes, tables, merged, written = [], [], bwt_dedup._merged, bwt_dedup.written

    def watched(strings):
        sizes.append(strings.agg(F.sum(F.octet_length("data"))).first()[0])
        return merged(strings)

    def kept(df, purpose, *by):
        tables.append((purpose, written(df, purpose, *by)))
        return tables[-1][1]

    monkeypatch.setattr(bwt_dedup, "_merged", watched)
    monkeypatch.setattr(bwt_dedup, "written", kept)
    got = bwt_dedup.remove_repeats(texts(*rows)).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans")
    assert Counter((*(r[n] for n in names), bytes(r["kept"])) for r in got) == removed(rows)
    assert sum(sizes) > sum(len(t) for t in whole) and max(sizes) < 0.5 * sum(sizes)
    # Left are what the result is read from, not what repeats.
    left = {purpose for purpose, df in tables for f in df.inputFiles()[:1] if Path(unquote(urlparse(f).path)).exists()}
    assert "stretches" in dict(tables) and left <= {"copies", "spans"}


@pytest.mark.parametrize("at_once", [1, 40, 10**6])
def test_packed_anchors_find_their_owners(monkeypatch, at_once):
    monkeypatch.setattr(bwt_dedup, "PACKED", at_once)
    rng = random.Random(at_once)
    rows = {}
    for _ in range(400):
        anchor, key = rng.choice([rng.randrange(40), rng.randrange(2**51)]), rng.choice([-2**63, 2**63 - 1, *range(-5, 5)])
        rows[anchor * 2**11 % 2**51 + rng.choice([0, 3, 2**11 - 1]), key] = rng.choice([0, 7, 2**32 - 1])
    found = [tuple(np.array(c, np.int64) for c in zip(*[(a, k, s) for (a, k), s in some])) for some in (
        list(rows.items())[:150], list(rows.items())[150:])]
    packed = {}
    for batch in [bwt_dedup._packed(found[:1]), bwt_dedup._packed(found[1:])]:
        for b, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
            packed.setdefault(b, []).append(data)
    # Of an entry 17 bytes are sent.
    assert sum(len(x) for some in packed.values() for x in some) == 17 * len(rows)
    holders = defaultdict(list)
    for (a, k), s in rows.items():
        holders[a].append((k, s))
    want = Counter((k, a, *min(some)) for a, some in holders.items() if len(some) > 1 for k, _ in some)
    got = Counter(tuple(r.values()) for b, some in packed.items() for batch in bwt_dedup._owners(b, some) for r in batch.to_pylist())
    assert got == want


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\x00\xff", bytes(range(256))])
@pytest.mark.parametrize("shard", [1, 150, 10**9])
def test_merged_transforms_find_all_repeats(monkeypatch, alphabet, shard):
    monkeypatch.setattr(bwt_dedup, "SHARD", shard)
    rng = random.Random(len(alphabet) + shard % 97)
    for _ in range(6):
        origin = bytes(rng.choice(alphabet) for _ in range(rng.randint(60, 300)))
        strings = []
        for _ in range(rng.randint(1, 10)):
            s = bytearray(origin[rng.randint(0, 30):] + bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 40))))
            for _ in range(rng.randint(0, 3)):
                s[rng.randrange(len(s))] = rng.choice(alphabet)
            strings.append(bytes(s[:rng.randint(1, len(s))]))
        docs = np.array([rng.randint(0, 5) for _ in strings])
        low = {}
        for s, d in zip(strings, docs):
            for k in range(len(s) - 49):
                low[s[k:k + 50]] = min(low.get(s[k:k + 50], 9), d)
        want = [[k for k in range(len(s) - 49) if low[s[k:k + 50]] < d] for s, d in zip(strings, docs)]
        got = bwt_dedup.earlier_windows(strings, docs)
        assert [[k for a, b in runs for k in range(a, b)] for runs in got] == want
