"""Super-k-mers, resampling and conversation repair against brute force, and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from roadledger.llm import repair, resampling, super_kmers
from roadledger.llm.repair import ASSISTANT, SYSTEM, USER, Fold, Item, search, solutions

from .conftest import ODD

SPACES = re.compile("[\x20\x09-\x0d]+")


def kept_by_hand(rows, length):
    """(doc_id, n_words, n_removed, kept) per row, window by window."""
    split = [(d, [w for w in SPACES.split(t or "") if w]) for d, t in rows]
    first = {}
    for d, words in split:
        for a in range(len(words) - length + 1):
            if d is not None:
                key = tuple(words[a:a + length])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, words in split:
        gone = {q for a in range(len(words) - length + 1)
                if d is not None and first[tuple(words[a:a + length])] < d for q in range(a, a + length)}
        out.append((d, len(words), len(gone), " ".join(w for q, w in enumerate(words) if q not in gone)))
    return sorted(out, key=repr)


def removed(docs, **how):
    return sorted((tuple(r) for r in super_kmers.remove_repeats(docs, **how).collect()), key=repr)


def shared_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["naïve", "日本", "x" * 90, "\x00"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(8, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.6 else " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))
                 for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    return texts


@pytest.mark.parametrize("bucket", [2048, 1])
def test_repeated_windows_go(spark, texts, monkeypatch, bucket):
    monkeypatch.setattr(super_kmers, "BUCKET", bucket)
    rows = [(k // 2, t) for k, t in enumerate(shared_texts(bucket, 40))]
    assert removed(texts(*rows), length=12, gram=4) == kept_by_hand(rows, 12)


def test_repeated_windows_of_odd_rows(spark, texts):
    rows = [*ODD, (9, "long " * 300), (None, "long " * 300), (3, "long " * 49), (11, "same words here and there " * 20)]
    assert removed(texts(*rows)) == kept_by_hand([r[:2] for r in rows], 50)
    assert removed(texts(*rows).limit(0)) == []


def test_one_phrase_in_many_contexts_goes_by_window(spark, texts, monkeypatch):
    monkeypatch.setattr(super_kmers, "BUCKET", 50)
    rng = random.Random(5)
    phrase = " ".join(f"p{k}" for k in range(14))
    rows = [(k, " ".join([*[f"a{rng.random()}" for _ in range(20)], phrase, *[f"b{rng.random()}" for _ in range(20)]]))
            for k in range(150)]
    assert removed(texts(*rows), length=12, gram=4) == kept_by_hand(rows, 12)


def test_parts_of_a_text_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(super_kmers, "PIECE", 40)
    words = [f"w{k}" * (1 + k % 5) for k in range(200)]
    windows = [(first + a, tuple(part[a:a + 7])) for first, part in super_kmers._pieces("  \n".join(words), 7)
               for a in range(len(part) - 6)]
    assert windows == [(a, tuple(w.encode() for w in words[a:a + 7])) for a in range(194)]


CUT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features_by_hand(text, max_n):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in CUT.split(lowered) if w]
    return words, [" ".join(words[a:a + k]) for k in range(1, max_n + 1) for a in range(len(words) - k + 1)]


def resampled_by_hand(rows, target, max_n, buckets, percent, least):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in rows for f in features_by_hand(t, max_n)[1])
    t = Counter(bucket(f) for x in target for f in features_by_hand(x, max_n)[1])
    ns, nt = sum(s.values()), sum(t.values())
    out, able = [], []
    for d, text in rows:
        words, found = features_by_hand(text, max_n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(words), len(found), weight, score, None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("max_n", [1, 3])
def test_resampling_equals_brute_force(spark, texts, monkeypatch, max_n):
    monkeypatch.setattr(resampling, "PIECE", 50)
    rows = [*[(k, t) for k, t in enumerate(shared_texts(3, 60))], (None, "no id but more than five words here"), (70, None), (71, ""),
            (72, "ÉCLAIR Été A-b--c\x7fd " * 9), (73, "ÉCLAIR Été A-b--c\x7fd " * 9), (74, "z" * 300)]
    target = ["w1 w2 w3 naïve", None, "", "W7 w8, w9"]
    frame = spark.createDataFrame([(k, t, 5) for k, t in enumerate(target)], "item_id long, text string, weight int")
    got = resampling.resample(texts(*rows).withColumnRenamed("node", "score"), frame, max_n=max_n, buckets=50, percent=30, min_words=5)
    names = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == resampled_by_hand(rows, target, max_n, 50, 30, 5)


@pytest.mark.parametrize("piece", [1, 10, 50])
def test_texts_split_in_pieces_give_the_same_features(monkeypatch, piece):
    text = " ".join(shared_texts(8, 6)) + " ÉÀ..end"
    whole = resampling.Splitter(4, 50).hashed(text)
    monkeypatch.setattr(resampling, "PIECE", piece)
    n, found = resampling.Splitter(4, 50).hashed(text)
    assert n == whole[0] and sorted(found) == sorted(whole[1])


def test_resampling_odd_tables(spark, texts):
    docs = texts(*ODD)
    assert resampling.resample(docs.limit(0), docs).count() == 0
    drawn = resampling.resample(docs, docs.limit(0), percent=100, min_words=0, carry=("text",)).collect()
    assert sorted(r["rank"] for r in drawn) == list(range(1, len(ODD) + 1))
    assert Counter(r["text"] for r in drawn) == Counter(t for _, t in ODD)
    with pytest.raises(ValueError):
        resampling.resample(docs, docs, carry=("score",))


def audits_by_hand(items):
    """The best (cost, audit) of all edits with at most two inserts in a row."""
    best = [None]

    def go(i, roles, cost, audit, inserts):
        if best[0] and cost > best[0][0]:
            return
        if i == len(items) and re.fullmatch("(s?(ua)+)?", roles):
            best[0] = min(best[0] or (cost, audit), (cost, audit))
        if i < len(items):
            x = items[i]
            more, rest = cost + 3 * x.extra, "D" * x.extra
            go(i + 1, roles, more + 3, audit + "D" + rest, 0)
            if not x.forced:
                own = {SYSTEM: "s", USER: "u", ASSISTANT: "a", None: "x"}[x.role]
                go(i + 1, roles + own, more + x.truncated, audit + "K" + rest, 0)
                for r in "ua":
                    go(i + 1, roles + r, more + 2 + x.truncated, audit + "R" + rest, 0)
        if inserts < 2:
            for r in "ua":
                go(i, roles + r, cost + 2, audit + "I", inserts + 1)

    go(0, "", 0, "", 0)
    return best[0]


def random_items(rng, n):
    return [Item(rng.choice([SYSTEM, USER, USER, ASSISTANT, ASSISTANT, None]), rng.random() < 0.2, rng.random() < 0.2,
                 rng.choice([0, 0, 0, 1])) for _ in range(n)]


def test_search_finds_the_least_audit_whole_or_in_blocks():
    rng = random.Random(2)
    for _ in range(80):
        items = random_items(rng, rng.randint(0, 4))
        want = audits_by_hand(items)
        assert search(items, 0, None) == want
        for cut in range(len(items) + 1):
            fold = Fold()
            for part in filter(None, (items[:cut], items[cut:])):
                fold.add(solutions(part, range(4)))
            cost, pieces, tail = fold.close()
            assert (cost, "".join(p for _, p in pieces) + tail) == want


def test_bounds_never_exceed_the_cost():
    rng = random.Random(4)
    for _ in range(60):
        items = random_items(rng, rng.randint(0, 40))
        assert repair.suffix_bounds(items)[0] <= search(items, 0, None)[0]


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, block int, cost string")


def repaired_by_hand(rows):
    """Report rows of undamaged conversations, by one search over each whole."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in mine:
            bare = re.sub("[\x20\x09-\x0d]+$", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        items = [Item({"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(r[:1]), f == "truncated", f in ("blank", "duplicate"))
                 for (_, r, _), f in zip(mine, faults)]
        cost, audit = search(items, 0, None)
        lines, place = [], 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else mine[place][1:]
            place += edit != "I"
            if edit != "D":
                lead = bool(lines) and lines[0][0] == "s"
                even = (len(lines) - lead) % 2 == 0
                lines.append((role if edit == "K" else "user" if even else "assistant") + ":" + text)
        turns = [t for t, *_ in mine if t is not None]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [128, 3])
def test_conversations_are_repaired_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    texts = ["Yes.", "No", "  ", "", None, "Why?\n", "Well!", "So it goes"] + [f"Turn {k}." for k in range(9)]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", None, "tool", "user", "assistant"]),
             rng.choice(texts)) for c in [None, *range(1, 9)] for _ in range(rng.randint(1, 14))]
    rows += [(50, k, rng.choice(["user", "assistant"]), f"Long talk {k}.") for k in range(300)]
    rows += [(51, 1, "user", "Again.")] * 40
    frame = talk(spark, rows)
    got = sorted((tuple(r) for r in repair.repair_report(frame, frame).collect()), key=repr)
    assert got == repaired_by_hand(rows)


@pytest.mark.parametrize("conf", [
    {"spark.sql.shuffle.partitions": "40"},  # several files to a task
    {"spark.sql.shuffle.partitions": "2", "parquet.block.size": "512", "spark.sql.files.maxPartitionBytes": "700",
     "spark.sql.files.openCostInBytes": "1"}])  # a file to several tasks
def test_conversations_are_repaired_whatever_files_a_task_reads(spark, conf):
    rng = random.Random(6)
    rows = [(c, k, rng.choice(["user", "assistant", "assistant", "system"]), f"Turn {k}{rng.choice('..!?,')}")
            for c in range(60) for k in range(rng.randint(1, 30))]
    rows += [(70, k, rng.choice(["user", "assistant"]), f"Long talk {k}.") for k in range(400)]
    frame = talk(spark, rows)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = sorted((tuple(r) for r in repair.repair_report(frame, frame).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert got == repaired_by_hand(rows)


def test_repaired_rows_alternate(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate(
        [("user", "Hi."), ("user", "There?"), ("assistant", "Yes."), ("assistant", "Yes."), ("tool", "x")])]
    done = repair.Repair(talk(spark, rows))
    report = done.report.collect()[0]
    left = [tuple(r)[1:] for r in done.rows.orderBy("place").collect()]
    assert re.fullmatch("(ua)+", "".join(role[0] for _, role, _, _ in left)) and [r[0] for r in left] == list(range(1, len(left) + 1))
    assert "".join(e for *_, e in left) == report["audit"].replace("D", "")


def test_damaged_away_and_empty(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    frame = talk(spark, [(gone, 1, "user", "Hi."), (None, None, None, None)])
    rows = {r["conv_id"]: r for r in repair.repair_report(frame, repair.damage(frame)).collect()}
    assert set(rows) == {gone, None} and tuple(rows[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert repair.repair_report(frame.limit(0), repair.damage(frame.limit(0))).count() == 0
