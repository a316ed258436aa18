import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from roadledger.llm import packing, token_files
from roadledger.llm.tokens import Encoder

from .conftest import ODD

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def plain(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("name, spaces", FILES)
def test_pieces_give_the_ids_of_whole_texts(name, spaces):
    rng = random.Random(5)
    path = public_tokenizers.path(name)
    odd = ["", " ", "\n", " a", "a ", "a  b", "a \nb", "a\n\nb", "don't I'll x's 'q'", "a\tb c d", "x.\ny z!\n w",
           "Σας ΟΔΟΣ", "é ́x é", "你好 世界", "<|endoftext|> hi", "a\x1cb \x85c", "١٢ ½", "🙂🙂 ok"]
    odd += ["".join(rng.choice("ab 'sT.\n\t!1é́  Ⅷ🙂\x1f") for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    want, encoder = plain(path), Encoder(path, spaces)
    for text, got in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(got, "<u4").tolist() == want(text), repr(text)


@pytest.mark.parametrize("name, spaces", FILES)
def test_runs_of_letters_digits_and_marks(name, spaces):
    """Latin letters, digits and every mark of ASCII, alone and with what is neither."""
    rng = random.Random(6)
    path = public_tokenizers.path(name)
    kinds = ["abcXYZ", "éñçÀßıſǅÞ×÷", "0123", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "'", " ", "\n", "İ²½\u0301日🙂"]
    texts = ["".join(rng.choice(rng.choice(kinds[:k])) for _ in range(rng.randint(0, 50))) for k in (1, 3, 4, 6, 7, 8)
             for _ in range(300)]
    texts += ["we've <|endoftext|> it's 12:30, x_y {a}[b]", "don't", "12'30\" x", "a" * 5000, "é," * 400]
    want, encoder = plain(path), Encoder(path, spaces)
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == want(text), repr(text)


def test_cache_stays_bounded(monkeypatch):
    from roadledger.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    monkeypatch.setattr(tokens, "CACHE_RUNS", 10)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, want = Encoder(path, True), plain(path)
    for mark in ("", "'", "日"):
        text = " ".join(f"{chr(97 + i % 26) * (1 + i // 26)}{mark}" for i in range(60))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want(text)
    for cache in (encoder.known, encoder.runs):
        assert 0 < len(cache) <= 10 and 0 < len(cache.old) <= 10


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_files_round_trip_in_order(spark, texts, tmp_path, encoding):
    path, tokenizer = str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(texts(*ODD), path, tokenizer, spaces=False, encoding=encoding, page_bytes=4096)
    rows = sorted((r["start"], r["doc_id"] if r["doc_id"] is not None else -1, tuple(r["ids"]), r["n_tokens"])
                  for r in token_files.read_tokens(spark, path).collect())
    want, at = plain(tokenizer), 0
    assert [r[1] for r in rows] == sorted(-1 if i is None else i for i, _ in ODD)
    texts_of = {}
    for i, t in ODD:
        texts_of.setdefault(-1 if i is None else i, []).append(tuple(want(t)))
    for start, doc, ids, n in rows:
        assert start == at and n == len(ids) and ids in texts_of[doc]
        at += n
    part = next((tmp_path / "t").glob("*.parquet"))
    column = pq.ParquetFile(part).metadata.row_group(0).column(1)
    assert column.has_offset_index
    assert any("DELTA" in e for e in column.encodings) == (encoding == "delta")


def test_reading_lengths_reads_no_ids(spark, texts, tmp_path):
    path = str(tmp_path / "t")
    token_files.write_tokens(texts(*ODD), path, public_tokenizers.path("word_bpe_49k.json"), spaces=False)
    plan = spark.read.schema(token_files.SCHEMA).parquet(path).where("doc_id > 5").select("n_tokens") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and "GreaterThan(doc_id,5)" in plan


def test_empty_table(spark, texts):
    empty = texts(*ODD).limit(0)
    assert token_files.token_rows(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert packing.pack(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("window", [16, 2048])
def test_packing_keeps_every_id_once_and_pads_nothing(spark, texts, window):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(2)
    rows = ODD + [(100 + i, " ".join(rng.choice(["alpha", "of", "zebra"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    # Remainders that do not add up to a window: many texts of one length.
    rows += [(300 + i, "alpha of zebra " * 3) for i in range(50)]
    pieces = packing.pack(texts(*rows), tokenizer, window=window).collect()
    want = plain(tokenizer)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for i in {i for i, _ in rows}:
        expected = sorted(tuple(want(t)) for j, t in rows if j == i)
        if len(expected) == 1:
            got = sorted(by_doc[i], key=lambda p: p["start"])
            assert tuple(x for p in got for x in p["ids"]) == expected[0]
            assert [p["start"] for p in got] == list(np.cumsum([0] + [p["length"] for p in got[:-1]]))
        assert sum(p["length"] for p in by_doc[i]) == sum(map(len, expected))
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n <= window and (n == window or n & (n - 1) == 0) for n in filled.values())
    assert packing.sequences(packing.pack(texts(*rows), tokenizer, window=window)).count() == len(filled)


def test_best_fill_is_the_best_subset():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(1, 80)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        chosen = packing.best_fill(counts, room)
        assert all(0 < n <= counts[k] for k, n in chosen.items())
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


def test_checksum_is_of_unsigned_little_endian_ids(spark):
    row = token_files.with_checksum(spark.createDataFrame([(1, [1, 2, 70000])], "doc_id long, ids array<int>")).first()
    assert row["ids_crc32"] == zlib.crc32(np.array([1, 2, 70000], "<u4").tobytes())


def test_rows_without_an_id_spread_over_ranges(spark, texts, tmp_path):
    path, tokenizer = str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json")
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text number {k}") for k in range(3000)]
    token_files.write_tokens(texts(*rows), path, tokenizer, spaces=False, partitions=10)
    parts = [r["count"] for r in spark.read.parquet(path).groupBy("part").count().collect()]
    assert len(parts) == 10 and max(parts) < 600
    twice = [[(r["doc_id"], r["start"], tuple(r["ids"])) for r in token_files.read_tokens(spark, p).orderBy("start").collect()]
             for p in (path, path)]
    assert twice[0] == twice[1] and [r[0] for r in twice[0]] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
