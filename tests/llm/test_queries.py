"""The registered queries against their SQL, and the pipeline stage by stage."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from roadledger.llm import quality, queries

from .conftest import ODD

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    answer = con.execute(queries.ORACLE[name])
    columns = sorted(c[0] for c in answer.description)
    names = [c[0] for c in answer.description]
    want = sorted(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
    got = sorted(tuple(r[c] for c in columns) for r in entry.queries()[name](spark, FOLDER).collect())
    assert got == want


def test_pipeline_stages_keep_columns_and_drop_what_they_should(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if n + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
            now = out.count()
            assert now == left if name == "pii" else 0 < now < left
            docs, left = out, now
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_judge_each_row_by_its_text(spark, texts):
    def left(k, rows):
        out = corpus_pipeline.STAGES[k][1](spark, texts(*rows), FOLDER).collect()
        return sorted(((r["doc_id"], r["text"]) for r in out), key=repr)

    item = max((r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if r["text"]), key=len)
    clean = [(None, "nothing in here"), (None, "nothing in here"), (5, "also fine"), (None, None), (5, "")]
    assert left(2, [*clean, (None, item), (5, item)]) == sorted(clean, key=repr)

    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality(docs, labels).join(docs, "doc_id").orderBy("score").select("text").collect()
    bad, good = scored[0]["text"], scored[-1]["text"]
    rows, far = [(None, good), (None, bad), (10**9, bad), (10**9, good), (10**9, good)], "doc_id is null or doc_id >= 1000000000"
    out = corpus_pipeline.STAGES[0][1](spark, docs.unionByName(texts(*rows).select(docs.columns)), FOLDER).where(far).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == {(None, good): 1, (10**9, good): 2}

    near = [f"n{k}" for k in range(100)]
    a, b, c = (" ".join(near[:k]) for k in (100, 99, 98))
    other, third = " ".join(f"o{k}" for k in range(50)), " ".join(f"t{k}" for k in range(50))
    rows = [(3, a), (3, a), (None, b), (9, c), (9, other), (None, other), (None, third), (None, third), (4, None), (4, None), (None, " ")]
    assert left(1, rows) == sorted([(3, a), (9, other), (None, third), (4, None), (4, None), (None, " ")], key=repr)
    assert left(1, [(8, a), (None, b), (2, c), (2, b), (2, b)]) in ([(2, b)], [(2, c)])


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(spark, texts, k):
    """Classifier: short junk may go, nothing is added or changed. Near duplicates: one of each text
    with words. Decontamination and personal data: all rows as they are. Packing: all documents."""
    docs = texts(*ODD)
    out = [r.asDict() for r in corpus_pipeline.STAGES[k][1](spark, docs, FOLDER).collect()]
    want = Counter((i, t) for i, t in ODD)
    if k == 4:
        assert {r["doc_id"] for r in out} == set(dict(ODD))
        # Each row's tokens, by its checksum-bearing pieces: rows with one id are told apart by start.
        assert sum(r["start"] == 0 for r in out) == len(ODD)
    else:
        got = Counter((r["doc_id"], r["text"]) for r in out)
        assert not got - want
        if k == 1:
            gone = want - got
            assert sum(gone.values()) == 2 and {t for _, t in gone} == {"same words here and there"}
        elif k > 1:
            assert got == want
    assert corpus_pipeline.STAGES[k][1](spark, docs.limit(0), FOLDER).count() == 0


def test_the_session_names_the_key(spark, texts):
    docs = texts((1, "mail someone@example.org now"))

    def hidden():
        return corpus_pipeline.STAGES[3][1](spark, docs, FOLDER).first()["text"]

    sample = hidden()
    spark.conf.set(corpus_pipeline.SECRET, "another key")
    try:
        own = hidden()
    finally:
        spark.conf.unset(corpus_pipeline.SECRET)
    assert len({sample, own, "mail someone@example.org now"}) == 3
    assert hidden() == sample
