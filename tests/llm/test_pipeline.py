import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorloom.llm import mixing, queries
from tests.llm import samples

ROWS = samples.documents(seed=11)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, samples.SCHEMA).persist()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "source_mix", "bpe"]


def test_toxic_documents_go(spark, sf, docs):
    rows = docs.unionByName(spark.createDataFrame([(9001, "you are a stupid idiot", "en", "s1", 22)], samples.SCHEMA))
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, rows, sf).collect()}
    assert kept == {r[0] for r in ROWS}


def test_line_stage(spark, sf, docs):
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs, sf).collect()}
    want = {i: (t, len(t)) for i, t, removed in samples.without_later_lines([r[:2] for r in ROWS], 5, 80) if not removed or samples.WORD.search(t)}
    assert got == want


def test_join_stage(spark, sf, docs):
    got = [r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, sf).collect()]
    assert sorted(got) == sorted({c for _, _, c in samples.components([r[:2] for r in ROWS], 5, 80)})


def test_join_stage_with_repeated_ids(spark, sf):
    rows = spark.createDataFrame([(1, "a b c d e f", None, None, 0), (1, "a b c d e f", None, None, 0), (1, "z", None, None, 0), (None, "z", None, None, 0)], samples.SCHEMA)
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_each(spark, rows, sf).collect())
    assert got == [(1, "a b c d e f"), (1, "z")]


def test_mix_stage(spark, sf, docs):
    taken = {r["doc_id"]: r for r in mixing.mix(docs, queries.SOURCE_WEIGHTS).collect()}
    out = corpus_pipeline.mix_sources(spark, docs, sf)
    words = out.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"), F.count("*").alias("copies")).collect()
    got = {r["doc_id"]: r["n"] for r in words}
    for i, row in taken.items():
        assert got.get(i, 0) == row["taken"]
    texts = {r[0]: r[1] or "" for r in ROWS}
    assert all(texts[r["doc_id"]].startswith(r["text"] or "") for r in out.collect())
    assert {i for i, t in texts.items() if not samples.WORD.search(t)} <= set(got)


def test_last_stage_and_whole_run(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    assert len(out) > 0
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    docs = spark.createDataFrame(ROWS[:5], samples.SCHEMA)
    for r in corpus_pipeline.encode(spark, docs, sf).collect():
        ids = library.encode(dict(x[:2] for x in ROWS)[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_empty_table(spark, sf):
    frame = spark.createDataFrame([], samples.SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, sf).count() == 0
