"""Corpus pipeline over ``documents``: five stages, each working on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again for the next. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from sensorloom.llm.pairs import with_row_id
from sensorloom.llm.queries import SOURCE_WEIGHTS, TOKENIZER
from sensorloom.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: No SQL can learn the toxicity model; the stages are tested against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3. The model learns from labels outside the held-out quarter."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs.select("doc_id", "text"), toxicity.training_labels(labels))
    return toxicity.score(docs.select(*COLUMNS), model, out="_score").where(F.col("_score") < 0.3).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; a document of which no words are left goes."""
    cleaned = line_dedup.remove_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_removed") > 0) & (mixing.word_count(F.col("text")) == 0)
    return cleaned.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group linked by five-word shingles with a similarity of 0.8 or more."""
    rows = with_row_id(docs.select(*COLUMNS), "doc_id", "text")
    groups = ngram_join.components(rows, k=5, percent=80, key="_uid")
    return rows.join(groups.where(F.col("_uid") == F.col("component_id")).select("_uid"), "_uid", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a last copy taken in part has its first words."""
    rows = with_row_id(docs.select(*COLUMNS), "doc_id", "text")
    taken = settle(mixing.mix(rows, SOURCE_WEIGHTS, share_percent=150, max_epochs=2, key="_uid").select("_uid", "size", "whole", "partial"))
    full = F.col("whole") + (F.col("partial") == F.col("size")).cast("long")
    part = F.when((F.col("partial") > 0) & (F.col("partial") < F.col("size")), 1).otherwise(0)
    copies = taken.withColumn("_full", F.when(F.col("size") > 0, full).otherwise(1)).withColumn("_copies", F.col("_full") + part)
    joined = rows.join(copies.where("_copies > 0"), "_uid")
    joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    word_ends = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    first_words = F.array_join(F.slice(word_ends, 1, F.greatest(F.lit(1), F.col("partial").cast("int"))), "")
    joined = joined.withColumn("text", F.when(F.col("_copy") <= F.col("_full"), F.col("text")).otherwise(first_words))
    return joined.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each copy's token ids, and of the text decoded from them."""
    return bpe.round_trip_digest(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each),
    ("source_mix", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else settle(docs), sf_dir)
    return docs
