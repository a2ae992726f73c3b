"""The training-data pipeline over ``documents``: each stage works on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next one's docs.  All but the last return the columns of ``documents``; a stage whose results
have a column of the same name as an extra one of docs keeps docs' column.

1. toxicity: documents that the classifier rejects go.
2. ngram_join: of each component of near duplicates one document stays, that with the smallest id.
3. substring_dedup: words in passages that also start earlier go; untouched texts stay as they are.
4. decontamination: documents with benchmark passages go.
5. sentencepiece: the texts as piece ids, and sampled segmentations.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import decontaminate, ngram_join, pieces, substring_dedup, toxicity
from pitpanel.llm.text import ship, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = toxicity.fit(toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    named = docs.toDF(*(f"d{k}" for k in range(len(docs.columns))))
    scored = toxicity.score(named, model, text=f"d{docs.columns.index('text')}", keep=tuple(named.columns))
    return scored.where("predicted = 0").drop("score", "predicted").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    named = docs.toDF(*(f"d{k}" for k in range(len(docs.columns))))
    at = lambda c: f"d{docs.columns.index(c)}"
    out = substring_dedup.dedup(named, doc_id=at("doc_id"), text=at("text"))
    out = out.withColumn(at("text"), F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(at("text"))))
    if "n_chars" in docs.columns:
        out = out.withColumn(at("n_chars"), F.when(F.col("n_removed") > 0, F.length(at("text")).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(at("n_chars"))))
    return out.select(named.columns).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` (the library's encoding) and ``samples`` (distinct sampled segmentations with inclusion scores)."""
    ship(spark)
    return pieces.segment(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

#: SQL cannot express the trained classifier and the sampled segmentations; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
