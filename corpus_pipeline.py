"""The corpus pipeline: toxicity, exact and near duplicates, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what it
returns as Parquet in the shared checkpoint folder and hands the written table to the next
stage.  All but the last return the columns of ``documents``.  SQL cannot express the
classifier, the sketches or the tokenizer, so there is no ``ORACLE_SQL``; the tests hold
the stages against a plain Python version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailmart.llm import exact_dedup, minhash_dedup, mixing, sentencepiece_codec, toxicity
from retailmart.llm.common import written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def exact_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest doc_id."""
    return exact_dedup.without_exact_duplicates(docs)


def near_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    return minhash_dedup.without_near_duplicates(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, tokens) of every row."""
    return sentencepiece_codec.encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [("toxicity", toxic_out), ("exact dedup", exact_out), ("near dedup", near_out), ("mixing", mix), ("sentencepiece", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
