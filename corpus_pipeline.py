"""Corpus pipeline: toxicity filter, line dedup, near-duplicate removal, source mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as parquet
below the checkpoint folder and reads back as the next stage's ``docs``. All stages but the
last return the columns of documents; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.llm import byte_bpe, line_dedup, minhash_dedup, source_mix, toxicity
from histmill.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. The model learns from the stage's own
    documents and the table ``labels``, without the held-out rows."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them. Null texts stay null."""
    kept = line_dedup.dedup_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    columns = {"text": text} | ({"n_chars": F.when(F.col("n_dropped") > 0, F.length(text).cast("long"))
                                 .otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return kept.withColumns(columns).select(docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return source_mix.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the decoded bytes."""
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN, keep=("doc_id", "source"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_dedup", dedup_documents),
          ("source_mix", mix_sources), ("byte_bpe", encode)]

#: A trained model and random rounding: no SQL twin; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
