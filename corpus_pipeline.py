"""A corpus pipeline of five stages over `documents`: toxic documents go, one
document of each group of near copies stays, personal data is replaced, sources
are mixed to equal weights, and what is left is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, jaccard, mixing, pii, toxicity
from tidewright.llm.common import stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below an even chance of a toxic label; the model learns from
    labels that are not held out. A null or empty text is clean; equal rows stay
    or go together; an empty table stays empty; columns of any name pass through."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id")))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component of documents that share three
    quarters of their five-word shingles. Null and empty texts and rows with a
    null id stay; of rows that share an id one stays; an empty table stays
    empty; columns of any name pass through."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars follows, null for a null text.
    Equal rows give equal results; an empty table stays empty; other columns of any name pass through."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """About as many documents as before, from every source alike; copies keep
    their doc_id. A null source is one of its own, null and repeated ids draw
    alike; an empty table stays empty; columns of any name pass through."""
    return mixing.mix_sources(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of ids and decoded bytes, and the ids. A
    null or empty text has none; other columns are not read; an empty table gives an empty one."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("toxicity", toxic), ("ngram_jaccard_join", near_copies), ("pii", personal_data), ("mixing", mix), ("bpe", tokens)]

#: SQL can express neither the learned stages nor the encoding; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored in the shared folder and read
    again by the next, so that a lost executor costs the tasks of one stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
