"""A training corpus from `documents`: five stages, each one of the operators of rankflow.llm.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of documents; the last one
returns packed pieces.  Each stage's rows are written and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import packing, secrets, simhash, suffix_dedup, toxicity
from rankflow.llm.common import fresh, table
from rankflow.session import written

TOXIC = 0.7
# Bytes of words that each of packing's workers remembers, of parts and of words, and of texts it encodes at once.  All stages share
# an executor, so packing takes less here than alone; the ids are the same.
PACK_MEMORY, PACK_SLICE = 32 << 20, 2 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below TOXIC; the model learns from `labels` of rows that are not held out."""
    score = fresh("__score", docs.columns)
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, score).where(F.col(score) < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked as by `op8_simhash`; the smallest id stays, and so do rows without an id."""
    return simhash.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that a document with a smaller id holds too.

    All documents stay.  A cut inside a character removes the whole character; n_chars is counted again where a text changed.
    """
    cut = suffix_dedup.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    # bytes that are no whole character any more become replacement signs, which go
    text = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\uFFFD", "")
    new = {"text": F.when(changed, text).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(text).cast("long"))
           .otherwise(F.col("n_chars"))}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by [SECRET]; all documents stay, n_chars is counted again."""
    clean = secrets.redact(docs, secrets.train_markov(secrets.labelled_samples(docs)))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4,096 tokens, one row per piece with its ids."""
    return packing.pack(docs, packing.word_encoder("word_bpe_49k.json", PACK_MEMORY), slice_bytes=PACK_SLICE)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("suffix_array", cut_repeats), ("secrets", redact_secrets),
          ("packing", pack)]
# No stage but the patterns of the fourth can be written in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
