"""Training-data pipeline: five stages over ``documents``, each written as
Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, hyperlang, mixture, simhash_bits, token_orc
from tessera.llm.common import stored
from tessera.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A text whose cosine is not this much above that by chance is like no language that was learned.
MIN_SCORE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those whose language is undetermined
    (null, no letter), that have no learned letter, or that are no more like a
    language than by chance (``hyperlang.known``) go."""
    ensure_checkpoint_dir(spark)
    profiles, seen = hyperlang.learn(docs, F.col("lang"), ~hyperlang.held_out())
    return hyperlang.keep_known(docs, profiles, MIN_SCORE, seen=seen)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: 4-word shingles, 4 bits."""
    ensure_checkpoint_dir(spark)
    return simhash_bits.keep_one(docs, words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ensure_checkpoint_dir(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by target weight; a document taken twice is two rows,
    one taken partly has the words that were taken."""
    ensure_checkpoint_dir(spark)
    return mixture.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files, and the index that is read back from them."""
    ensure_checkpoint_dir(spark)
    return token_orc.encode_documents(docs, TOKENIZER)


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: Training, components, alignment and tokenizing are beyond SQL; the tests hold
#: the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each returns is written to the shared folder."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
