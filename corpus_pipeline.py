"""The corpus pipeline: stages over documents, each of which calls one operator of eventloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import chunks, language_id, mixing, packing, simhash
from eventloom.llm.common import scratch, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found: no letter, or no n-gram of a learned language."""
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of texts whose five-word shingles are similar by 0.8 or more."""
    return simhash.one_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur before, in a document with a smaller id or in the text itself."""
    return chunks.remove(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources needs it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 4,096."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Bloom filters, fingerprints and a linear program can't be said in SQL; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; what a stage keeps is written to the shared folder and read by the next, after which a stage's own tables go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *others, (_, last) = STAGES
    for _, stage in others:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), keep=True)
    return last(spark, docs, sf_dir)
