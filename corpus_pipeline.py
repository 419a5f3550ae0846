"""From raw documents to packed training sequences, a stage at a time; each result is stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.llm import mixing, packing, simhash, substrings, toxicity
from motorpool.llm.common import table
from motorpool.llm.queries import tokenizer_file
from motorpool.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op10 links: its shingles of four words and limit of four bits."""
    return simhash.drop_near_duplicates(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; a document that was one repeated passage stays, with an empty text."""
    out, added = substrings.remove_repeats(docs)
    lost = F.col(added["n_removed"]) > 0
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of smaller sources again, up to the repeat limit."""
    return mixing.mix(docs)[0].select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Neither a trained classifier nor a tokenizer can be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
