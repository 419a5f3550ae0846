"""The registered queries of this package, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.llm import (
    alignment, chat, filter_audit, mixing, near_vectors, neighbours, packing, quality, sharding, simhash, substrings, toxicity, warc,
)
from motorpool.llm.common import table


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs)[0].drop("text")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))[0].drop("text", "lang", "n_chars")


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op8_spherical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("part", "place")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_substrings": op4_substrings,
    "op5_mixing": op5_mixing,
    "op6_learned_partitions": op6_learned_partitions,
    "op7_snapshots": op7_snapshots,
    "op8_spherical_cells": op8_spherical_cells,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_filter_audit": op11_filter_audit,
    "op12_sharding": op12_sharding,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {"op7_snapshots": chat.ORACLE, "op9_warc": warc.ORACLE, "op11_filter_audit": filter_audit.ORACLE}
