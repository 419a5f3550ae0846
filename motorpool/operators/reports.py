"""Reporting queries over the fact and the dimension, and file-level roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.functions.numbers import lenient_double

FACT_KEYS = ("report_period", "uf")


def star(fact: DataFrame, dim: DataFrame, period: int | None = None) -> DataFrame:
    """Fact rows with their vehicle; a period prunes the fact's partitions before the join."""
    rows = fact if period is None else fact.where(F.col("report_period") == period)
    return rows.join(dim, "id_veiculo")


def fleet_by(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fleet summed by any mix of fact and vehicle columns.

    Fact columns alone need no join. Otherwise the fact is summed by vehicle first, so the join moves
    one row per vehicle and remaining key instead of one per state and period.
    """
    own = [k for k in keys if k in FACT_KEYS]
    if len(own) == len(keys):
        return fact.groupBy(*keys).agg(F.sum("frota").alias("frota"))
    partial = fact.groupBy("id_veiculo", *own).agg(F.sum("frota").alias("frota"))
    joined = partial.join(dim.select("id_veiculo", *[k for k in keys if k not in own]), "id_veiculo")
    return joined.groupBy(*keys).agg(F.sum("frota").alias("frota"))


def fleet_by_imported(norm: DataFrame) -> DataFrame:
    return norm.groupBy("importado").agg(F.sum("frota").alias("frota"))


def latest_period(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("report_period").alias("report_period"))


def roll_up_to_state(municipal: DataFrame) -> DataFrame:
    """Municipality rows summed to state, make/model and year; rows with a missing key drop out."""
    keys = ["uf", "marca_modelo", "ano_fabricacao_veiculo_crv"]
    counted = municipal.na.drop(subset=keys).withColumn("_n", lenient_double(F.col("qtd_veiculos")))
    return counted.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("qtd_veiculos"))
