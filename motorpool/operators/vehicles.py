"""Vehicle dimension and fleet fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.functions.hashing import catalogue_hash, vehicle_hash
from motorpool.schemas import DIM_ATTRIBUTES


def with_vehicle_hash(norm: DataFrame) -> DataFrame:
    return norm.withColumn("hash_veiculo", vehicle_hash())


def with_catalogue_hash(norm: DataFrame) -> DataFrame:
    """Catalogue row without its staging bookkeeping columns, plus the ten-part hash."""
    return norm.drop("id_norm", "id_raw", "data_carga").withColumn("hash_veiculo", catalogue_hash())


def distinct_hashes(norm: DataFrame) -> DataFrame:
    """One row per vehicle hash; hashing runs on the distinct attributes, not on every row."""
    distinct = norm.select("marca", "modelo", "ano_fabricacao").distinct()
    return with_vehicle_hash(distinct).select("hash_veiculo").distinct()


def vehicle_dim(norm: DataFrame) -> DataFrame:
    """One row per vehicle hash, with the attributes of its latest period and, there, lowest id.

    Two aggregates on purpose: the first has only numeric buffers, so it runs hashed and shrinks every
    repeated description inside the map tasks; the ordered pick then sees few rows.
    """
    variants = norm.groupBy("report_period", *DIM_ATTRIBUTES).agg(F.min("id_raw").alias("first_id"))
    hashed = with_vehicle_hash(variants)
    order = F.struct(-F.col("report_period"), F.col("first_id"))
    picked = hashed.groupBy("hash_veiculo").agg(F.min_by(F.struct(*DIM_ATTRIBUTES), order).alias("v"))
    return picked.select("hash_veiculo", "v.*")


def fleet_cells(norm: DataFrame) -> DataFrame:
    """Fleet by period, vehicle hash and state; rows without a state have no cell.

    Rows of one vehicle are summed before anything is joined to them, so no later join sees a vehicle
    more often than it has states.
    """
    sums = F.sum("frota").alias("frota"), F.max("id_raw").alias("id_raw")
    placed = norm.where(F.col("uf").isNotNull())
    # By the hashed columns first: the hash is then made once a vehicle and state, not once a row.
    cells = placed.groupBy("report_period", "marca", "modelo", "ano_fabricacao", "uf").agg(*sums)
    return with_vehicle_hash(cells).groupBy("report_period", "hash_veiculo", "uf").agg(*sums)


def attach_ids(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join of rows carrying `hash_veiculo` to their surrogate key."""
    return rows.join(dim.select("hash_veiculo", "id_veiculo"), "hash_veiculo", "left")


def lookup_ids(hashes: DataFrame, dim: DataFrame) -> DataFrame:
    """(hash_veiculo, id_veiculo) of the hashes that exist."""
    return dim.select("hash_veiculo", "id_veiculo").join(hashes.select("hash_veiculo"), "hash_veiculo", "left_semi")


def fleet_fact(norm: DataFrame, dim: DataFrame) -> DataFrame:
    """Fleet by period, vehicle id and state, from aggregated cells."""
    cells = attach_ids(fleet_cells(norm), dim).where(F.col("id_veiculo").isNotNull())
    return cells.select("report_period", "id_veiculo", "uf", "frota", "id_raw")
