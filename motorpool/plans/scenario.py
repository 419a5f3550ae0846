"""A full warehouse run over the derived fixture: files, three periods, publish, roll back, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import STARTER_BRANDS
from motorpool.plans.fixture import vehicle_raw
from motorpool.plans.job import Outcome, run
from motorpool.schemas import INPUT_COLUMNS
from motorpool.session import scratch_path
from motorpool.sources.delimited import REQUIRED_HEADERS, write_delimited
from motorpool.sources.publish import Publication
from motorpool.sources.warehouse import Warehouse

_built: dict[tuple[str, str, str], object] = {}


@dataclass
class Scenario:
    warehouse: Warehouse
    publication: Publication
    outcomes: list[Outcome]

    @property
    def last_period(self) -> int:
        return self.outcomes[-1].period


def _once(kind: str, spark: SparkSession, sf_dir: str, build):
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw fixture as the raw layer stores it: Parquet, partitioned by period, written once."""

    def build() -> DataFrame:
        path = scratch_path(spark, "raw")
        vehicle_raw(spark, sf_dir).write.partitionBy("report_period").parquet(path)
        schema = "id_raw bigint, uf string, marca_modelo string, ano_fabricacao_veiculo_crv string, " \
                 "qtd_veiculos string, report_period int"
        return spark.read.schema(schema).parquet(path)

    return _once("raw", spark, sf_dir, build)


def write_inputs(raw: DataFrame, base: str) -> list[int]:
    """One folder of ordered files per period, as the job expects them; returns the periods."""
    periods = sorted(r.report_period for r in raw.select("report_period").distinct().collect())
    for period in periods:
        ordered = (
            raw.where(F.col("report_period") == period)
            .repartitionByRange("id_raw")
            .sortWithinPartitions("id_raw")
        )
        write_delimited(
            ordered.select(*[F.col(c).alias(h) for c, h in zip(INPUT_COLUMNS, REQUIRED_HEADERS)]),
            f"{base}/{period}",
        )
    return periods


def _build(spark: SparkSession, sf_dir: str) -> Scenario:
    root = scratch_path(spark, "warehouse")
    prefix = f"mp_{root.rsplit('-', 1)[-1][:8]}_"
    periods = write_inputs(stored_raw(spark, sf_dir), f"{root}/input")
    outcomes = [
        run(spark, root, f"{root}/input", period=p, multi_file=True, prefix=prefix, brands=STARTER_BRANDS)
        for p in periods
    ]
    warehouse = Warehouse(spark, root, prefix)
    publication = Publication(warehouse)
    # Undo the last publish and publish again: current = everything, previous = without the last period.
    publication.rollback()
    publication.publish()
    return Scenario(warehouse, publication, outcomes)


def scenario(spark: SparkSession, sf_dir: str) -> Scenario:
    return _once("scenario", spark, sf_dir, lambda: _build(spark, sf_dir))
