"""Table contracts of the stored layers.

A contract lists (column, Spark type, maximum text length, required). `conform` applies it to a
DataFrame so that a value that does not fit stops the whole write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    max_length: int | None = None
    required: bool = False

    @property
    def ddl(self) -> str:
        kind = f"VARCHAR({self.max_length})" if self.max_length else self.type.upper()
        return f"{self.name} {kind}"


@dataclass(frozen=True)
class Contract:
    schema: str
    name: str
    fields: tuple[Field, ...]
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T._parse_datatype_string(", ".join(f"{f.name} {f.type}" for f in self.fields))


PERIOD = Field("report_period", "int", required=True)
STAMPS = (Field("created_at", "timestamp_ntz"), Field("updated_at", "timestamp_ntz"))

RAW = Contract("staging", "detran_vehicle_raw", (
    Field("id_raw", "bigint", required=True),
    Field("uf", "string", 100),
    Field("marca_modelo", "string", 100),
    Field("ano_fabricacao_veiculo_crv", "string", 100),
    Field("qtd_veiculos", "string", 100),
    Field("load_timestamp", "timestamp_ntz"),
    Field("source_file", "string", 500),
    Field("csv_row", "bigint"),
    PERIOD,
), partition="report_period")

NORM = Contract("staging", "detran_vehicle_norm", (
    Field("id_norm", "bigint", required=True),
    Field("uf", "string", 100),
    Field("marca", "string", 255),
    Field("modelo", "string", 255),
    Field("ano_fabricacao", "int"),
    Field("frota", "int"),
    Field("descricao_detran", "string", 255),
    Field("importado", "boolean"),
    Field("data_carga", "timestamp_ntz"),
    Field("id_raw", "bigint", required=True),
    PERIOD,
), partition="report_period")

_DIM_FIELDS = (
    Field("id_veiculo", "bigint", required=True),
    Field("hash_veiculo", "string", 64, required=True),
    Field("marca", "string", 255, required=True),
    Field("modelo", "string", 255, required=True),
    Field("ano_fabricacao", "int", required=True),
    Field("descricao_detran", "string", 255),
    *STAMPS,
)
_FACT_FIELDS = (
    Field("id_fato", "bigint", required=True),
    Field("id_veiculo", "bigint", required=True),
    Field("uf", "string", 100, required=True),
    Field("frota", "int", required=True),
    Field("id_raw", "bigint"),
    *STAMPS,
    PERIOD,
)
DIM = Contract("core", "dim_veiculo_detran", _DIM_FIELDS)
FACT = Contract("core", "fato_frota_uf", _FACT_FIELDS, partition="report_period")
AUDIT = Contract("core", "audit_dim_veiculo_detran", (
    Field("hash_veiculo", "string", 64, required=True),
    Field("action", "string", required=True),
    Field("column_name", "string", required=True),
    Field("old_value", "string"),
    Field("new_value", "string"),
    Field("payload", "string"),
    Field("changed_at", "timestamp_ntz"),
    Field("report_period", "int"),
    Field("dim_version", "int", required=True),
), partition="dim_version")
LOAD_LOG = Contract("core", "load_log", (
    Field("stage", "string", required=True),
    Field("n", "bigint", required=True),
    Field("logged_at", "timestamp_ntz"),
    PERIOD,
), partition="report_period")
PUBLISHED_DIM = Contract("analytics", "dim_veiculo_detran", _DIM_FIELDS)
PUBLISHED_FACT = Contract("analytics", "fato_frota_uf", _FACT_FIELDS, partition="report_period")

INPUT_COLUMNS = ("uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos")
DIM_ATTRIBUTES = ("marca", "modelo", "ano_fabricacao", "descricao_detran")

# The wide catalogue dimension: its natural key, then the attributes every upsert rewrites.
WIDE_KEY = "hash_veiculo"
WIDE_ATTRIBUTES = (
    "source_code", "brand", "model", "version", "engine_name", "engine_config", "power_cv", "fuel",
    "aspiration", "ktype_tecdoc", "classification", "vehicle_type", "vehicle_category", "generation",
    "displacement_liters", "command", "cylinder_count", "transmission", "cabin_type", "fipe_code",
    "brand_norm", "model_norm", "version_norm", "engine_name_norm", "engine_config_norm", "fuel_norm",
    "transmission_norm", "aspiration_norm", "year", "load_timestamp", "source_file", "excel_row",
)


def _checked(field: Field) -> Column:
    value = F.col(field.name).cast(field.type)
    if field.max_length:
        message = f"{field.name} is longer than {field.max_length} characters"
        value = F.when(F.length(value) > field.max_length, F.raise_error(F.lit(message))).otherwise(value)
    if field.required:
        value = F.coalesce(value, F.raise_error(F.lit(f"{field.name} must not be NULL")).cast(field.type))
    return value.alias(field.name)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order and type; an over-long text or a missing required value raises."""
    return df.select(*map(_checked, contract.fields))
