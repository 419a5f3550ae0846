"""Natural-key hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VEHICLE_PARTS = ("marca", "modelo", "ano_fabricacao")
CATALOGUE_PARTS = (
    "brand_norm", "model_norm", "version_norm", "fuel_norm", "transmission_norm",
    "aspiration_norm", "engine_config_norm", "engine_name_norm", "source_code", "year",
)


def joined_sha256(*parts: Column) -> Column:
    """Lower-hex SHA-256 of the parts joined by `|`, NULL as an empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def vehicle_hash() -> Column:
    return joined_sha256(*map(F.col, VEHICLE_PARTS))


def catalogue_hash() -> Column:
    return joined_sha256(*map(F.col, CATALOGUE_PARTS))
