"""Lookup values and small inline tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Brand aliases, alias = canonical brand.
_BRAND_ALIASES = """
R = REBOQUE
REB = REBOQUE
SR = SEMI REBOQUE
VW = VOLKSWAGEN
VOLKS = VOLKSWAGEN
GM = CHEVROLET
CHEV = CHEVROLET
MERCEDES-BENZ = MERCEDES BENZ
MBENZ = MERCEDES BENZ
HARLEY DAVIDSON = HARLEY-DAVIDSON
H.DAVIDSON = HARLEY-DAVIDSON
M.BENZ = MERCEDES BENZ
JTZ = HAOJUE
JTA = SUZUKI
JTA-SUZUKI = SUZUKI
MPOLO = MARCOPOLO
MMC = MITSUBISHI
CAOACHERY = CHERY
LR = LAND ROVER
RE = ROYAL ENFIELD
MOTO TRAXX = TRAXX
IVECOFIAT = IVECO
"""

# Fuel names after text normalisation, `-` stands for "unknown".
_FUELS = """
GASOLINA = GASOLINA
DIESEL = DIESEL
FLEX = FLEX
ETANOL = ETANOL
ELETRICO = ELETRICO
GASOLINA/ELETRICO = HIBRIDO GASOLINA
DIESEL/ELETRICO = HIBRIDO DIESEL
FLEX/ELETRICO = HIBRIDO FLEX
GAS VEICULAR = GNV
FLEX/GNV = FLEX GNV
- =
"""

# Transmission names after text normalisation and first-of-list selection.
_TRANSMISSIONS = """
MANUAL = MANUAL
AUTOMATICA = AUTOMATICA
AUTOMATIZADA = AUTOMATIZADA
CVT = CVT
MECANICA = MANUAL
SINCRONIZADA = MANUAL
SEMIAUTOMATICA = SEMIAUTOMATICA
SEMI-AUTOMATIZADA = SEMIAUTOMATICA
- =
"""

# Cell texts that stand for a missing value in a delimited file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Makes for the fixture and the tests. The job takes its dictionary as an input and has no default, so that no
# make is dropped unnoticed (see `operators.brands.load_dictionary` and `dictionary_from_catalogue`).
STARTER_BRANDS = tuple(
    line.strip()
    for line in """
    ALFA ROMEO
    AMAZON
    AMAZONAS
    ASTON MARTIN
    AUDI
    BMW
    BYD
    CASE
    CASE IH
    CHERY
    CHEVROLET
    CHRYSLER
    CITROEN
    DAF
    DAFRA
    DODGE
    DUCATI
    FERRARI
    FIAT
    FIAT ALLIS
    FORD
    GWM
    HAOJUE
    HARLEY-DAVIDSON
    HONDA
    HYUNDAI
    IVECO
    JAC
    JACTO
    JAGUAR
    JEEP
    KAWASAKI
    KIA
    LAND ROVER
    LEXUS
    MAN
    MANGOSTEEN
    MARCOPOLO
    MASERATI
    MAZDA
    MERCEDES BENZ
    MINI
    MITSUBISHI
    NISSAN
    PEUGEOT
    PORSCHE
    RAM
    RENAULT
    ROYAL ENFIELD
    SCANIA
    SUBARU
    SUZUKI
    SWM
    SWM MOTORS
    TESLA
    TOYOTA
    TRAXX
    TRIUMPH
    VOLKSWAGEN
    VOLVO
    YAMAHA
    """.strip().splitlines()
)


def _pairs(block: str) -> tuple[tuple[str, str | None], ...]:
    rows = (line.split("=", 1) for line in block.strip().splitlines())
    return tuple((key.strip(), value.strip() or None) for key, value in rows)


BRAND_ALIASES = _pairs(_BRAND_ALIASES)
FUELS = _pairs(_FUELS)
TRANSMISSIONS = _pairs(_TRANSMISSIONS)


def sql_literal(value: object) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values_clause(rows: Iterable[Sequence[object]]) -> str:
    return ", ".join("(" + ", ".join(map(sql_literal, row)) + ")" for row in rows)


def inline_table(spark: SparkSession, rows: Iterable[Sequence[object]], columns: Sequence[str]) -> DataFrame:
    """A constant table whose exact size the planner knows, so joins to it broadcast by size check.

    `createDataFrame` hides the size from the planner; an inline VALUES table does not.
    """
    if any("\\" in str(v) for row in rows for v in row):
        raise ValueError("inline tables do not take backslashes")
    return spark.sql(f"SELECT * FROM VALUES {values_clause(rows)} AS t({', '.join(columns)})")


def alias_table(spark: SparkSession, pairs: Sequence[Sequence[str | None]] = BRAND_ALIASES) -> DataFrame:
    return inline_table(spark, pairs, ("alias", "canonical"))


def lookup_table(spark: SparkSession, pairs: Sequence[Sequence[str | None]]) -> DataFrame:
    """(entry, meaning, known): `known` tells a mapped NULL from a missing entry."""
    return inline_table(spark, pairs, ("entry", "meaning")).withColumn("known", F.lit(True))
