"""Vehicle-catalogue normalisation: dictionaries, decimal commas and year ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.dictionaries import FUELS, TRANSMISSIONS, lookup_table
from motorpool.functions.numbers import decimal_comma, truncated_int
from motorpool.functions.text import blank_to_null, normalize_text
from motorpool.operators.upsert import upsert
from motorpool.operators.vehicles import with_catalogue_hash
from motorpool.schemas import WIDE_ATTRIBUTES, WIDE_KEY

# Catalogue source column -> normalised column.
COLUMN_MAP = {
    "marca": "marca",
    "modelo_veiculo": "modelo",
    "nome_veiculo": "versao",
    "nome_motor": "motor",
    "tipo_transmissao": "transmissao",
    "combustivel": "combustivel",
    "aspiracao": "aspiracao",
}


def aspiration(col: Column) -> Column:
    return F.nullif(normalize_text(col), F.lit("-"))


def first_listed(col: Column) -> Column:
    return F.split_part(col, F.lit(";"), F.lit(1))


def through_dictionary(
    rows: DataFrame, column: str, pairs: Sequence[Sequence[str | None]], output: str, composite: bool = False
) -> DataFrame:
    """Normalised text replaced by its dictionary meaning; an unlisted text stays as normalised."""
    source = first_listed(F.col(column)) if composite else F.col(column)
    keyed = rows.withColumn("_text", normalize_text(source))
    entries = lookup_table(rows.sparkSession, pairs)
    matched = keyed.join(entries, F.col("_text") == F.col("entry"), "left")
    meaning = F.when(F.col("known"), F.col("meaning")).otherwise(F.col("_text"))
    return matched.select(*rows.columns, meaning.alias(output))


def fuel(rows: DataFrame, column: str, output: str) -> DataFrame:
    return through_dictionary(rows, column, FUELS, output)


def transmission(rows: DataFrame, column: str, output: str) -> DataFrame:
    return through_dictionary(rows, column, TRANSMISSIONS, output, composite=True)


def map_columns(source: DataFrame) -> DataFrame:
    """Catalogue source columns under their normalised names, others unchanged."""
    return source.withColumnsRenamed(COLUMN_MAP)


def normalize_catalogue(source: DataFrame) -> DataFrame:
    """One normalised row per source row: repeats stay, `merge_wide` removes them by hash."""
    renamed = map_columns(source)
    typed = renamed.withColumns({
        **{f"{c}_norm": normalize_text(F.col(c)) for c in ("marca", "modelo", "versao", "motor")},
        "aspiracao_norm": aspiration(F.col("aspiracao")),
        "cilindrada": decimal_comma(F.col("cilindrada_litros")),
        "cilindros": truncated_int(F.col("numero_cilindros")),
        "potencia": truncated_int(F.replace(first_listed(F.col("potencia_cv")), F.lit(","), F.lit("."))),
        "ano_inicio": truncated_int(F.col("data_inicio")),
        "ano_fim": truncated_int(F.col("data_final")),
    })
    return transmission(fuel(typed, "combustivel", "combustivel_norm"), "transmissao", "transmissao_norm")


def wide_rows(norm: DataFrame) -> DataFrame:
    """Rows of the wide catalogue dimension: ten-part hash, then the attributes, blank texts as NULL."""
    hashed = with_catalogue_hash(norm)
    kinds = dict(hashed.dtypes)
    texts = {c: blank_to_null(F.col(c)) for c in WIDE_ATTRIBUTES if kinds[c] == "string"}
    return hashed.withColumns(texts).select(WIDE_KEY, *WIDE_ATTRIBUTES)


def merge_wide(target: DataFrame, norm: DataFrame) -> DataFrame:
    """Wide dimension after a load: every attribute of a known hash is rewritten, new hashes come in.

    A batch may repeat a hash; its row with the lowest source row number counts, then the lowest attributes.
    """
    row = F.struct(*WIDE_ATTRIBUTES)
    picked = wide_rows(norm).groupBy(WIDE_KEY).agg(F.min_by(row, F.struct("excel_row", row)).alias("v"))
    return upsert(target, picked.select(WIDE_KEY, "v.*"), [WIDE_KEY], WIDE_ATTRIBUTES)


def year_range_rules(rows: DataFrame, start: str, end: str, required: Sequence[str] = ()) -> DataFrame:
    """Boolean rule columns: ordered range, plausible start, required fields present."""
    ordered = F.col(start).isNull() | F.col(end).isNull() | (F.col(start) <= F.col(end))
    plausible = F.coalesce(F.col(start).between(1900, 2100), F.lit(False))
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    return rows.withColumns({"range_ordered": ordered, "start_plausible": plausible, "fields_present": present})
