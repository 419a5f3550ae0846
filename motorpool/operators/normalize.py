"""Raw rows to typed, brand-checked rows.

Every key carries `report_period`, so one run may hold one period or all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.functions import makemodel as mm
from motorpool.functions.numbers import double_or_infinite, is_finite
from motorpool.functions.text import blank_to_null
from motorpool.operators.brands import MAX_PATTERN_BRANDS, checked_brands, match_by_join, match_by_search
from motorpool.session import settle

MIN_FLEET = 10


def typed_rows(raw: DataFrame) -> DataFrame:
    """Rows whose year and count are both numbers; zero and negative counts stay."""
    numbers = raw.select(
        "report_period", "id_raw", "uf", "marca_modelo",
        double_or_infinite(F.col("ano_fabricacao_veiculo_crv")).alias("_year"),
        double_or_infinite(F.col("qtd_veiculos")).alias("_count"),
    )
    return numbers.where(is_finite(F.col("_year")) & is_finite(F.col("_count"))).select(
        "report_period", "id_raw", "uf", "marca_modelo",
        F.col("_year").cast("int").alias("ano_fabricacao"), F.col("_count").cast("int").alias("frota"),
    )


def split_make_model(rows: DataFrame, brands: Sequence[str] | DataFrame | None) -> DataFrame:
    """Add marca, modelo and importado from `marca_modelo`, before aliases.

    The dictionary is a list of names, matched by one pattern, or a DataFrame of any size with a `brand`
    column, matched by joins. `None` is the basic split: no dictionary, and `IMP` is an ordinary segment.
    Each step is a projection of its own, so that later steps refer to its columns instead of repeating
    its work.
    """
    text, body, segment = F.col("marca_modelo"), F.col("_body"), F.col("_segment")
    rest, found = F.col("_rest"), F.col("_found")
    parts = rows.withColumn("_body", mm.drop_import_prefix(text)).withColumns(
        {"_segment": mm.first_segment(text, body), "_rest": mm.after_segment(body)}
    )
    if brands is None:
        imported = mm.import_prefixed(text).alias("importado")
        return parts.select(*rows.columns, segment.alias("marca"), rest.alias("modelo"), imported)
    parts = parts.withColumn("importado", mm.is_imported(text, segment))
    if isinstance(brands, DataFrame):
        parts = _find_by_join(parts, brands)
    else:
        # The pattern is only evaluated for imported rows.
        hit = mm.dictionary_prefix(rest, checked_brands(brands))
        parts = parts.withColumn("_found", F.when(F.col("importado"), hit))
    brand = F.when(F.col("importado"), F.nullif(found, F.lit(""))).otherwise(segment)
    return parts.select(*rows.columns, brand.alias("marca"), mm.drop_prefix(rest, found).alias("modelo"), "importado")


def _find_by_join(parts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """`_found` from a dictionary table: match the distinct imported texts, then join the hits back.

    A small dictionary is asked for all its name lengths at once, a large one by a search over them, with equal results.

    The hits are settled, so their size decides between a broadcast and a shuffle join. All rows keep
    their own text as join key: a NULL key for domestic rows would gather them in one partition.
    """
    if not dictionary.where(F.col("brand") == mm.IMPORT_SEGMENT).isEmpty():
        raise ValueError(f"{mm.IMPORT_SEGMENT} marks imports and cannot be a brand")
    large = dictionary.limit(MAX_PATTERN_BRANDS + 1).count() > MAX_PATTERN_BRANDS
    match = match_by_search if large else match_by_join
    hits = settle(match(parts.where("importado"), "_rest", dictionary), "hits")
    joined = parts.join(hits.withColumnRenamed("brand", "_hit"), "_rest", "left")
    return joined.withColumn("_found", F.when(F.col("importado"), F.coalesce("_hit", F.lit("")))).drop("_hit")


def apply_aliases(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical brand for a listed alias, the brand itself otherwise.

    A join and not a CASE: later filters on the brand then stay above it instead of being copied into
    every arm. The planner broadcasts the aliases by their known size.
    """
    entries = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    matched = rows.join(entries, F.col("marca") == F.col("_alias"), "left")
    brand = F.coalesce("_canonical", "marca").alias("marca")
    return matched.select(*[brand if c == "marca" else c for c in rows.columns])


def parse_rows(raw: DataFrame, brands: Sequence[str] | DataFrame | None, aliases: DataFrame | None) -> DataFrame:
    rows = split_make_model(typed_rows(raw), brands)
    return rows if aliases is None else apply_aliases(rows, aliases)


def brand_totals(parsed: DataFrame, count_imported: bool = True) -> DataFrame:
    """Fleet per period and brand; handmade vehicles (`A.`) never count.

    Summed in the map tasks first, so a brand that holds a third of all rows sends one row per task.
    """
    counted = parsed.where(~mm.is_handmade(F.col("marca")) & F.col("marca").isNotNull())
    if not count_imported:
        counted = counted.where(~F.col("importado"))
    return counted.groupBy("report_period", "marca").agg(F.sum("frota").alias("frota"))


def valid_brands(parsed: DataFrame, count_imported: bool = True, min_fleet: int = MIN_FLEET) -> DataFrame:
    return brand_totals(parsed, count_imported).where(F.col("frota") > min_fleet)


def normalize(
    raw: DataFrame,
    brands: Sequence[str] | DataFrame | None,
    aliases: DataFrame | None,
    *,
    count_imported: bool = True,
    min_fleet: int = MIN_FLEET,
    drop_empty: bool = True,
) -> DataFrame:
    """Typed rows of brands with more than `min_fleet` vehicles in their period.

    The brand totals are settled first (a scan of four columns and one small shuffle). Their size is
    then known, so the large side is filtered by a broadcast semi-join without being shuffled, or,
    should the brands not fit a broadcast, by a shuffle join that AQE splits at hot brands.
    """
    parsed = parse_rows(raw, brands, aliases)
    valid = settle(valid_brands(parsed, count_imported, min_fleet).select("report_period", "marca"), "brands")
    kept = parsed.join(valid, ["report_period", "marca"], "left_semi")
    if drop_empty:
        # One condition over both texts, from which no condition on the model alone follows: it stays
        # above the alias join, so the parse is not repeated inside a pushed-down filter.
        kept = kept.where(F.coalesce(F.length("marca") * F.length("modelo"), F.lit(0)) > 0)
    return kept.select(
        "report_period", "id_raw", "uf", "marca", "modelo", "ano_fabricacao", "frota",
        F.col("marca_modelo").alias("descricao_detran"), "importado",
    )


def stored_form(norm: DataFrame) -> DataFrame:
    """Texts as the norm layer keeps them: whitespace-only becomes NULL."""
    texts = ("uf", "marca", "modelo", "descricao_detran")
    return norm.withColumns({c: blank_to_null(F.col(c)) for c in texts})
