"""Registered queries: every callable takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import STARTER_BRANDS, alias_table
from motorpool.functions import makemodel as mm
from motorpool.functions.numbers import decimal_comma, is_period, truncated_int
from motorpool.functions.text import blank_to_null, clean_cell, normalize_text
from motorpool.operators import catalogue, quality, reports
from motorpool.operators.brands import (
    dictionary_from_catalogue, dictionary_table, match_by_join, match_by_search,
)
from motorpool.operators.keys import bucket_count, dense_ids
from motorpool.operators.normalize import (
    apply_aliases, normalize, parse_rows, split_make_model, typed_rows, valid_brands,
)
from motorpool.operators.upsert import change_payload, changes, repeated_keys, upsert
from motorpool.operators.vehicles import (
    attach_ids, distinct_hashes, fleet_cells, lookup_ids, vehicle_dim, with_catalogue_hash, with_vehicle_hash,
)
from motorpool.plans import fixture
from motorpool.plans.scenario import scenario, stored_raw
from motorpool.schemas import DIM, DIM_ATTRIBUTES, FACT, LOAD_LOG, NORM, RAW, WIDE_KEY
from motorpool.session import scratch_path, settle, settle_counted
from motorpool.sources.delimited import missing_to_null, read_delimited, read_records, list_inputs, write_delimited

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCAN_PERIOD = 202506


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _sql(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fixture.run_sql(spark, sf, text)


def _norm(spark, sf) -> DataFrame:
    return normalize(stored_raw(spark, sf), STARTER_BRANDS, alias_table(spark))


def _stored_norm(spark, sf) -> DataFrame:
    """Normalised rows with the fixture's own ids, settled for queries that read them more than once."""
    return settle(_norm(spark, sf), "norm")


def _split(spark, sf) -> DataFrame:
    return split_make_model(typed_rows(stored_raw(spark, sf)), STARTER_BRANDS)


def _texts(spark, sf) -> DataFrame:
    text = F.col("marca_modelo")
    body = stored_raw(spark, sf).select("id_raw", "marca_modelo", mm.drop_import_prefix(text).alias("body"))
    return body.withColumns({
        "segment": mm.first_segment(text, F.col("body")), "rest": mm.after_segment(F.col("body")),
    })


# Scans and cells

@query
def raw_period_scan(spark, sf):
    rows = stored_raw(spark, sf).where(F.col("report_period") == SCAN_PERIOD)
    return rows.select("id_raw", "uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos")


@query
def norm_period_scan(spark, sf):
    rows = scenario(spark, sf).warehouse.read(NORM, SCAN_PERIOD)
    return rows.select("uf", "marca", "modelo", "ano_fabricacao", "frota", "descricao_detran", "importado")


@query
def raw_layer_load(spark, sf):
    rows = scenario(spark, sf).warehouse.read(RAW)
    return rows.select("report_period", "uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos")


@query
def row_preview(spark, sf):
    return stored_raw(spark, sf).orderBy("id_raw").limit(5).select("id_raw", "report_period", "uf")


@query
def valid_period_filter(spark, sf):
    return _sql(fixture.PERIOD_TEXT_SQL)(spark, sf).where(is_period(F.col("period_text")))


@query
def clean_cells(spark, sf):
    rows = _sql(fixture.DIRTY_CELL_SQL)(spark, sf)
    return rows.select("id_raw", clean_cell(F.col("cell")).alias("cell"), blank_to_null(F.col("cell")).alias("kept"))


@query
def missing_tokens(spark, sf):
    rows = _sql(fixture.TOKEN_SQL)(spark, sf)
    return rows.select("id_raw", missing_to_null("cell").alias("cell"))


@query
def numeric_coercion(spark, sf):
    rows = _sql(fixture.NUMBER_TEXT_SQL)(spark, sf)
    return rows.select("id_raw", truncated_int(F.col("cell")).alias("value"))


@query
def file_order_ordinal(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    folder = scratch_path(spark, "ordered")
    write_delimited(orders.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey"), folder)
    records, _ = read_records(read_delimited(spark, list_inputs(spark, folder)))
    key = F.col("o_orderkey").cast("bigint")
    return records.select(key.alias("o_orderkey"), "o_orderpriority", F.col("record").cast("bigint").alias("record"))


@query
def latin1_scan(spark, sf):
    rows = _sql(fixture.ACCENTED_SQL)(spark, sf)
    folder = scratch_path(spark, "latin1")
    rows.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(folder)
    records, _ = read_records(read_delimited(spark, list_inputs(spark, folder)))
    return records.select(F.col("id_raw").cast("bigint").alias("id_raw"), "descricao")


@query
def delimited_round_trip(spark, sf):
    columns = ("id_raw", "uf", "marca_modelo", "qtd_veiculos")
    folder = scratch_path(spark, "round-trip")
    write_delimited(stored_raw(spark, sf).select(*columns), folder)
    records, _ = read_records(read_delimited(spark, list_inputs(spark, folder)))
    return records.select(F.col("id_raw").cast("bigint").alias("id_raw"), *columns[1:])


@query
def quoted_cells_scan(spark, sf):
    """Make and model over two lines, the second quoted, in files that stay splittable."""
    text = F.replace("marca_modelo", F.lit("/"), F.lit('/\n"'))
    rows = stored_raw(spark, sf).select("id_raw", text.alias("marca_modelo"), "uf")
    folder = scratch_path(spark, "quoted")
    write_delimited(rows.repartitionByRange("id_raw").sortWithinPartitions("id_raw"), folder)
    records, _ = read_records(read_delimited(spark, list_inputs(spark, folder)))
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("id_raw", "record")]
    return records.select(*numbers, "marca_modelo", "uf")


# Make/model split

@query
def slash_count(spark, sf):
    return stored_raw(spark, sf).select("id_raw", mm.slash_count(F.col("marca_modelo")).alias("slashes"))


@query
def imported_flag(spark, sf):
    return stored_raw(spark, sf).select("id_raw", mm.import_prefixed(F.col("marca_modelo")).alias("importado"))


@query
def brand_first_segment(spark, sf):
    return _texts(spark, sf).select("id_raw", "segment")


@query
def model_strip(spark, sf):
    return _texts(spark, sf).select("id_raw", "rest")


@query
def brand_prefix_match(spark, sf):
    found = F.nullif(mm.dictionary_prefix(F.col("rest"), STARTER_BRANDS), F.lit(""))
    return _texts(spark, sf).select("id_raw", "rest", found.alias("brand"))


@query
def brand_prefix_join(spark, sf):
    texts = _texts(spark, sf).select("id_raw", "rest")
    # Settled: one row per distinct matching text, so the planner sees its size before joining back.
    matched = settle(match_by_join(texts, "rest", dictionary_table(spark)), "matched")
    return texts.join(matched, "rest", "left").select("id_raw", "rest", "brand")


@query
def brand_prefix_search(spark, sf):
    """A dictionary that grows with the tables: beginnings of 3 to 11 characters of the imported texts."""
    texts = _texts(spark, sf)
    imported = texts.where(mm.is_imported(F.col("marca_modelo"), F.col("segment")))
    size = (3 + F.col("id_raw") % 9).cast("int")
    names = settle(imported.select(F.substring(F.col("rest"), F.lit(1), size).alias("brand")).distinct(), "names")
    matched = settle(match_by_search(texts.select("rest"), "rest", names), "matched")
    return texts.join(matched, "rest", "left").select("id_raw", "rest", "brand")


@query
def imported_brand(spark, sf):
    rows = _split(spark, sf).where(mm.import_prefixed(F.col("marca_modelo")))
    return rows.select("id_raw", "marca_modelo", "marca", "modelo")


@query
def imp_override(spark, sf):
    rows = _split(spark, sf).where(F.col("importado") & ~mm.import_prefixed(F.col("marca_modelo")))
    return rows.select("id_raw", "marca_modelo", "marca", "modelo", "importado")


@query
def brand_alias(spark, sf):
    return apply_aliases(_split(spark, sf), alias_table(spark)).select("id_raw", "marca", "modelo", "importado")


@query
def handmade_flag(spark, sf):
    rows = _split(spark, sf)
    return rows.select("id_raw", "marca", mm.is_handmade(F.col("marca")).alias("artesanal"))


@query
def brand_dictionary(spark, sf):
    return dictionary_from_catalogue(_sql(fixture.CATALOGUE_SQL)(spark, sf))


# Normalisation

@query
def valid_brands_by_period(spark, sf):
    return valid_brands(parse_rows(stored_raw(spark, sf), STARTER_BRANDS, alias_table(spark)))


@query
def valid_brands_no_import(spark, sf):
    parsed = parse_rows(stored_raw(spark, sf), STARTER_BRANDS, alias_table(spark))
    return valid_brands(parsed, count_imported=False)


@query
def normalize_rows(spark, sf):
    return _norm(spark, sf)


@query
def normalize_by_dictionary_table(spark, sf):
    return normalize(stored_raw(spark, sf), dictionary_table(spark), alias_table(spark))


@query
def normalize_no_import_total(spark, sf):
    return normalize(stored_raw(spark, sf), STARTER_BRANDS, alias_table(spark), count_imported=False)


@query
def normalize_basic(spark, sf):
    rows = normalize(stored_raw(spark, sf), None, None, count_imported=False, drop_empty=False)
    return rows.drop("importado")


@query
def normalize_no_alias(spark, sf):
    return normalize(stored_raw(spark, sf), STARTER_BRANDS, None, drop_empty=False)


@query
def dropped_rows(spark, sf):
    raw = stored_raw(spark, sf).select("report_period", "id_raw", "marca_modelo")
    return quality.orphans(raw, _norm(spark, sf), ["report_period", "id_raw"])


# Hashes, dimension, fact

@query
def vehicle_hash3(spark, sf):
    return with_vehicle_hash(_norm(spark, sf).select("marca", "modelo", "ano_fabricacao").distinct())


@query
def vehicle_hash10(spark, sf):
    rows = with_catalogue_hash(_sql(fixture.WIDE_FIRST_SQL)(spark, sf))
    return rows.select("source_code", "year", "hash_veiculo")


@query
def distinct_vehicle_hashes(spark, sf):
    return distinct_hashes(_norm(spark, sf))


@query
def vehicle_dim_all(spark, sf):
    return vehicle_dim(_norm(spark, sf))


@query
def fleet_fact_cells(spark, sf):
    return fleet_cells(_norm(spark, sf))


@query
def fact_null_uf(spark, sf):
    norm = _norm(spark, sf)
    placed = F.col("uf").isNotNull()
    return norm.groupBy("report_period").agg(
        F.count(F.lit(1)).alias("norm_rows"),
        F.sum("frota").alias("norm_frota"),
        F.count_if(placed).alias("placed_rows"),
        F.sum(F.when(placed, F.col("frota"))).alias("fact_frota"),
    )


@query
def attach_vehicle_id(spark, sf):
    cells = attach_ids(fleet_cells(_norm(spark, sf)), scenario(spark, sf).warehouse.read(DIM))
    return cells.select("report_period", "hash_veiculo", "uf", F.col("id_veiculo").isNotNull().alias("has_id"))


@query
def vehicle_lookup(spark, sf):
    house = scenario(spark, sf).warehouse
    hashes = distinct_hashes(house.read(NORM))
    return lookup_ids(hashes, house.read(DIM)).select("hash_veiculo")


@query
def surrogate_keys(spark, sf):
    dim, rows = settle_counted(vehicle_dim(_norm(spark, sf)), "dim")
    keyed = dense_ids(dim, "hash_veiculo", "id_veiculo", start=100, buckets=bucket_count(rows))
    return keyed.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id_veiculo").alias("n_ids"),
        F.min("id_veiculo").alias("first_id"), F.max("id_veiculo").alias("last_id"),
    )


# Upserts and the stored layers

@query
def dim_upsert(spark, sf):
    return scenario(spark, sf).warehouse.read(DIM).select("hash_veiculo", *DIM_ATTRIBUTES)


@query
def fact_upsert(spark, sf):
    cells = settle(fleet_cells(_norm(spark, sf)), "cells")
    keys, values = ["hash_veiculo", "uf"], ["frota", "id_raw"]
    periods = [r.report_period for r in cells.select("report_period").distinct().orderBy("report_period").collect()]
    batches = [cells.where(F.col("report_period") == p).select(*keys, *values) for p in periods]
    return functools.reduce(lambda stored, batch: upsert(stored, batch, keys, values), batches)


@query
def wide_upsert(spark, sf):
    first = catalogue.wide_rows(_sql(fixture.WIDE_FIRST_SQL)(spark, sf))
    return catalogue.merge_wide(first, _sql(fixture.WIDE_SECOND_SQL)(spark, sf))


@query
def merge_guard(spark, sf):
    """Keys that the second wide batch repeats, as a merge would refuse them."""
    return repeated_keys(catalogue.wide_rows(_sql(fixture.WIDE_SECOND_SQL)(spark, sf)), [WIDE_KEY])


@query
def change_log(spark, sf):
    house = scenario(spark, sf).warehouse
    return change_payload(changes(house.previous_dim(), house.read(DIM), "hash_veiculo", DIM_ATTRIBUTES))


@query
def change_history(spark, sf):
    rows = scenario(spark, sf).warehouse.history()
    return rows.select(
        "report_period", "hash_veiculo", "marca", "modelo", "ano_fabricacao", "action", "column_name", "old_value",
        "new_value",
    )


@query
def history_view(spark, sf):
    """The change history as SQL readers see it, up to the published dimension."""
    site = scenario(spark, sf)
    return spark.table(f"{site.warehouse.prefix}analytics.vw_historico_alteracoes").select(
        "report_period", "marca", "modelo", "ano_fabricacao", "action", "column_name", "old_value", "new_value"
    )


@query
def stage_counts(spark, sf):
    """Counts of every load, as the job stored them."""
    return scenario(spark, sf).warehouse.read(LOAD_LOG).select("report_period", "stage", "n")


def _by_hash(pair: tuple[DataFrame, DataFrame]) -> DataFrame:
    dim, fact = pair
    return reports.star(fact, dim.select("id_veiculo", "hash_veiculo")).select(
        "report_period", "hash_veiculo", "uf", "frota"
    )


@query
def core_fact(spark, sf):
    house = scenario(spark, sf).warehouse
    return _by_hash((house.read(DIM), house.read(FACT)))


@query
def published_fact(spark, sf):
    return _by_hash(scenario(spark, sf).publication.tables())


@query
def rolled_back_fact(spark, sf):
    return _by_hash(scenario(spark, sf).publication.tables("previous"))


# Reporting

def _report(spark, sf, *keys):
    dim, fact = scenario(spark, sf).publication.tables()
    return reports.fleet_by(fact, dim, keys)


@query
def fleet_star_join(spark, sf):
    found = scenario(spark, sf)
    dim, fact = found.publication.tables()
    rows = reports.star(fact, dim, period=found.last_period)
    return rows.groupBy("marca", "uf").agg(F.sum("frota").alias("frota"), F.count(F.lit(1)).alias("vehicles"))


@query
def brand_state_latest(spark, sf):
    """Fleet by brand and state for the latest period, straight from the raw layer."""
    raw = stored_raw(spark, sf)
    latest = reports.latest_period(raw).first().report_period
    norm = normalize(raw.where(F.col("report_period") == latest), STARTER_BRANDS, alias_table(spark))
    named = fleet_cells(norm).join(vehicle_dim(norm).select("hash_veiculo", "marca"), "hash_veiculo")
    return named.groupBy("marca", "uf").agg(F.sum("frota").alias("frota"))


@query
def fleet_by_state(spark, sf):
    return _report(spark, sf, "uf")


@query
def fleet_by_brand(spark, sf):
    return _report(spark, sf, "marca")


@query
def fleet_by_year(spark, sf):
    return _report(spark, sf, "ano_fabricacao")


@query
def fleet_by_brand_model(spark, sf):
    return _report(spark, sf, "marca", "modelo")


@query
def fleet_by_vehicle(spark, sf):
    return _report(spark, sf, "hash_veiculo")


@query
def fleet_by_period(spark, sf):
    return _report(spark, sf, "report_period")


@query
def fleet_by_brand_state_period(spark, sf):
    return _report(spark, sf, "report_period", "uf", "marca")


@query
def current_vehicles(spark, sf):
    dim, _ = scenario(spark, sf).publication.tables()
    return dim.select("hash_veiculo", *DIM_ATTRIBUTES)


@query
def fleet_by_imported(spark, sf):
    return reports.fleet_by_imported(_norm(spark, sf))


@query
def latest_period(spark, sf):
    return reports.latest_period(stored_raw(spark, sf))


@query
def rollup_to_state(spark, sf):
    return reports.roll_up_to_state(_sql(fixture.MUNICIPAL_SQL)(spark, sf))


# Quality

@query
def orphan_facts(spark, sf):
    publication = scenario(spark, sf).publication
    dim, fact = publication.tables()
    older_dim, _ = publication.tables("previous")
    missing = quality.orphans(fact, older_dim, ["id_veiculo"])
    return _by_hash((dim, missing))


@query
def orphan_norm(spark, sf):
    house = scenario(spark, sf).warehouse
    missing = quality.orphans(house.read(NORM), house.read(RAW), ["report_period", "id_raw"])
    return missing.agg(F.count(F.lit(1)).alias("orphans"))


@query
def dq_raw(spark, sf):
    return quality.raw_report(stored_raw(spark, sf))


@query
def dq_norm(spark, sf):
    return quality.norm_report(with_vehicle_hash(_stored_norm(spark, sf)))


@query
def dq_integrity(spark, sf):
    house = scenario(spark, sf).warehouse
    return quality.integrity_report(house.read(DIM), house.read(FACT))


@query
def hash_collision_check(spark, sf):
    """Vehicle texts joined with the hash separator, so that some different vehicles share a hash."""
    rows = fixture.run_sql(spark, sf, fixture.PIPED_SQL)
    return quality.hash_collisions(with_vehicle_hash(rows), ["marca", "modelo", "ano_fabricacao"])


@query
def dq_profile(spark, sf):
    return quality.profile(stored_raw(spark, sf))


@query
def dq_reconcile(spark, sf):
    house = scenario(spark, sf).warehouse
    staged = with_vehicle_hash(house.read(NORM).select("marca", "modelo", "ano_fabricacao").distinct())
    return quality.reconcile(staged, house.read(DIM))


@query
def value_profile(spark, sf):
    return quality.value_profile(stored_raw(spark, sf), "marca_modelo")


@query
def uniqueness_profile(spark, sf):
    return quality.uniqueness_profile(
        _norm(spark, sf), ["marca", "modelo", "ano_fabricacao", "descricao_detran"]
    )


# Catalogue

@query
def text_normalize(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    return documents.select("doc_id", normalize_text(F.col("text")).alias("text"))


@query
def fuel_dictionary(spark, sf):
    rows = _sql(fixture.CATALOGUE_SQL)(spark, sf)
    return catalogue.fuel(rows, "combustivel", "fuel").select("id_raw", "combustivel", "fuel")


@query
def transmission_dictionary(spark, sf):
    rows = _sql(fixture.CATALOGUE_SQL)(spark, sf)
    found = catalogue.transmission(rows, "tipo_transmissao", "transmission")
    return found.select("id_raw", "tipo_transmissao", "transmission")


@query
def aspiration_text(spark, sf):
    rows = _sql(fixture.CATALOGUE_SQL)(spark, sf)
    return rows.select("id_raw", catalogue.aspiration(F.col("aspiracao")).alias("aspiration"))


@query
def decimal_comma_values(spark, sf):
    rows = _sql(fixture.CATALOGUE_SQL)(spark, sf)
    return rows.select("id_raw", decimal_comma(F.col("cilindrada_litros")).alias("litres"))


@query
def year_range_rules(spark, sf):
    rows = catalogue.normalize_catalogue(_sql(fixture.CATALOGUE_SQL)(spark, sf))
    checked = catalogue.year_range_rules(rows, "ano_inicio", "ano_fim", ("marca", "modelo"))
    return checked.select(
        "id_raw", "ano_inicio", "ano_fim", "range_ordered", "start_plausible", "fields_present"
    )


@query
def catalogue_rows(spark, sf):
    rows = catalogue.normalize_catalogue(_sql(fixture.CATALOGUE_SQL)(spark, sf))
    return rows.select(
        "id_raw", "marca_norm", "modelo_norm", "versao_norm", "motor_norm", "combustivel_norm",
        "transmissao_norm", "aspiracao_norm", "cilindrada", "cilindros", "potencia", "ano_inicio", "ano_fim",
    )
