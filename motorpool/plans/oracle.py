"""DuckDB SQL for every registered query, written from the rules and not from the Spark plans."""

from __future__ import annotations

from motorpool.dictionaries import BRAND_ALIASES, FUELS, NA_TOKENS, STARTER_BRANDS, TRANSMISSIONS, values_clause
from motorpool.functions.text import WHITESPACE
from motorpool.plans import fixture
from motorpool.schemas import WIDE_ATTRIBUTES

_BLANKS = "'" + WHITESPACE + "'"
_NUMBER = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"


def _number(column: str) -> str:
    value = f"CASE WHEN regexp_full_match({column}, '{_NUMBER}') THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    return f"CASE WHEN isfinite({value}) THEN {value} END"


def _whole(column: str) -> str:
    return f"CAST(trunc({_number(column)}) AS INTEGER)"


def _plain(column: str, punctuation: bool = True) -> str:
    marks = ".,;" if punctuation else ""
    shouted = f"upper(strip_accents(replace({column}, 'ß', 'SS')))"
    return f"trim(regexp_replace({shouted}, '[\\s\\x1c-\\x1f\\x{{85}}\\p{{Z}}{marks}]+', ' ', 'g'))"


def _hash(*parts: str) -> str:
    texts = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"sha256({texts})"


_H3 = _hash("marca", "modelo", "ano_fabricacao")
_H10 = _hash(
    "brand_norm", "model_norm", "version_norm", "fuel_norm", "transmission_norm",
    "aspiration_norm", "engine_config_norm", "engine_name_norm", "source_code", "year",
)


def _longest(text: str) -> str:
    return f"(SELECT arg_max(b.brand, length(b.brand)) FROM brands b WHERE starts_with({text}, b.brand))"


_BASE = f"""
WITH vehicle_raw AS ({fixture.RAW_SQL}),
brands(brand) AS (VALUES {values_clause([(b,) for b in STARTER_BRANDS])}),
aliases(alias, canonical) AS (VALUES {values_clause(BRAND_ALIASES)}),
texts AS (
  SELECT *, contains(marca_modelo, '/') AS slashed, coalesce(starts_with(marca_modelo, 'I/'), false) AS prefixed,
         regexp_replace(marca_modelo, '^I/', '') AS body
  FROM vehicle_raw),
segments AS (
  SELECT *, CASE WHEN slashed THEN split_part(body, '/', 1) END AS segment,
         regexp_replace(body, '^[^/]+/', '') AS rest
  FROM texts),
matches AS (SELECT rest AS m_rest, {_longest('rest')} AS hit FROM (SELECT DISTINCT rest FROM segments) d),
typed AS (
  SELECT s.*, m.hit, {_whole('ano_fabricacao_veiculo_crv')} AS ano, {_whole('qtd_veiculos')} AS qtd,
         prefixed OR coalesce(segment = 'IMP', false) AS importado
  FROM segments s LEFT JOIN matches m ON s.rest = m.m_rest),
split AS (
  SELECT *, CASE WHEN importado THEN hit ELSE segment END AS marca0,
         CASE WHEN importado AND hit IS NOT NULL THEN ltrim(substr(rest, length(hit) + 1), {_BLANKS})
              ELSE rest END AS modelo
  FROM typed WHERE ano IS NOT NULL AND qtd IS NOT NULL),
parsed AS (
  SELECT s.*, coalesce(a.canonical, s.marca0) AS marca
  FROM split s LEFT JOIN aliases a ON s.marca0 = a.alias),
valid AS (
  SELECT report_period, marca, CAST(sum(qtd) AS BIGINT) AS frota FROM parsed
  WHERE marca IS NOT NULL AND NOT starts_with(marca, 'A.') GROUP BY ALL HAVING sum(qtd) > 10),
valid_domestic AS (
  SELECT report_period, marca, CAST(sum(qtd) AS BIGINT) AS frota FROM parsed
  WHERE marca IS NOT NULL AND NOT starts_with(marca, 'A.') AND NOT importado GROUP BY ALL HAVING sum(qtd) > 10),
norm AS (
  SELECT report_period, id_raw, uf, marca, modelo, ano AS ano_fabricacao, qtd AS frota,
         marca_modelo AS descricao_detran, importado, {_hash('marca', 'modelo', 'ano')} AS hash_veiculo
  FROM parsed p SEMI JOIN valid v USING (report_period, marca) WHERE marca <> '' AND modelo <> ''),
dim AS (
  SELECT * EXCLUDE (report_period, id_raw, uf, frota, importado) FROM norm
  QUALIFY row_number() OVER (PARTITION BY hash_veiculo ORDER BY report_period DESC, id_raw) = 1),
cells AS (
  SELECT report_period, hash_veiculo, uf, CAST(sum(frota) AS BIGINT) AS frota, max(id_raw) AS id_raw
  FROM norm WHERE uf IS NOT NULL GROUP BY ALL),
star AS (SELECT c.*, d.marca, d.modelo, d.ano_fabricacao FROM cells c JOIN dim d USING (hash_veiculo)),
catalogue AS ({fixture.CATALOGUE_SQL}),
fuels(entry, meaning) AS (VALUES {values_clause(FUELS)}),
gears(entry, meaning) AS (VALUES {values_clause(TRANSMISSIONS)}),
catalogue_norm AS (
  SELECT c.*, {_plain('marca')} AS marca_norm, {_plain('modelo_veiculo')} AS modelo_norm,
         {_plain('nome_veiculo')} AS versao_norm, {_plain('nome_motor')} AS motor_norm,
         CASE WHEN f.entry IS NOT NULL THEN f.meaning ELSE {_plain('combustivel')} END AS fuel,
         CASE WHEN g.entry IS NOT NULL THEN g.meaning ELSE {_plain("split_part(tipo_transmissao, ';', 1)")} END
           AS transmission,
         nullif({_plain('aspiracao')}, '-') AS aspiration,
         CASE WHEN regexp_full_match(replace(trim(split_part(cilindrada_litros, ';', 1)), ',', '.'), '[+-]?\\d+(\\.\\d+)?')
              THEN TRY_CAST(replace(trim(split_part(cilindrada_litros, ';', 1)), ',', '.') AS DECIMAL(5,2)) END AS litres,
         {_whole('numero_cilindros')} AS cilindros,
         {_whole("replace(split_part(potencia_cv, ';', 1), ',', '.')")} AS potencia,
         {_whole('data_inicio')} AS ano_inicio, {_whole('data_final')} AS ano_fim
  FROM catalogue c
  LEFT JOIN fuels f ON {_plain('combustivel')} = f.entry
  LEFT JOIN gears g ON {_plain("split_part(tipo_transmissao, ';', 1)")} = g.entry)
"""

_NORM_COLUMNS = "report_period, id_raw, uf, marca, modelo, ano_fabricacao, frota, descricao_detran, importado"
_DIM_COLUMNS = "hash_veiculo, marca, modelo, ano_fabricacao, descricao_detran"
_FACT_COLUMNS = "report_period, hash_veiculo, uf, CAST(frota AS INTEGER) AS frota"
_RAW_CELLS = "uf, marca_modelo, ano_fabricacao_veiculo_crv, qtd_veiculos"


def _by(*keys: str) -> str:
    names = ", ".join(keys)
    return f"SELECT {names}, CAST(sum(frota) AS BIGINT) AS frota FROM star GROUP BY {names}"


def _counts(source: str, **checks: str) -> str:
    rows = [f"SELECT 'rows' AS check_name, count(*) AS n FROM {source}"]
    rows += [f"SELECT '{name}', count(*) FROM {source} WHERE {test}" for name, test in checks.items()]
    return " UNION ALL ".join(rows)


def _surplus(name: str, source: str, keys: str) -> str:
    return f"SELECT '{name}' AS check_name, (SELECT count(*) FROM {source}) - " \
           f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {source}) d) AS n"


def _wide_batch(text: str) -> str:
    def kept(c: str) -> str:
        return c if c in ("year", "excel_row") else f"CASE WHEN trim({c}) <> '' THEN {c} END AS {c}"

    return f"SELECT {_H10} AS hash_veiculo, {', '.join(map(kept, WIDE_ATTRIBUTES))} FROM ({text}) b"


_BASIC = f"""
basic AS (SELECT *, segment AS marca FROM segments),
basic_typed AS (
  SELECT *, {_whole('ano_fabricacao_veiculo_crv')} AS ano, {_whole('qtd_veiculos')} AS qtd FROM basic),
basic_kept AS (SELECT * FROM basic_typed WHERE ano IS NOT NULL AND qtd IS NOT NULL),
basic_valid AS (
  SELECT report_period, marca FROM basic_kept
  WHERE marca IS NOT NULL AND NOT starts_with(marca, 'A.') AND NOT prefixed
  GROUP BY ALL HAVING sum(qtd) > 10)
"""
_NO_ALIAS = """
raw_brand_valid AS (
  SELECT report_period, marca0 FROM split
  WHERE marca0 IS NOT NULL AND NOT starts_with(marca0, 'A.') GROUP BY ALL HAVING sum(qtd) > 10)
"""

_CHANGES = """
old_dim AS (
  SELECT * FROM norm WHERE report_period < (SELECT max(report_period) FROM vehicle_raw)
  QUALIFY row_number() OVER (PARTITION BY hash_veiculo ORDER BY report_period DESC, id_raw) = 1),
compared AS (
  SELECT n.hash_veiculo, o.hash_veiculo IS NULL AS fresh, u.column_name, u.old_value, u.new_value
  FROM dim n LEFT JOIN old_dim o USING (hash_veiculo),
  LATERAL (VALUES ('marca', o.marca, n.marca), ('modelo', o.modelo, n.modelo),
                  ('ano_fabricacao', CAST(o.ano_fabricacao AS VARCHAR), CAST(n.ano_fabricacao AS VARCHAR)),
                  ('descricao_detran', o.descricao_detran, n.descricao_detran)) u(column_name, old_value, new_value)
  WHERE u.old_value IS DISTINCT FROM u.new_value)
"""

_HISTORY = """
loads AS (
  SELECT * FROM norm QUALIFY row_number() OVER (PARTITION BY hash_veiculo, report_period ORDER BY id_raw) = 1),
steps AS (
  SELECT *, lag(descricao_detran) OVER (PARTITION BY hash_veiculo ORDER BY report_period) AS before,
         row_number() OVER (PARTITION BY hash_veiculo ORDER BY report_period) = 1 AS fresh
  FROM loads)
"""

_STAGES = """
first_seen AS (SELECT hash_veiculo, min(report_period) AS first_period FROM norm GROUP BY ALL),
seen AS (SELECT DISTINCT report_period, hash_veiculo, first_period FROM norm JOIN first_seen USING (hash_veiculo))
"""


def _base(body: str, extra: str = "") -> str:
    return _BASE + (", " + extra.strip() if extra else "") + "\n" + body


def _sources() -> dict[str, str]:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return {
        "raw_period_scan": _base(f"SELECT id_raw, {_RAW_CELLS} FROM vehicle_raw WHERE report_period = 202506"),
        "norm_period_scan": _base(
            "SELECT uf, marca, modelo, ano_fabricacao, frota, descricao_detran, importado "
            "FROM norm WHERE report_period = 202506"
        ),
        "raw_layer_load": _base(f"SELECT report_period, {_RAW_CELLS} FROM vehicle_raw"),
        "row_preview": _base("SELECT id_raw, report_period, uf FROM vehicle_raw ORDER BY id_raw LIMIT 5"),
        "valid_period_filter": f"""SELECT * FROM ({fixture.PERIOD_TEXT_SQL}) p
            WHERE length(trim(period_text)) = 6 AND TRY_CAST(trim(period_text) AS INTEGER) % 100 BETWEEN 1 AND 12""",
        "clean_cells": f"""SELECT id_raw, nullif(trim(cell, {_BLANKS}), '') AS cell,
            CASE WHEN trim(cell, {_BLANKS}) <> '' THEN cell END AS kept FROM ({fixture.DIRTY_CELL_SQL}) c""",
        "missing_tokens": f"""SELECT id_raw, CASE WHEN cell IN ({tokens}) THEN NULL ELSE cell END AS cell
            FROM ({fixture.TOKEN_SQL}) c""",
        "numeric_coercion": f"SELECT id_raw, {_whole('cell')} AS value FROM ({fixture.NUMBER_TEXT_SQL}) c",
        "file_order_ordinal": "SELECT o_orderkey, o_orderpriority, "
                              "row_number() OVER (ORDER BY o_orderkey) - 1 AS record FROM orders",
        "latin1_scan": fixture.ACCENTED_SQL,
        "delimited_round_trip": _base("SELECT id_raw, uf, marca_modelo, qtd_veiculos FROM vehicle_raw"),
        "quoted_cells_scan": _base(
            """SELECT id_raw, row_number() OVER (ORDER BY id_raw) - 1 AS record, uf,
               replace(marca_modelo, '/', '/' || chr(10) || '"') AS marca_modelo FROM vehicle_raw"""
        ),
    }


def _split() -> dict[str, str]:
    return {
        "slash_count": _base(
            "SELECT id_raw, CAST(length(regexp_replace(marca_modelo, '[^/]', '', 'g')) AS INTEGER) AS slashes "
            "FROM vehicle_raw"
        ),
        "imported_flag": _base("SELECT id_raw, prefixed AS importado FROM texts"),
        "brand_first_segment": _base("SELECT id_raw, segment FROM segments"),
        "model_strip": _base("SELECT id_raw, rest FROM segments"),
        "brand_prefix_match": _base("SELECT id_raw, rest, hit AS brand FROM typed"),
        "brand_prefix_join": _base("SELECT id_raw, rest, hit AS brand FROM typed"),
        "brand_prefix_search": _base(
            """SELECT t.id_raw, t.rest, b.brand FROM typed t LEFT JOIN best b ON t.rest = b.rest""",
            """
names AS (SELECT DISTINCT substr(rest, 1, CAST(3 + id_raw % 9 AS INT)) AS brand FROM typed WHERE importado AND rest <> ''),
best AS (SELECT d.rest, arg_max(n.brand, length(n.brand)) AS brand
         FROM (SELECT DISTINCT rest, unnest(range(1, 12)) AS size FROM typed) d
         JOIN names n ON substr(d.rest, 1, d.size) = n.brand GROUP BY d.rest)""",
        ),
        "imported_brand": _base("SELECT id_raw, marca_modelo, marca0 AS marca, modelo FROM split WHERE prefixed"),
        "imp_override": _base(
            "SELECT id_raw, marca_modelo, marca0 AS marca, modelo, importado FROM split WHERE importado AND NOT prefixed"
        ),
        "brand_alias": _base("SELECT id_raw, marca, modelo, importado FROM parsed"),
        "handmade_flag": _base(
            "SELECT id_raw, marca0 AS marca, coalesce(starts_with(marca0, 'A.'), false) AS artesanal FROM split"
        ),
        "brand_dictionary": _base(f"SELECT DISTINCT {_plain('marca', punctuation=False)} AS brand FROM catalogue"),
        "valid_brands_by_period": _base("SELECT report_period, marca, frota FROM valid"),
        "valid_brands_no_import": _base("SELECT report_period, marca, frota FROM valid_domestic"),
        "normalize_rows": _base(f"SELECT {_NORM_COLUMNS} FROM norm"),
        "normalize_by_dictionary_table": _base(f"SELECT {_NORM_COLUMNS} FROM norm"),
        "normalize_no_import_total": _base(
            """SELECT report_period, id_raw, uf, marca, modelo, ano AS ano_fabricacao, qtd AS frota,
               marca_modelo AS descricao_detran, importado FROM parsed SEMI JOIN valid_domestic USING (report_period, marca)
               WHERE marca <> '' AND modelo <> ''"""
        ),
        "normalize_basic": _base(
            """SELECT report_period, id_raw, uf, marca, rest AS modelo, ano AS ano_fabricacao, qtd AS frota,
               marca_modelo AS descricao_detran FROM basic_kept SEMI JOIN basic_valid USING (report_period, marca)""",
            _BASIC,
        ),
        "normalize_no_alias": _base(
            """SELECT report_period, id_raw, uf, marca0 AS marca, modelo, ano AS ano_fabricacao, qtd AS frota,
               marca_modelo AS descricao_detran, importado
               FROM split SEMI JOIN raw_brand_valid USING (report_period, marca0)""",
            _NO_ALIAS,
        ),
        "dropped_rows": _base(
            "SELECT report_period, id_raw, marca_modelo FROM vehicle_raw WHERE id_raw NOT IN (SELECT id_raw FROM norm)"
        ),
    }


def _model() -> dict[str, str]:
    wide = f"first_batch AS ({_wide_batch(fixture.WIDE_FIRST_SQL)}), second_batch AS ({_wide_batch(fixture.WIDE_SECOND_SQL)})"
    latest_norm = "(SELECT hash_veiculo FROM norm)"
    return {
        "vehicle_hash3": _base("SELECT DISTINCT marca, modelo, ano_fabricacao, hash_veiculo FROM norm"),
        "vehicle_hash10": f"SELECT source_code, year, {_H10} AS hash_veiculo FROM ({fixture.WIDE_FIRST_SQL}) w",
        "distinct_vehicle_hashes": _base("SELECT DISTINCT hash_veiculo FROM norm"),
        "vehicle_dim_all": _base(f"SELECT {_DIM_COLUMNS} FROM dim"),
        "fleet_fact_cells": _base("SELECT * FROM cells"),
        "fact_null_uf": _base(
            """SELECT report_period, count(*) AS norm_rows, CAST(sum(frota) AS BIGINT) AS norm_frota,
               count(uf) AS placed_rows, CAST(sum(frota) FILTER (uf IS NOT NULL) AS BIGINT) AS fact_frota
               FROM norm GROUP BY report_period"""
        ),
        "attach_vehicle_id": _base("SELECT report_period, hash_veiculo, uf, true AS has_id FROM cells"),
        "vehicle_lookup": _base(f"SELECT hash_veiculo FROM dim WHERE hash_veiculo IN {latest_norm}"),
        "surrogate_keys": _base(
            """SELECT count(*) AS n, count(*) AS n_ids, CAST(101 AS BIGINT) AS first_id, count(*) + 100 AS last_id
               FROM (SELECT DISTINCT marca, modelo, ano_fabricacao FROM norm) d"""
        ),
        "dim_upsert": _base(f"SELECT {_DIM_COLUMNS} FROM dim"),
        "fact_upsert": _base(
            """SELECT hash_veiculo, uf, frota, id_raw FROM cells
               QUALIFY row_number() OVER (PARTITION BY hash_veiculo, uf ORDER BY report_period DESC) = 1"""
        ),
        "wide_upsert": f"""WITH {wide} SELECT * FROM second_batch
            QUALIFY row_number() OVER (PARTITION BY hash_veiculo ORDER BY excel_row) = 1 UNION ALL
            SELECT * FROM first_batch WHERE hash_veiculo NOT IN (SELECT hash_veiculo FROM second_batch)""",
        "merge_guard": f"""WITH {wide} SELECT hash_veiculo, count(*) AS n FROM second_batch
            GROUP BY hash_veiculo HAVING count(*) > 1""",
        "change_log": _base(
            """SELECT hash_veiculo, CASE WHEN fresh THEN 'INSERT' ELSE 'UPDATE' END AS action, column_name,
               old_value, new_value,
               CAST(json_object('old_value', old_value, 'new_value', new_value) AS VARCHAR) AS payload
               FROM compared""",
            _CHANGES,
        ),
        "change_history": _base(
            """SELECT report_period, hash_veiculo, marca, modelo, ano_fabricacao,
               CASE WHEN fresh THEN 'INSERT' ELSE 'UPDATE' END AS action, u.column_name, u.old_value, u.new_value
               FROM steps, LATERAL (VALUES
                 ('marca', NULL, CASE WHEN fresh THEN marca END),
                 ('modelo', NULL, CASE WHEN fresh THEN modelo END),
                 ('ano_fabricacao', NULL, CASE WHEN fresh THEN CAST(ano_fabricacao AS VARCHAR) END),
                 ('descricao_detran', before, descricao_detran)) u(column_name, old_value, new_value)
               WHERE u.old_value IS DISTINCT FROM u.new_value""",
            _HISTORY,
        ),
        "history_view": _base(
            """SELECT report_period, marca, modelo, ano_fabricacao,
               CASE WHEN fresh THEN 'INSERT' ELSE 'UPDATE' END AS action, u.column_name, u.old_value, u.new_value
               FROM steps, LATERAL (VALUES
                 ('marca', NULL, CASE WHEN fresh THEN marca END),
                 ('modelo', NULL, CASE WHEN fresh THEN modelo END),
                 ('ano_fabricacao', NULL, CASE WHEN fresh THEN CAST(ano_fabricacao AS VARCHAR) END),
                 ('descricao_detran', before, descricao_detran)) u(column_name, old_value, new_value)
               WHERE u.old_value IS DISTINCT FROM u.new_value""",
            _HISTORY,
        ),
        "stage_counts": _base(
            """SELECT report_period, 'raw' AS stage, count(*) AS n FROM vehicle_raw GROUP BY report_period
               UNION ALL SELECT report_period, 'norm', count(*) FROM norm GROUP BY report_period
               UNION ALL SELECT report_period, 'vehicles_inserted', count(*) FILTER (report_period = first_period)
                         FROM seen GROUP BY report_period
               UNION ALL SELECT report_period, 'vehicles_updated', count(*) FILTER (report_period > first_period)
                         FROM seen GROUP BY report_period
               UNION ALL SELECT report_period, 'facts', count(*) FROM cells GROUP BY report_period""",
            _STAGES,
        ),
        "core_fact": _base(f"SELECT {_FACT_COLUMNS} FROM cells"),
        "published_fact": _base(f"SELECT {_FACT_COLUMNS} FROM cells"),
        "rolled_back_fact": _base(
            f"""SELECT {_FACT_COLUMNS} FROM cells
               WHERE report_period < (SELECT max(report_period) FROM vehicle_raw)"""
        ),
    }


def _reports() -> dict[str, str]:
    return {
        "fleet_star_join": _base(
            """SELECT marca, uf, CAST(sum(frota) AS BIGINT) AS frota, count(*) AS vehicles FROM star
               WHERE report_period = (SELECT max(report_period) FROM vehicle_raw) GROUP BY marca, uf"""
        ),
        "brand_state_latest": _base(
            """SELECT marca, uf, CAST(sum(frota) AS BIGINT) AS frota FROM norm
               WHERE uf IS NOT NULL AND report_period = (SELECT max(report_period) FROM vehicle_raw) GROUP BY marca, uf"""
        ),
        "fleet_by_state": _base(_by("uf")),
        "fleet_by_brand": _base(_by("marca")),
        "fleet_by_year": _base(_by("ano_fabricacao")),
        "fleet_by_brand_model": _base(_by("marca", "modelo")),
        "fleet_by_vehicle": _base(_by("hash_veiculo")),
        "fleet_by_period": _base(_by("report_period")),
        "fleet_by_brand_state_period": _base(_by("report_period", "uf", "marca")),
        "current_vehicles": _base(f"SELECT {_DIM_COLUMNS} FROM dim"),
        "fleet_by_imported": _base("SELECT importado, CAST(sum(frota) AS BIGINT) AS frota FROM norm GROUP BY importado"),
        "latest_period": _base("SELECT max(report_period) AS report_period FROM vehicle_raw"),
        "rollup_to_state": f"""SELECT uf, marca_modelo, ano_fabricacao_veiculo_crv,
            CAST(sum(CAST(qtd_veiculos AS BIGINT)) AS BIGINT) AS qtd_veiculos FROM ({fixture.MUNICIPAL_SQL}) m
            WHERE uf IS NOT NULL AND marca_modelo IS NOT NULL AND ano_fabricacao_veiculo_crv IS NOT NULL
            GROUP BY uf, marca_modelo, ano_fabricacao_veiculo_crv""",
    }


def _quality() -> dict[str, str]:
    unread = {
        "bad_ano": f"ano_fabricacao_veiculo_crv IS NOT NULL AND {_number('ano_fabricacao_veiculo_crv')} IS NULL",
        "bad_qtd": f"qtd_veiculos IS NOT NULL AND {_number('qtd_veiculos')} IS NULL",
    }
    missing = {f"null_{c}": f"{c} IS NULL" for c in _RAW_CELLS.split(", ")}
    reconciled = """
staged AS (SELECT DISTINCT hash_veiculo FROM norm),
sides AS (SELECT s.hash_veiculo IS NOT NULL AS l, d.hash_veiculo IS NOT NULL AS r
          FROM staged s FULL JOIN dim d ON s.hash_veiculo = d.hash_veiculo)"""
    profile_columns = ("id_raw", "uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos", "report_period")
    profile = " UNION ALL ".join(
        f"SELECT count(*) AS records, '{c}' AS column_name, count(*) - count({c}) AS nulls, "
        f"count({c}) * 10000 // count(*) AS completeness_bp FROM vehicle_raw"
        for c in profile_columns
    )
    return {
        "orphan_facts": _base(
            f"""SELECT {_FACT_COLUMNS} FROM cells WHERE hash_veiculo NOT IN
               (SELECT hash_veiculo FROM norm WHERE report_period < (SELECT max(report_period) FROM vehicle_raw))"""
        ),
        "orphan_norm": _base(
            "SELECT count(*) AS orphans FROM norm WHERE id_raw NOT IN (SELECT id_raw FROM vehicle_raw)"
        ),
        "dq_raw": _base(
            _counts("vehicle_raw", **missing, **unread) + " UNION ALL "
            + _surplus("duplicate_rows", "vehicle_raw", f"report_period, {_RAW_CELLS}")
        ),
        "dq_norm": _base(
            _counts(
                "norm", null_hash="hash_veiculo IS NULL", blank_marca="coalesce(trim(marca), '') = ''",
                blank_modelo="coalesce(trim(modelo), '') = ''", null_uf="uf IS NULL",
            ) + " UNION ALL " + _surplus("shared_cell_rows", "norm", "report_period, hash_veiculo, uf")
        ),
        "dq_integrity": _base(
            """SELECT 'orphan_facts' AS check_name, count(*) AS n FROM cells WHERE hash_veiculo NOT IN (SELECT hash_veiculo FROM dim)
               UNION ALL SELECT 'vehicles_without_fact', count(*) FROM dim WHERE hash_veiculo NOT IN (SELECT hash_veiculo FROM cells)
               UNION ALL SELECT 'vehicles', count(*) FROM dim
               UNION ALL SELECT 'null_hash', count(*) FROM dim WHERE hash_veiculo IS NULL UNION ALL """
            + _surplus("duplicate_hash", "dim", "hash_veiculo") + " UNION ALL "
            + _surplus("duplicate_cell", "cells", "report_period, hash_veiculo, uf")
        ),
        "hash_collision_check": f"""SELECT hash_veiculo, count(*) AS combinations FROM
            (SELECT DISTINCT {_H3} AS hash_veiculo, marca, modelo, ano_fabricacao FROM ({fixture.PIPED_SQL}) p) d
            GROUP BY hash_veiculo HAVING count(*) > 1""",
        "dq_profile": _base(profile),
        "dq_reconcile": _base(
            """SELECT 'staged' AS check_name, count(*) FILTER (l) AS n FROM sides
               UNION ALL SELECT 'stored', count(*) FILTER (r) FROM sides
               UNION ALL SELECT 'in_both', count(*) FILTER (l AND r) FROM sides
               UNION ALL SELECT 'only_staged', count(*) FILTER (l AND NOT r) FROM sides
               UNION ALL SELECT 'only_stored', count(*) FILTER (r AND NOT l) FROM sides""",
            reconciled,
        ),
        "value_profile": _base(
            """SELECT marca_modelo AS value, count(*) AS n,
               count(*) * 10000 // (SELECT count(*) FROM vehicle_raw) AS share_bp
               FROM vehicle_raw GROUP BY marca_modelo"""
        ),
        "uniqueness_profile": _base(
            """SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS distinct_rows,
               count(*) FILTER (n > 1) AS repeated_combinations,
               CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS repeated_records
               FROM (SELECT count(*) AS n FROM norm GROUP BY marca, modelo, ano_fabricacao, descricao_detran) g"""
        ),
    }


def _catalogue() -> dict[str, str]:
    return {
        "text_normalize": f"SELECT doc_id, {_plain('text')} AS text FROM documents",
        "fuel_dictionary": _base("SELECT id_raw, combustivel, fuel FROM catalogue_norm"),
        "transmission_dictionary": _base("SELECT id_raw, tipo_transmissao, transmission FROM catalogue_norm"),
        "aspiration_text": _base("SELECT id_raw, aspiration FROM catalogue_norm"),
        "decimal_comma_values": _base("SELECT id_raw, litres FROM catalogue_norm"),
        "year_range_rules": _base(
            """SELECT id_raw, ano_inicio, ano_fim,
               ano_inicio IS NULL OR ano_fim IS NULL OR ano_inicio <= ano_fim AS range_ordered,
               coalesce(ano_inicio >= 1900 AND ano_inicio <= 2100, false) AS start_plausible,
               marca IS NOT NULL AND modelo_veiculo IS NOT NULL AS fields_present FROM catalogue_norm"""
        ),
        "catalogue_rows": _base(
            """SELECT id_raw, marca_norm, modelo_norm, versao_norm, motor_norm, fuel AS combustivel_norm,
               transmission AS transmissao_norm, aspiration AS aspiracao_norm, litres AS cilindrada, cilindros,
               potencia, ano_inicio, ano_fim FROM catalogue_norm"""
        ),
    }


ORACLES: dict[str, str] = {**_sources(), **_split(), **_model(), **_reports(), **_quality(), **_catalogue()}
