"""Vehicle inputs derived from the driver tables by SQL that Spark and DuckDB both run as it is.

`raw`: orders with their customer and nation, joined to 23 make/model templates. `catalogue`: parts
joined to templates of catalogue spellings. Templates are joined tables and not CASE ladders, which
keeps the generated code small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motorpool.dictionaries import NA_TOKENS, values_clause

TABLES = ("orders", "customer", "nation", "part", "lineitem", "documents")

RAW_SQL = """
SELECT CASE o.o_orderkey % 3 WHEN 0 THEN 202501 WHEN 1 THEN 202506 ELSE 202601 END AS report_period,
       o.o_orderkey AS id_raw,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL ELSE n.n_name END AS uf,
       t.pre || CASE WHEN t.code THEN CAST(o.o_custkey % 400 AS STRING) || '/' ELSE '' END
             || CASE WHEN t.mdl THEN c.c_mktsegment || ' ' || CAST(o.o_custkey % 10 AS STRING) ELSE '' END
             || t.suf AS marca_modelo,
       CASE WHEN o.o_orderkey % 101 = 0 THEN 'SEM ANO'
            WHEN o.o_orderkey % 53 = 0 THEN CAST(year(o.o_orderdate) AS STRING) || '.0'
            ELSE CAST(year(o.o_orderdate) AS STRING) END AS ano_fabricacao_veiculo_crv,
       CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/d' WHEN o.o_orderkey % 89 = 0 THEN '1,234'
            WHEN o.o_orderkey % 83 = 0 THEN '1.934' WHEN o.o_orderkey % 79 = 0 THEN '1d'
            ELSE CAST(o.o_orderkey % 7 AS STRING) END AS qtd_veiculos
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (VALUES (0,'FORD/',false,true,''),(1,'FORD/KA/',false,true,''),(2,'VW/',false,true,''),
             (3,'VOLKS/',false,true,''),(4,'NO SLASH ',false,true,''),(5,'I/FORD ',false,true,''),
             (6,'I/FORD',false,false,''),(7,'I/VW ',false,true,''),(8,'I/M.BENZ/',false,true,''),
             (9,'I/FORD/BMW ',false,true,''),(10,'IMP/BMW ',false,true,''),
             (11,'IMP/M.BENZ ',false,true,''),(12,'I/MANGOSTEEN ',false,true,''),
             (13,'I/RAMPAGE ',false,true,''),(14,'I/FIAT ALLIS ',false,true,''),(15,'R/',false,true,''),
             (16,'/',false,true,''),(17,'FORD/',false,false,''),(18,'I/I/FORD ',false,true,''),
             (19,'A.',false,true,'/REB'),(20,'I/IMP/BMW ',false,true,''),(21,'RARE',true,true,''),
             (22,NULL,false,false,'')) AS t(k, pre, code, mdl, suf)
  ON o.o_orderkey % 23 = t.k
"""

# Spellings a catalogue file may hold, by column; every part takes one row by its key.
_FUEL_TEXTS = (
    "GASOLINA", "diesel", " Flex ", "ETANOL", "ELÉTRICO", "Gasolina/Elétrico", "DIESEL/ELETRICO",
    "flex/elétrico", "GAS  VEICULAR", "FLEX/GNV", "-", "GASOLINA; ETANOL", "Querosene",
)
_GEAR_TEXTS = (
    "MANUAL", "AUTOMÁTICA", "Automatizada; Manual", "cvt", "Mecânica", "SINCRONIZADA",
    "SEMI-AUTOMATIZADA", "-", "AUTOMATICA; MANUAL", "Dupla  Embreagem", "semiautomática",
)
_INTAKE_TEXTS = ("ASPIRADO", "turbo", "BITURBO", "-", " Compressor")
_LITRE_TEXTS = ("3,5", "1.6", "2", "-", "1,0; 1,4", "12,345", "1.234,5", "abc", "1000,0")
_RANGE_TEXTS = (
    (1990, 1995), (2001, None), (2010, 2010), (2015, 2012), (1899, 1950), (2101, None), (None, 2000),
)


def _numbered(values, columns: str) -> str:
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    text = values_clause(rows).replace("CAST(NULL AS STRING)", "NULL")
    return f"(VALUES {text}) AS {columns}"


CATALOGUE_SQL = f"""
SELECT p.p_partkey AS id_raw, p.p_brand AS marca, p.p_name AS modelo_veiculo,
       p.p_type AS nome_veiculo, 'M' || CAST(p.p_size AS STRING) AS nome_motor,
       g.v AS tipo_transmissao, f.v AS combustivel, a.v AS aspiracao, l.v AS cilindrada_litros,
       CAST(p.p_size % 12 AS STRING) AS numero_cilindros,
       CAST(p.p_size AS STRING) || ',5' AS potencia_cv,
       CAST(r.a AS STRING) AS data_inicio, CAST(r.b AS STRING) AS data_final,
       CAST(p.p_partkey % 1000 AS STRING) AS codigo_fipe
FROM part p
JOIN {_numbered(_FUEL_TEXTS, 'f(k, v)')} ON p.p_partkey % {len(_FUEL_TEXTS)} = f.k
JOIN {_numbered(_GEAR_TEXTS, 'g(k, v)')} ON p.p_partkey % {len(_GEAR_TEXTS)} = g.k
JOIN {_numbered(_INTAKE_TEXTS, 'a(k, v)')} ON p.p_partkey % {len(_INTAKE_TEXTS)} = a.k
JOIN {_numbered(_LITRE_TEXTS, 'l(k, v)')} ON p.p_partkey % {len(_LITRE_TEXTS)} = l.k
JOIN {_numbered(_RANGE_TEXTS, 'r(k, a, b)')} ON p.p_partkey % {len(_RANGE_TEXTS)} = r.k
"""


def _wide_sql(source: str, batch: str, power: str, engine: str, repeat: str = "0") -> str:
    """One batch of the wide catalogue: {batch} changes attributes, {engine} also changes some hashes."""
    return f"""
SELECT CAST(p.p_partkey AS STRING) AS source_code, p.p_brand AS brand, p.p_name AS model,
       p.p_type AS version, {engine} AS engine_name, 'INLINE' AS engine_config,
       {power} AS power_cv, 'Flex' AS fuel, 'Turbo' AS aspiration,
       'K' || CAST(p.p_partkey AS STRING) AS ktype_tecdoc, '{batch}' || CAST({repeat} AS STRING) AS classification,
       CASE WHEN p.p_size % 5 = 0 THEN ' ' ELSE 'CARRO' END AS vehicle_type, 'LEVE' AS vehicle_category,
       CAST(p.p_size % 4 AS STRING) AS generation, CAST(p.p_size % 7 AS STRING) AS displacement_liters,
       'OHC' AS command, CAST(p.p_size % 8 AS STRING) AS cylinder_count, 'Manual' AS transmission,
       'DUPLA' AS cabin_type, CAST(p.p_partkey % 1000 AS STRING) AS fipe_code,
       upper(p.p_brand) AS brand_norm, upper(p.p_name) AS model_norm, upper(p.p_type) AS version_norm,
       {engine} AS engine_name_norm, 'INLINE' AS engine_config_norm, 'FLEX' AS fuel_norm,
       'MANUAL' AS transmission_norm,
       CASE WHEN p.p_size % 3 = 0 THEN NULL ELSE 'TURBO' END AS aspiration_norm,
       CAST(1990 + p.p_size % 30 AS INT) AS year, '{batch}' AS load_timestamp,
       'catalogue_{batch}' AS source_file, CAST(p.p_partkey + 1000000 * {repeat} AS INT) AS excel_row
FROM {source}
"""


WIDE_FIRST_SQL = _wide_sql("part p", "first", "CAST(p.p_size AS STRING)", "'E' || CAST(p.p_size AS STRING)")
WIDE_SECOND_SQL = _wide_sql(
    """(SELECT l_partkey, max(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_partkey) s
JOIN part p ON s.l_partkey = p.p_partkey
JOIN (VALUES (0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0)) AS d(k, r) ON p.p_partkey % 5 = d.r""",
    "second",
    "CAST(CAST(s.q AS INT) AS STRING)",
    "CASE WHEN s.n % 2 = 0 THEN 'N' ELSE 'E' END || CAST(p.p_size AS STRING)",
    "d.k",
)

# Orders as municipality rows: the customer stands for the municipality, some keys are missing.
MUNICIPAL_SQL = f"""
SELECT r.uf, CAST(o.o_custkey AS STRING) AS municipio,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE r.marca_modelo END AS marca_modelo,
       r.ano_fabricacao_veiculo_crv, CAST(o.o_orderkey % 9 AS STRING) AS qtd_veiculos
FROM ({RAW_SQL}) r JOIN orders o ON r.id_raw = o.o_orderkey
"""


# Period texts of every order: well formed, month out of range, dashed, blank-edged, too long.
PERIOD_TEXT_SQL = """
SELECT o.o_orderkey AS id_raw,
       CASE o.o_orderkey % 6 WHEN 0 THEN CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS STRING)
            WHEN 1 THEN CAST(year(o.o_orderdate) * 100 + 13 AS STRING)
            WHEN 2 THEN CAST(year(o.o_orderdate) * 100 AS STRING)
            WHEN 3 THEN CAST(year(o.o_orderdate) AS STRING) || '-' || CAST(month(o.o_orderdate) AS STRING)
            WHEN 4 THEN ' ' || CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS STRING) || ' '
            ELSE CAST(year(o.o_orderdate) * 1000 + month(o.o_orderdate) AS STRING) END AS period_text
FROM orders o
"""

# Cells with blank, tab and no-break-space edges, blank only, and missing.
DIRTY_CELL_SQL = """
SELECT o.o_orderkey AS id_raw,
       CASE o.o_orderkey % 7 WHEN 0 THEN o.o_orderpriority WHEN 1 THEN '  ' || o.o_orderpriority
            WHEN 2 THEN chr(9) || o.o_orderpriority || chr(10) WHEN 3 THEN o.o_orderpriority || chr(160)
            WHEN 4 THEN chr(9) || ' ' || chr(160) WHEN 5 THEN '' ELSE NULL END AS cell
FROM orders o
"""


def _texts_by_order(texts) -> str:
    """Every order with one of the texts, followed by the order's own status where the text is NULL."""
    return f"""
SELECT o.o_orderkey AS id_raw, CASE WHEN t.v IS NULL THEN CAST(o.o_custkey AS STRING) ELSE t.v END AS cell
FROM orders o
JOIN {_numbered(texts, 't(k, v)')} ON o.o_orderkey % {len(texts)} = t.k
"""


NUMBER_TEXT_SQL = _texts_by_order((
    "12.7", "-3.9", "+5", " 12 ", "1e3", "1.234", "1,234", "1_000", "0x10", "True", "1d", "1f", "", "1e400",
    "inf", "Infinity", "nan", ".5", "5.", "1e", "--1", None, "1.5E+2", "2010.0", "-0.4",
))
TOKEN_SQL = _texts_by_order((*NA_TOKENS, " NA", "Null", "NONE", "0", None))
# Parts whose brand or model holds the hash separator; the separator's place differs by key.
PIPED_SQL = """
SELECT CASE WHEN p.p_partkey % 2 = 0 THEN p.p_brand || '|' || p.p_type ELSE p.p_brand END AS marca,
       CASE WHEN p.p_partkey % 2 = 0 THEN 'X' ELSE p.p_type || '|' || 'X' END AS modelo,
       p.p_size % 3 AS ano_fabricacao
FROM part p
"""
ACCENTED_SQL = """
SELECT o.o_orderkey AS id_raw, 'VEÍCULO AÇÃO ' || n.n_name || ' Nº ' || CAST(o.o_custkey AS STRING) AS descricao
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run fixture SQL with the driver tables bound by name, without touching the session's views."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t} " in f" {text} "}
    for name in tables:
        text = text.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(text, **tables)


def vehicle_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, RAW_SQL)
