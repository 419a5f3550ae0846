"""Scalar rules: text, numbers, periods, hashes."""

import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from motorpool.functions import hashing, numbers, text


def column(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, v string")


def apply(spark, values, expression):
    rows = column(spark, values).select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


NUMBERS = {
    "12.7": 12, "-3.9": -3, "+5": 5, " 12 ": 12, "1e3": 1000, "1.234": 1, "2010.0": 2010, ".5": 0, "5.": 5,
    "1,234": None, "1_000": None, "0x10": None, "True": None, "1d": None, "1f": None, "": None, "1e400": None,
    "inf": None, "Infinity": None, "nan": None, "1e": None, "--1": None, None: None, "0": 0, "-0.4": 0,
}


def test_numbers_truncate_toward_zero_and_reject_other_text(spark):
    assert apply(spark, list(NUMBERS), numbers.truncated_int) == list(NUMBERS.values())


def test_a_number_outside_int_stops_the_job(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        apply(spark, ["3e9"], numbers.truncated_int)


def test_decimal_comma(spark):
    values = ["3,5", "1.6", "2", "-", "1,0; 1,4", "12,345", "1.234,5", "abc", "1000,0", None, "-0,5"]
    got = [None if v is None else str(v) for v in apply(spark, values, numbers.decimal_comma)]
    assert got == ["3.50", "1.60", "2.00", None, "1.00", "12.35", None, None, None, None, "-0.50"]


def test_periods(spark):
    values = ["202501", " 202512 ", "202500", "202513", "20251", "2025-1", "abcdef", None, ""]
    assert apply(spark, values, numbers.is_period) == [True, True] + [False] * 7
    assert numbers.check_period("202501") == 202501
    for bad in ("202513", "202500", "20251", "abc"):
        with pytest.raises(ValueError):
            numbers.check_period(bad)


def test_cells_are_stripped_like_str_strip(spark):
    values = [" a ", "\ta\n", " a ", "\x1ca\x85", "  ", "", None, "a b", "　"]
    expected = [(v.strip() or None) if v is not None else None for v in values]
    assert apply(spark, values, text.clean_cell) == expected


def test_blank_becomes_null_but_text_keeps_its_edges(spark):
    assert apply(spark, [" a ", " \t", "", None], text.blank_to_null) == [" a ", None, None, None]


def test_normalize_text_matches_unicode_decomposition(spark):
    random.seed(3)
    alphabet = "aZé çÃõüñ.,;-\t/ßÅşžẾ9́"
    values = ["".join(random.choice(alphabet) for _ in range(12)) for _ in range(200)]

    def expected(v):
        plain = unicodedata.normalize("NFD", v.upper())
        plain = "".join(" " if c in ".,;" else c for c in plain if unicodedata.category(c) != "Mn")
        return " ".join(plain.split())

    assert apply(spark, values, text.normalize_text) == [expected(v) for v in values]


def test_header_slugs():
    headers = ["UF", "Marca Modelo", "Ano Fabricação Veículo CRV", "Qtd. Veículos"]
    slugs = [text.column_slug(h, i) for i, h in enumerate(headers)]
    assert slugs == ["uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos"]
    assert text.column_slug(" __A - b__c! ", 0) == "a_b_c"
    assert text.column_slug("§", 7) == "coluna_7"


def test_hash_takes_null_as_empty_text(spark):
    rows = spark.createDataFrame(
        [("FORD", "KA", 2010), ("FORD", None, 2010), (None, None, None)],
        "marca string, modelo string, ano_fabricacao int",
    )
    got = [r.h for r in rows.select(hashing.vehicle_hash().alias("h")).collect()]
    texts = ["FORD|KA|2010", "FORD||2010", "||"]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert got[0] == "f4756256421fd9fb123e775f53092af3c63b04c16ee40cbb8962d870f23bec3d"
