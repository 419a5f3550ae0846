"""Make/model split, dictionary match, aliases, brand validity."""

import random

import pytest
from pyspark.sql import functions as F

from motorpool.dictionaries import BRAND_ALIASES, STARTER_BRANDS, alias_table, inline_table
from motorpool.functions import makemodel as mm
from motorpool.operators.brands import (
    _look_up, brand_names, checked_brands, dictionary_from_catalogue, dictionary_table, load_dictionary, longest_first,
    match_by_join, match_by_search, search_table,
)
from motorpool.operators.normalize import (
    apply_aliases, brand_totals, normalize, parse_rows, split_make_model, valid_brands,
)

# (make/model text, brand, model, imported) before the brand threshold.
GOLDEN = [
    ("FORD/KA", "FORD", "KA", False),
    ("FORD/KA/GL", "FORD", "KA/GL", False),
    ("VW/GOL", "VOLKSWAGEN", "GOL", False),
    ("FORD KA", None, "FORD KA", False),
    ("I/FORD FUSION", "FORD", "FUSION", True),
    ("I/FORD", "FORD", None, True),
    ("I/VW PASSAT", None, "VW PASSAT", True),
    ("I/M.BENZ/C180", None, "C180", True),
    ("I/FORD/BMW X1", "BMW", "X1", True),
    ("IMP/BMW 320", "BMW", "320", True),
    ("IMP/M.BENZ 300", None, "M.BENZ 300", True),
    ("I/MANGOSTEEN M1", "MANGOSTEEN", "M1", True),
    ("I/RAMPAGE", "RAM", "PAGE", True),
    ("I/FIAT ALLIS FD9", "FIAT ALLIS", "FD9", True),
    ("R/RANDON", "REBOQUE", "RANDON", False),
    ("/FOO", None, "/FOO", False),
    ("FORD/", "FORD", None, False),
    ("I/I/FORD X", "FORD", "X", True),
    ("i/FORD X", "i", "FORD X", False),
    ("A.SILVA/REB", "A.SILVA", "REB", False),
    ("I/IMP/BMW X3", "BMW", "X3", True),
    ("FORD/ KA", "FORD", " KA", False),
    ("I/", None, None, True),
    (None, None, None, False),
]


def raw_rows(spark, rows):
    """rows: (marca_modelo, ano, qtd[, uf[, period]])"""
    full = [
        (r[4] if len(r) > 4 else 202501, i + 1, r[3] if len(r) > 3 else "SP", r[0], r[1], r[2])
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(
        full,
        "report_period int, id_raw long, uf string, marca_modelo string, "
        "ano_fabricacao_veiculo_crv string, qtd_veiculos string",
    )


def test_golden_rows(spark):
    raw = raw_rows(spark, [(g[0], "2010", "1") for g in GOLDEN])
    parsed = parse_rows(raw, STARTER_BRANDS, alias_table(spark)).orderBy("id_raw").collect()
    assert len(parsed) == len(GOLDEN)
    for got, want in zip(parsed, GOLDEN):
        assert (got.marca_modelo, got.marca or None, got.modelo or None, got.importado) == want


def expected_split(text, brands):
    """The rules in plain Python, on one text."""
    if text is None:
        return None, None, False
    imported = text[:2] == "I/"
    body = text[2:] if imported else text
    head, slash, tail = body.partition("/")
    rest = tail if slash and head else body
    brand = head if "/" in text else None
    if imported or brand == "IMP":
        hits = [b for b in brands if rest.startswith(b)]
        brand = max(hits, key=len) if hits else None
        rest = rest[len(brand):].lstrip() if brand else rest
        imported = True
    return brand, rest, imported


@pytest.mark.parametrize("as_table", [False, True])
def test_random_texts_follow_the_rules(spark, as_table):
    random.seed(11)
    pieces = ["I/", "IMP/", "IMP", "/", "FORD", "FIAT", "FIAT ALLIS", "MAN", "MANGOSTEEN", " ", " ", "X1", "A.", "VW", "i/"]
    texts = ["".join(random.choice(pieces) for _ in range(random.randint(0, 6))) for _ in range(1500)]
    raw = raw_rows(spark, [(t, "2010", "1") for t in texts])
    rows = raw.withColumns({"ano_fabricacao": F.lit(2010), "frota": F.lit(1)})
    brands = dictionary_table(spark) if as_table else STARTER_BRANDS
    found = split_make_model(rows, brands).collect()
    assert len(found) == len(texts)
    for got in found:
        assert (got.marca, got.modelo, got.importado) == expected_split(got.marca_modelo, STARTER_BRANDS), got


def test_pattern_and_join_agree_on_every_prefix_text(spark):
    texts = {b + end for b in STARTER_BRANDS for end in ("", " X", "X", "/Y")} | {b[:-1] for b in STARTER_BRANDS} | {"", "ZZ"}
    rows = spark.createDataFrame([(t,) for t in sorted(texts)], "rest string")
    joined = {r.rest: r.brand for r in match_by_join(rows, "rest", dictionary_table(spark)).collect()}
    found = rows.select("rest", mm.dictionary_prefix(F.col("rest"), STARTER_BRANDS).alias("b")).collect()
    assert {r.rest: r.b for r in found if r.b} == joined
    assert joined["FIAT ALLIS X"] == "FIAT ALLIS" and joined["MANGOSTEENX"] == "MANGOSTEEN"


def test_search_agrees_with_the_join_on_nested_names(spark):
    rng = random.Random(5)
    names = {"".join(rng.choice("AB ") for _ in range(rng.randint(1, 14))).strip() or "A" for _ in range(120)}
    texts = {n + end for n in names for end in ("", "A", "ZZ", " B")} | {n[:-1] for n in names} | {"Z", "ÉA"}
    texts |= {"".join(rng.choice("AB ") for _ in range(rng.randint(0, 20))) for _ in range(300)}
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,), ("A",), ("A",)], "rest string")
    for some in (sorted(names), sorted(names)[:1], sorted(names)[:7], [*sorted(names), "ÉA"]):
        table = dictionary_table(spark, some)
        want = {t: max((n for n in some if t.startswith(n)), key=len, default=None) for t in texts}
        got = [(r.rest, r.brand) for r in match_by_search(rows, "rest", table).collect()]
        assert len(got) == len(dict(got)) and dict(got) == {t: b for t, b in want.items() if b is not None}
        assert set(got) == {(r.rest, r.brand) for r in match_by_join(rows, "rest", table).collect()}
    assert match_by_search(rows, "rest", table.limit(0)).count() == 0
    assert match_by_search(rows.limit(0), "rest", table).count() == 0


@pytest.mark.parametrize("count", [5001, 100_000])
def test_search_on_large_dictionaries_with_a_hot_beginning(spark, count):
    """Two thirds of all texts begin with one name; markers at log2(lengths) places a name at most."""
    dictionary = spark.range(count).selectExpr("concat('N', cast(id * 7 AS string), if(id % 3 = 0, ' MOTORS', '')) AS brand")
    texts = spark.range(40_000).selectExpr("if(id % 3 > 0, concat('N7 X', id), concat('N', id * 7, ' M', id)) AS rest")
    found = match_by_search(texts, "rest", dictionary)
    got = {r.rest: r.brand for r in found.collect()}
    assert got == {r.rest: r.brand for r in match_by_join(texts, "rest", dictionary).collect()}
    lengths = sorted({r.n for r in dictionary.selectExpr("length(brand) AS n").distinct().collect()})
    assert search_table(dictionary, lengths).count() <= count * (len(lengths).bit_length() + 1)


def test_no_task_of_the_search_gets_a_hot_beginning_whole(spark):
    """The keys of the look-up's join, by hand: a beginning that every text shares is dealt over parts."""
    texts = spark.range(20_000).selectExpr("concat('FORD ', id) AS _text", "0 AS _low", "0 AS _high", "0 AS _found")
    entries = spark.createDataFrame([("FORD", 4)], "prefix string, found int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = _look_up(texts, entries, [4], 300)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
        assert out.where("_found = 4").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_normalisation_with_a_large_dictionary(spark):
    many = dictionary_table(spark, STARTER_BRANDS).union(spark.range(6000).selectExpr("concat('ZZQ', id) AS brand"))
    raw = raw_rows(spark, [("I/FORD KA", "2010", "20"), ("I/LAND ROVER X", "2010", "20"), ("I/NOBODY X", "2010", "20"), ("FIAT/UNO", "2010", "20")])
    pick = lambda brands: {(r.id_raw, r.marca, r.modelo) for r in normalize(raw, brands, alias_table(spark)).collect()}
    assert pick(many) == pick(STARTER_BRANDS) and len(pick(many)) == 3


def test_join_match_on_one_hot_text(spark):
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'FORD KA', concat('BMW ', id)) AS rest")
    matched = match_by_join(rows, "rest", dictionary_table(spark))
    assert matched.count() == rows.distinct().count()
    assert rows.join(matched, "rest").count() == 30_000


def test_dictionary_sources(spark, tmp_path):
    path = tmp_path / "brands.txt"
    path.write_text("FORD\n\nBMW \nFORD\n", encoding="utf-8")
    assert load_dictionary(spark, str(path)) == ("FORD", "BMW")
    path.write_text("\n".join(f"B{i}" for i in range(5001)), encoding="utf-8")
    assert load_dictionary(spark, str(path)).count() == 5001
    with pytest.raises(ValueError):
        checked_brands(["FORD", "IMP"])
    assert brand_names(dictionary_table(spark, ["B", "A", "B"])) == ("A", "B")
    with pytest.raises(ValueError, match="do not fit one pattern"):
        brand_names(spark.range(6000).selectExpr("concat('B', id) AS brand"))
    imp = raw_rows(spark, [("I/X", "1", "1")])
    with pytest.raises(ValueError, match="cannot be a brand"):
        parse_rows(imp, dictionary_table(spark, ["IMP"]), None)
    rows = spark.createDataFrame([("Citroën",), ("CITROEN ",), ("Land  Rover",), (None,), (" ",)], "marca string")
    assert {r.brand for r in dictionary_from_catalogue(rows).collect()} == {"CITROEN", "LAND ROVER"}
    ordered = [r.brand for r in longest_first(dictionary_table(spark, ["RAM", "FIAT ALLIS", "FIAT", "BMW"])).collect()]
    assert ordered == ["FIAT ALLIS", "FIAT", "BMW", "RAM"]


def test_fixed_values():
    assert len(BRAND_ALIASES) == 22 and len(set(dict(BRAND_ALIASES))) == 22
    outside = {target for _, target in BRAND_ALIASES} - set(STARTER_BRANDS)
    assert outside == {"REBOQUE", "SEMI REBOQUE"}
    assert len(set(STARTER_BRANDS)) == len(STARTER_BRANDS)


def test_threshold_is_strict_per_period_and_after_aliases(spark):
    raw = raw_rows(spark, [
        ("VW/GOL", "2010", "6"), ("VOLKS/GOL", "2010", "5"),
        ("FORD/KA", "2010", "10"),
        ("BMW/X1", "2010", "11"), ("BMW/X1", "2010", "10", "SP", 202506),
        ("A.SILVA/REB", "2010", "99"), ("FIAT/UNO", "2010", "12"), ("FIAT/UNO", "2010", "-2"),
    ])
    valid = {(r.report_period, r.marca, r.frota) for r in valid_brands(parse_rows(raw, STARTER_BRANDS, alias_table(spark))).collect()}
    assert valid == {(202501, "VOLKSWAGEN", 11), (202501, "BMW", 11)}


def test_imported_rows_count_unless_told_otherwise(spark):
    raw = raw_rows(spark, [("I/FORD KA", "2010", "8"), ("FORD/KA", "2010", "3")])
    parsed = parse_rows(raw, STARTER_BRANDS, alias_table(spark))
    assert brand_totals(parsed).first().frota == 11
    assert brand_totals(parsed, count_imported=False).first().frota == 3
    assert normalize(raw, STARTER_BRANDS, alias_table(spark)).count() == 2
    assert normalize(raw, STARTER_BRANDS, alias_table(spark), count_imported=False).count() == 0


def test_non_numeric_rows_leave_and_zero_counts_stay(spark):
    raw = raw_rows(spark, [
        ("FORD/KA", "SEM ANO", "50"), ("FORD/KA", "2010.0", "20"), ("FORD/KA", "2011", "0"),
        ("FORD/KA", "2012", "1d"), ("FORD/KA", "2013", "-1"), ("FORD/KA", None, "5"), ("FORD/KA", "2014", "1e400"),
    ])
    rows = normalize(raw, STARTER_BRANDS, alias_table(spark)).orderBy("id_raw").collect()
    assert [(r.ano_fabricacao, r.frota) for r in rows] == [(2010, 20), (2011, 0), (2013, -1)]


def test_empty_input_keeps_the_schema(spark):
    raw = raw_rows(spark, [("FORD/KA", "x", "y")])
    empty = normalize(raw, STARTER_BRANDS, alias_table(spark))
    assert empty.count() == 0 and "importado" in empty.columns


def test_variants(spark):
    raw = raw_rows(spark, [
        ("VW/GOL", "2010", "20"), ("I/FORD KA", "2010", "20"), ("FORD/", "2010", "20"), ("/FOO", "2010", "20"),
        ("IMP/BMW 320", "2010", "20"), (None, "2010", "20"), ("NO SLASH", "2010", "20"),
    ])
    basic = normalize(raw, None, None, count_imported=False, drop_empty=False)
    assert {(r.marca, r.modelo) for r in basic.collect()} == {
        ("VW", "GOL"), ("FORD", ""), ("", "/FOO"), ("IMP", "BMW 320"),
    }
    plain = normalize(raw, STARTER_BRANDS, None, drop_empty=False)
    assert {(r.marca, r.modelo, r.importado) for r in plain.collect()} == {
        ("VW", "GOL", False), ("FORD", "KA", True), ("FORD", "", False), ("", "/FOO", False), ("BMW", "320", True),
    }


def test_own_alias_table(spark):
    rows = spark.createDataFrame([("X",), ("Y",), (None,)], "marca string")
    mapped = apply_aliases(rows, inline_table(spark, [("X", "XAVIER")], ("alias", "canonical"))).collect()
    assert {r.marca for r in mapped} == {"XAVIER", "Y", None}


def test_wide_skew_keeps_every_row(spark):
    """A third of all rows share one brand, vehicle and state."""
    rows = spark.range(60_000).selectExpr(
        "202501 AS report_period", "id AS id_raw", "'SP' AS uf",
        "if(id % 3 = 0, 'FORD/KA', concat('B', id % 500, '/M', id % 7000)) AS marca_modelo",
        "'2010' AS ano_fabricacao_veiculo_crv", "'1' AS qtd_veiculos",
    )
    norm = normalize(rows, STARTER_BRANDS, alias_table(spark))
    assert norm.count() == 60_000
    assert norm.where("marca = 'FORD'").count() == 20_000
