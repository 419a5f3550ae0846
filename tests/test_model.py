"""Dimension, fact, keys, upsert, change log, reports and quality against plain Python."""

import json
import random
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from motorpool.operators import catalogue, quality, reports
from motorpool.operators.keys import dense_ids
from motorpool.operators.upsert import assert_unique, change_payload, changes, upsert, upsert_with_ids
from motorpool.operators.vehicles import (
    attach_ids, distinct_hashes, fleet_cells, fleet_fact, lookup_ids, vehicle_dim, with_vehicle_hash,
)
from motorpool.plans import registry
from motorpool.schemas import NORM


@pytest.fixture(scope="module")
def rows():
    random.seed(5)
    out = []
    for i in range(3000):
        hot = i % 3 == 0
        marca, modelo = ("FORD", "KA") if hot else (random.choice("ABC"), random.choice("XYZ"))
        out.append((
            random.choice([202501, 202506]), i, None if i % 50 == 0 else random.choice(["SP", "RJ"]), marca, modelo,
            2010 if hot else random.choice([2010, 2011]), random.randint(-1, 9), f"{marca}/{modelo} {i % 4}", i % 2 == 0,
        ))
    return out


@pytest.fixture(scope="module")
def norm(spark, rows):
    return spark.createDataFrame(
        rows,
        "report_period int, id_raw long, uf string, marca string, modelo string, ano_fabricacao int, frota int, "
        "descricao_detran string, importado boolean",
    )


def test_dimension_takes_the_latest_period_then_the_lowest_id(norm, rows):
    best = {}
    for period, i, _, marca, modelo, ano, _, text, _ in rows:
        key, rank = (marca, modelo, ano), (-period, i)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, text)
    got = {(r.marca, r.modelo, r.ano_fabricacao): r.descricao_detran for r in vehicle_dim(norm).collect()}
    assert got == {k: v[1] for k, v in best.items()}
    assert distinct_hashes(norm).count() == len(best)


def test_fact_sums_by_vehicle_and_state(norm, rows):
    want = defaultdict(lambda: [0, -1])
    for period, i, uf, marca, modelo, ano, n, _, _ in rows:
        if uf is not None:
            cell = want[period, marca, modelo, ano, uf]
            cell[0] += n
            cell[1] = max(cell[1], i)
    dim = vehicle_dim(norm).withColumn("id_veiculo", F.xxhash64("hash_veiculo"))
    fact = fleet_fact(norm, dim).join(dim, "id_veiculo")
    got = {(r.report_period, r.marca, r.modelo, r.ano_fabricacao, r.uf): [r.frota, r.id_raw] for r in fact.collect()}
    assert got == want
    part = dim.where("marca = 'FORD'")
    assert attach_ids(fleet_cells(norm), part).where("id_veiculo IS NULL").count() == len([k for k in want if k[1] != "FORD"])
    assert lookup_ids(with_vehicle_hash(norm), part).count() == 1


def test_separator_inside_a_value_merges_vehicles(spark):
    rows = spark.createDataFrame(
        [(202501, 1, "SP", "A|B", "C", 2000, 5, "d1"), (202501, 2, "SP", "A", "B|C", 2000, 6, "d2")],
        "report_period int, id_raw long, uf string, marca string, modelo string, ano_fabricacao int, frota int, "
        "descricao_detran string",
    )
    assert [r.descricao_detran for r in vehicle_dim(rows).collect()] == ["d1"]
    assert [(r.frota, r.id_raw) for r in fleet_cells(rows).collect()] == [(11, 2)]


def test_ids_are_dense_and_repeatable(spark):
    keys = spark.range(5000).selectExpr("sha2(CAST(id AS STRING), 256) AS k")
    first = {r.k: r.n for r in dense_ids(keys, "k", "n", start=10).collect()}
    again = {r.k: r.n for r in dense_ids(keys.repartition(13), "k", "n", start=10).collect()}
    assert first == again
    assert sorted(first.values()) == list(range(11, 5011))
    assert dense_ids(keys.limit(0), "k", "n").count() == 0


def test_upsert(spark):
    target = spark.createDataFrame(
        [(1, "a", "x", 10, "old"), (2, "b", "y", 20, "old"), (3, "c", "z", 30, "old")],
        "id int, k string, v string, w int, stamp string",
    )
    source = spark.createDataFrame([("b", None, 21), ("d", "q", 40), ("c", "z2", 31)], "k string, v string, w int")
    kept = {r.k: r for r in upsert(target, source, ["k"], ["v", "w"], on_insert={"stamp": F.lit("new")}).collect()}
    assert (kept["a"].v, kept["a"].w, kept["a"].stamp, kept["a"].id) == ("x", 10, "old", 1)
    assert (kept["b"].v, kept["b"].w, kept["b"].stamp, kept["b"].id) == (None, 21, "old", 2)
    assert (kept["d"].v, kept["d"].w, kept["d"].stamp, kept["d"].id) == ("q", 40, "new", None)
    touched = {r.k: r.stamp for r in upsert(target, source, ["k"], ["v"], touch={"stamp": F.lit("now")}).collect()}
    assert touched == {"a": "old", "b": "now", "c": "now", "d": None}
    merged, inserted = upsert_with_ids(target, source, "k", ["v", "w"], "id", 7)
    assert inserted == 1
    assert {r.k: r.id for r in merged.collect()} == {"a": 1, "b": 2, "c": 3, "d": 8}


def test_a_merge_with_ids_refuses_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a", 1)], "id long, k string, v int")
    source = spark.createDataFrame([("b", 2), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError, match="repeats key"):
        upsert_with_ids(target, source, "k", ["v"], "id", 1)


def test_upsert_on_several_keys_and_unique_source(spark):
    target = spark.createDataFrame([(1, "SP", 5), (1, "RJ", 6)], "k int, uf string, n int")
    source = spark.createDataFrame([(1, "RJ", 7), (2, "SP", 8)], "k int, uf string, n int")
    got = {tuple(r) for r in upsert(target, source, ["k", "uf"], ["n"]).collect()}
    assert got == {(1, "SP", 5), (1, "RJ", 7), (2, "SP", 8)}
    assert_unique(source, ["k", "uf"])
    with pytest.raises(ValueError, match="repeats key"):
        assert_unique(source.union(source), ["k", "uf"])


def test_change_log(spark):
    schema = "k string, v string, n int"
    old = spark.createDataFrame([("a", "x", 1), ("b", None, 2), ("c", "same", 3)], schema)
    new = spark.createDataFrame([("a", "y", 1), ("b", "z", None), ("c", "same", 3), ("d", "n", None)], schema)
    got = {(r.k, r.action, r.column_name): json.loads(r.payload) for r in change_payload(changes(old, new, "k", ["v", "n"])).collect()}
    assert got == {
        ("a", "UPDATE", "v"): {"old_value": "x", "new_value": "y"},
        ("b", "UPDATE", "v"): {"old_value": None, "new_value": "z"},
        ("b", "UPDATE", "n"): {"old_value": "2", "new_value": None},
        ("d", "INSERT", "v"): {"old_value": None, "new_value": "n"},
    }


def test_reports(norm, rows):
    dim = vehicle_dim(norm).withColumn("id_veiculo", F.xxhash64("hash_veiculo"))
    fact = fleet_fact(norm, dim)
    for keys, pick in {
        ("uf",): lambda r: (r[2],),
        ("marca",): lambda r: (r[3],),
        ("marca", "modelo"): lambda r: (r[3], r[4]),
        ("report_period", "ano_fabricacao"): lambda r: (r[0], r[5]),
    }.items():
        want = defaultdict(int)
        for r in rows:
            if r[2] is not None:
                want[pick(r)] += r[6]
        got = {tuple(r[k] for k in keys): r.frota for r in reports.fleet_by(fact, dim, keys).collect()}
        assert got == want
    assert reports.star(fact, dim, 202501).where("report_period <> 202501").count() == 0
    assert reports.latest_period(norm).first()[0] == 202506


def test_quality_reports(spark, norm, rows):
    dim = vehicle_dim(norm).withColumn("id_veiculo", F.xxhash64("hash_veiculo"))
    fact = fleet_fact(norm, dim)
    report = {r.check_name: r.n for r in quality.integrity_report(dim.where("marca <> 'A'"), fact).collect()}
    assert report["orphan_facts"] == fact.count() - fact.join(dim.where("marca <> 'A'"), "id_veiculo", "left_semi").count() > 0
    assert report["duplicate_hash"] == report["duplicate_cell"] == report["null_hash"] == 0
    doubled = {r.check_name: r.n for r in quality.integrity_report(dim.union(dim), fact).collect()}
    assert doubled["duplicate_hash"] == dim.count()
    checked = {r.check_name: r.n for r in quality.norm_report(with_vehicle_hash(norm)).collect()}
    assert checked["rows"] == 3000 and checked["null_uf"] == 60
    profile = {r.column_name: (r.nulls, r.completeness_bp) for r in quality.profile(norm).collect()}
    assert profile["uf"] == (60, 9800) and profile["marca"] == (0, 10000)
    shares = {r.value: (r.n, r.share_bp) for r in quality.value_profile(norm, "uf").collect()}
    assert shares[None] == (60, 200) and sum(n for n, _ in shares.values()) == 3000
    unique = quality.uniqueness_profile(norm, ["descricao_detran"]).first()
    assert unique.records == 3000 and unique.distinct_rows == len({r[7] for r in rows})
    sides = {r.check_name: r.n for r in quality.reconcile(dim, dim.where("marca <> 'A'")).collect()}
    assert sides["staged"] == sides["in_both"] + sides["only_staged"] and sides["only_stored"] == 0
    assert {r.check_name: r.n for r in quality.norm_report(with_vehicle_hash(norm).limit(0)).collect()}["shared_cell_rows"] == 0


def _plain_sides(a, b):
    x, y = set(a) - {None}, set(b) - {None}
    odd = [int(None in a), int(None in b)]
    return {
        "staged": len(x) + odd[0], "stored": len(y) + odd[1], "in_both": len(x & y),
        "only_staged": len(x - y) + odd[0], "only_stored": len(y - x) + odd[1],
    }


def test_reconciliation_joins_only_buckets_that_differ(spark):
    keys = [f"k{i}" for i in range(3000)]
    table = lambda k: spark.createDataFrame([(x,) for x in k], "hash_veiculo string")
    cases = [
        (keys, keys), (keys + keys[:50], keys[::-1]), (keys, keys[:-1]), (keys[5:], keys[:-3] + ["new", "other"]),
        (keys + [None], keys + [None, None]), ([None], []), ([], keys[:4]), ([], []),
    ]
    for a, b in cases:
        left, right = table(a), table(b)
        assert {r.check_name: r.n for r in quality.reconcile(left, right).collect()} == _plain_sides(a, b)
        differing = quality.compare_digests(left, right, "hash_veiculo").where("not same").count()
        changed = set(a) ^ set(b) - {None}
        assert (differing == 0) == (not changed - {None}) and differing <= len(changed)


def test_row_checks_and_repeats_come_from_one_scan(spark, tmp_path):
    rows = [(202501, "SP", "FORD/KA", "2010", "5")] * 3 + [(202501, None, "X", "bad", "1"), (202506, "RJ", None, None, "x")]
    spark.createDataFrame(rows, "report_period int, uf string, marca_modelo string, ano_fabricacao_veiculo_crv string, qtd_veiculos string").write.parquet(str(tmp_path / "raw"))
    report = quality.raw_report(spark.read.parquet(str(tmp_path / "raw")))
    got = {r.check_name: r.n for r in report.collect()}
    assert got == {
        "rows": 5, "null_uf": 1, "null_marca_modelo": 1, "null_ano_fabricacao_veiculo_crv": 1, "null_qtd_veiculos": 0,
        "bad_ano": 1, "bad_qtd": 1, "duplicate_rows": 2,
    }
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_catalogue_rules(spark):
    rows = spark.createDataFrame(
        [(1, "Gasolina/Elétrico", "Automatizada; Manual"), (2, "-", "MECÂNICA"), (3, " querosene  azul", "-"), (4, None, None)],
        "i int, f string, t string",
    )
    got = catalogue.transmission(catalogue.fuel(rows, "f", "fuel"), "t", "gear").orderBy("i").collect()
    assert [(r.fuel, r.gear) for r in got] == [
        ("HIBRIDO GASOLINA", "AUTOMATIZADA"), (None, "MANUAL"), ("QUEROSENE AZUL", None), (None, None),
    ]
    years = spark.createDataFrame([(1990, 1995), (2001, None), (2015, 2012), (1899, 1950), (None, 2000)], "a int, b int")
    checked = catalogue.year_range_rules(years, "a", "b", ("a",)).collect()
    assert [(r.range_ordered, r.start_plausible, r.fields_present) for r in checked] == [
        (True, True, True), (True, True, True), (False, True, True), (True, False, True), (True, False, False),
    ]


def test_reconciliation_hashes_each_vehicle_once(spark, monkeypatch):
    norm = spark.createDataFrame([("VW", "GOL", 2010)] * 50 + [("VW", None, None)] * 20, "marca string, modelo string, ano_fabricacao int")
    house = SimpleNamespace(read=lambda contract: norm if contract.name == NORM.name else with_vehicle_hash(norm.limit(1)))
    monkeypatch.setattr(registry, "scenario", lambda *_: SimpleNamespace(warehouse=house))
    given, reconcile = [], quality.reconcile
    monkeypatch.setattr(quality, "reconcile", lambda staged, stored: given.append(staged) or reconcile(staged, stored))
    found = {r.check_name: r.n for r in registry.dq_reconcile(spark, "").collect()}
    assert given[0].count() == 2
    assert found == {"staged": 2, "stored": 1, "in_both": 1, "only_staged": 1, "only_stored": 0}
