"""The phase job on stored layers: re-runs, empty periods, failures, publish and roll back."""

import itertools

import pytest
from pyspark.sql import functions as F

from motorpool.dictionaries import STARTER_BRANDS
from motorpool.plans.job import load_core, phase_range, run
from motorpool.schemas import DIM, FACT, LOAD_LOG, NORM, PUBLISHED_DIM, PUBLISHED_FACT, RAW, conform
from motorpool.sources.publish import Publication
from motorpool.sources.warehouse import Warehouse

HEADER = "UF;Marca Modelo;Ano Fabricação Veículo CRV;Qtd. Veículos\n"
counter = itertools.count()


def put(base, period, lines):
    folder = base / "input" / str(period)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "frota.csv").write_text(HEADER + "".join(line + "\n" for line in lines), encoding="utf-8")


class Site:
    def __init__(self, spark, base):
        self.spark, self.base, self.prefix = spark, base, f"t{next(counter)}_"
        self.house = Warehouse(spark, f"{base}/house", self.prefix)

    def run(self, **options):
        options = {"brands": STARTER_BRANDS, **options}
        return run(self.spark, f"{self.base}/house", f"{self.base}/input", prefix=self.prefix, **options)

    def facts(self):
        joined = self.house.read(FACT).join(self.house.read(DIM), "id_veiculo")
        rows = joined.select("report_period", "marca", "modelo", "ano_fabricacao", "uf", "frota").collect()
        return sorted(tuple(r) for r in rows)

    def vehicles(self):
        return {(r.marca, r.modelo, r.ano_fabricacao): r for r in self.house.read(DIM).collect()}


@pytest.fixture()
def site(spark, tmp_path):
    return Site(spark, tmp_path)


FIRST = ["SP;VW/GOL;2010;20", "SP;VOLKS/GOL;2010;5", "RJ;FORD/KA;2011;30", ";FORD/KA;2011;7", "SP;I/FORD KA;2011;1"]
SECOND = ["SP;VOLKS/GOL;2010;40", "MG;BMW/X1;2020;50"]


def test_whole_run(site):
    put(site.base, 202501, FIRST)
    outcome = site.run()
    assert outcome.period == 202501
    assert outcome.counts == {
        "raw": 5, "norm": 5, "vehicles_inserted": 2, "vehicles_updated": 0, "facts": 3, "version": 1,
    }
    assert site.facts() == [
        (202501, "FORD", "KA", 2011, "RJ", 30), (202501, "FORD", "KA", 2011, "SP", 1),
        (202501, "VOLKSWAGEN", "GOL", 2010, "SP", 25),
    ]
    assert site.vehicles()["VOLKSWAGEN", "GOL", 2010].descricao_detran == "VW/GOL"
    raw = site.house.read(RAW).orderBy("id_raw").collect()
    assert [(r.id_raw, r.csv_row, r.source_file) for r in raw] == [(i + 1, i + 2, "frota.csv") for i in range(5)]
    gol = site.house.read(FACT).where("frota = 25").first()
    assert gol.id_raw == 2


def test_second_period_keeps_ids_and_updates_the_description(site):
    put(site.base, 202501, FIRST)
    site.run()
    before = site.vehicles()
    put(site.base, 202506, SECOND)
    outcome = site.run()
    assert outcome.period == 202506
    assert (outcome.counts["vehicles_inserted"], outcome.counts["vehicles_updated"]) == (1, 1)
    after = site.vehicles()
    gol = ("VOLKSWAGEN", "GOL", 2010)
    assert after[gol].id_veiculo == before[gol].id_veiculo
    assert after[gol].created_at == before[gol].created_at and after[gol].updated_at == before[gol].updated_at
    assert after[gol].descricao_detran == "VOLKS/GOL"
    ids = [r.id_veiculo for r in after.values()]
    assert sorted(ids) == [1, 2, 3]
    assert len(site.facts()) == 5


def test_changes_are_kept(site):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506)
    log = {(r.report_period, r.marca, r.action, r.column_name, r.old_value, r.new_value) for r in site.house.history().collect()}
    assert (202506, "VOLKSWAGEN", "UPDATE", "descricao_detran", "VW/GOL", "VOLKS/GOL") in log
    assert (202506, "BMW", "INSERT", "ano_fabricacao", None, "2020") in log
    assert len(log) == 8 + 5


def test_a_job_leaves_no_scratch_tables(site, spark, monkeypatch):
    import motorpool.session as session

    made = []
    path = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda *a: made.append(path(*a)) or made[-1])
    put(site.base, 202501, FIRST)
    site.run()
    from motorpool.sources import files

    assert made and not any(files.exists(spark, p) for p in made)
    assert site.facts()


def test_any_phase_can_be_repeated(site):
    put(site.base, 202501, FIRST)
    site.run()
    facts, vehicles = site.facts(), site.vehicles()
    site.run(start="normalize")
    site.run(start="core", stop="core")
    site.run()
    assert site.facts() == facts
    assert {k: v.id_veiculo for k, v in site.vehicles().items()} == {k: v.id_veiculo for k, v in vehicles.items()}
    assert site.house.read(NORM).count() == 5 and site.house.read(RAW).count() == 5
    # Numbers of replaced rows are not given out again.
    assert site.house.read(RAW).agg(F.min("id_raw")).first()[0] == 6


def test_a_period_that_turns_empty_is_cleared(site):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506)
    put(site.base, 202506, ["SP;FORD/KA;x;y"])
    outcome = site.run(period="202506")
    assert (outcome.counts["norm"], outcome.counts["facts"]) == (0, 0)
    assert {f[0] for f in site.facts()} == {202501}
    assert site.house.read(NORM, 202506).count() == 0
    assert len(site.vehicles()) == 3


def test_a_failing_load_keeps_the_stored_period(site):
    put(site.base, 202501, FIRST)
    site.run()
    put(site.base, 202501, [*FIRST, "SP;" + "X" * 101 + ";2010;1"])
    with pytest.raises(Exception, match="longer than 100"):
        site.run()
    assert site.house.read(RAW).count() == site.house.read(NORM).count() == 5
    assert len(site.facts()) == 3
    # The next load still gives out fresh numbers.
    put(site.base, 202506, SECOND)
    site.run(period=202506)
    raw = site.house.read(RAW)
    assert raw.count() == raw.select("id_raw").distinct().count() == 7


def test_change_log_survives_a_failure_between_its_write_and_the_switch(site, monkeypatch):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    before = site.house.history().count()

    def broken(self, *rest):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", broken)
        with pytest.raises(OSError):
            site.run(period=202506)
    # The log of the version that never became current is not shown, and the vehicles are the old ones.
    assert site.house.history().count() == before and len(site.vehicles()) == 2
    site.run(period=202506, start="core")
    assert [r.old_value for r in site.house.history().where("action = 'UPDATE'").collect()] == ["VW/GOL"]
    assert len(site.vehicles()) == 3


@pytest.mark.parametrize("step", ["write_dim", "replace_periods", "write_fact", "commit", "_refresh", "_sweep"])
def test_core_readers_see_the_old_or_the_new_state(site, monkeypatch, step):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506, stop="normalize")
    old = site.facts(), site.house.read(DIM).count(), site.house.history().count()
    real = getattr(Warehouse, step)

    def broken(self, *rest, **options):
        # the write itself succeeds, what follows it does not
        out = real(self, *rest, **options)
        raise OSError(f"gone after {step}: {out}")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, step, broken)
        with pytest.raises(OSError):
            load_core(site.house, 202506)
    record = site.house.commit_record()
    seen = site.facts(), site.house.read(DIM).count(), site.house.history().count()
    committed = step in ("commit", "_refresh", "_sweep") and record["number"] == 2
    if not committed:
        assert seen == old and record["number"] == 1
    load_core(site.house, 202506)
    new = site.facts(), site.house.read(DIM).count(), site.house.history().count()
    assert new[1] == 3 and len(new[0]) == 5
    if committed:
        assert seen == new


def test_commits_of_two_loads_do_not_overwrite_each_other(site):
    put(site.base, 202501, FIRST)
    site.run()
    stale = site.house.commit_record(1) | {"number": 0}
    with pytest.raises(RuntimeError, match="another load committed"):
        site.house.commit(stale, 1, {})
    assert site.house.commit_record()["number"] == 1 and len(site.facts()) == 3


def test_fact_folders_of_older_commits_go(site):
    put(site.base, 202501, FIRST)
    site.run()
    for _ in range(3):
        load_core(site.house, 202501)
    folder = site.base / "house/core/fato_frota_uf/report_period=202501"
    assert len([f for f in folder.iterdir() if f.name.startswith("load=")]) == 2
    assert len(site.facts()) == 3


def copies(site):
    root = site.base / "house/analytics"
    return {str(p.relative_to(root)) for p in root.glob("*/**/v=*")}


def test_publishing_copies_only_what_changed(site):
    for period, lines in ((202501, FIRST), (202506, SECOND), (202507, FIRST)):
        put(site.base, period, lines)
        before = copies(site)
        site.run(period=period)
        fresh = copies(site) - before
        assert {f.split("/v=")[0] for f in fresh} == {"dim_veiculo_detran", f"fato_frota_uf/report_period={period}"}
    publication = Publication(site.house)
    before = copies(site)
    # nothing changed, so a version costs no copy; what only the version before last named is gone
    assert publication.publish() == 4 and not copies(site) - before
    assert publication.tables()[1].count() == publication.tables("previous")[1].count() == 8
    put(site.base, 202506, ["SP;VW/GOL;2010;99"])
    site.run(period=202506)
    assert {f.split("/v=")[0] for f in copies(site) - before} == {"dim_veiculo_detran", "fato_frota_uf/report_period=202506"}
    assert {(r.report_period, r.frota) for r in publication.tables()[1].collect() if r.report_period == 202506} == {(202506, 99)}
    assert publication.tables("previous")[1].where("report_period = 202506").count() == 2
    publication.rollback()
    assert publication.tables()[1].where("report_period = 202506").count() == 2
    assert publication.tables("failed")[1].where("report_period = 202506").count() == 1
    kept = {f"{PUBLISHED_FACT.name}/report_period=202506", f"{PUBLISHED_DIM.name}"}
    assert {f.split("/v=")[0] for f in copies(site)} >= kept


def test_an_emptied_period_leaves_both_layers(site):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506)
    put(site.base, 202501, ["SP;NO SLASH;2010;20"])
    site.run(period=202501)
    assert {f[0] for f in site.facts()} == {202506}
    assert {r.report_period for r in Publication(site.house).tables()[1].collect()} == {202506}
    p = site.prefix
    for schema in ("core", "analytics"):
        assert site.spark.sql(f"SELECT count(*) FROM {p}{schema}.fato_frota_uf").first()[0] == 2


def test_history_view_ends_at_the_published_version(site, spark):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    view = f"{site.prefix}analytics.vw_historico_alteracoes"
    before = spark.sql(f"SELECT count(*) FROM {view}").first()[0]
    site.run(period=202506, stop="core")
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == before
    site.run(period=202506, start="analytics")
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == site.house.history().count() > before


def test_publishing_twice_at_once_is_refused(site):
    put(site.base, 202501, FIRST)
    site.run(stop="core")
    with site.house.exclusive("_publishing"):
        for change in (Publication(site.house).publish, Publication(site.house).rollback):
            with pytest.raises(RuntimeError, match="another job"):
                change()


def test_rows_of_another_period_stop_the_write(site):
    put(site.base, 202501, FIRST)
    site.run()
    rows = site.house.read(NORM).withColumn("report_period", F.lit(202502))
    with pytest.raises(Exception, match="another period"):
        site.house.replace_periods(rows, NORM, [202501])
    assert site.house.read(NORM, 202501).count() == 5 and site.house.read(NORM, 202502).count() == 0


def test_normalizing_needs_a_dictionary(site, spark):
    put(site.base, 202501, FIRST)
    with pytest.raises(ValueError, match="brand dictionary"):
        run(spark, f"{site.base}/house", f"{site.base}/input", prefix=site.prefix)


def test_load_log_keeps_the_last_count_of_each_phase(site):
    put(site.base, 202501, FIRST)
    site.run()
    site.run(start="core")
    log = {r.stage: r.n for r in site.house.read(LOAD_LOG, 202501).collect()}
    assert log == {"raw": 5, "norm": 5, "facts": 3, "vehicles_inserted": 0, "vehicles_updated": 2}


def test_a_second_load_at_the_same_time_is_refused(site):
    put(site.base, 202501, FIRST)
    site.house.ensure()
    with site.house.exclusive():
        with pytest.raises(RuntimeError, match="another job"):
            site.run()
    site.run()
    assert site.house.read(RAW).count() == 5


def test_published_names_are_views_of_fixed_versions(site, spark):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506)
    name = f"{site.prefix}analytics.fato_frota_uf"
    count = lambda suffix="": spark.sql(f"SELECT count(*) FROM {name}{suffix}").first()[0]
    assert (count(), count("_prev"), count("_v2"), count("_v1")) == (5, 3, 5, 3)
    publication = Publication(site.house)
    publication.rollback()
    assert (count(), count("_failed")) == (3, 5) and not spark.catalog.tableExists(f"{name}_prev")
    publication.publish()
    publication.publish()
    assert (count(), count("_prev")) == (5, 5) and not spark.catalog.tableExists(f"{name}_v1")


def test_a_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Warehouse(spark, f"{tmp_path}/typo").read(NORM)
    assert not (tmp_path / "typo").exists()


def test_updated_at_policy(site):
    put(site.base, 202501, FIRST)
    site.run()
    before = site.vehicles()["FORD", "KA", 2011]
    load_core(site.house, 202501, touch_updated_at=True)
    after = site.vehicles()["FORD", "KA", 2011]
    assert after.created_at == before.created_at and after.updated_at > before.updated_at


def test_layers_are_sql_tables(site, spark):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    site.run(period=202501)
    site.run(period=202506)
    p = site.prefix
    assert spark.sql(f"SELECT count(*) FROM {p}staging.detran_vehicle_norm WHERE report_period = 202501").first()[0] == 5
    assert spark.sql(f"SELECT count(*) FROM {p}core.dim_veiculo_detran").first()[0] == 3
    total = spark.sql(
        f"SELECT sum(f.frota) FROM {p}analytics.fato_frota_uf f JOIN {p}analytics.dim_veiculo_detran d "
        f"ON f.id_veiculo = d.id_veiculo WHERE f.report_period = 202506"
    ).first()[0]
    assert total == 90
    assert spark.sql(f"SELECT count(*) FROM {p}analytics.fato_frota_uf_prev").first()[0] == 3
    assert spark.sql(f"SELECT count(*) FROM {p}analytics.vw_dim_veiculo WHERE marca = 'BMW'").first()[0] == 1
    changed = spark.sql(f"SELECT old_value FROM {p}analytics.vw_historico_alteracoes WHERE action = 'UPDATE'").collect()
    assert [r.old_value for r in changed] == ["VW/GOL"]
    # A new session-side warehouse object over the same folder finds the stored partitions.
    other = Warehouse(spark, f"{site.base}/house", f"{p}again_")
    other.ensure()
    assert spark.sql(f"SELECT count(*) FROM {p}again_core.fato_frota_uf").first()[0] == 5


def test_publish_and_roll_back(site):
    put(site.base, 202501, FIRST)
    put(site.base, 202506, SECOND)
    publication = Publication(site.house)
    site.run(period=202501)
    assert publication.rollback() is False
    site.run(period=202506)
    assert publication.tables()[1].count() == 5
    assert publication.rollback() is True
    dim, fact = publication.tables()
    assert (dim.count(), fact.count()) == (2, 3)
    assert publication.tables("failed")[1].count() == 5
    assert publication.rollback() is False
    publication.publish()
    assert publication.tables()[1].count() == 5 and publication.tables("previous")[1].count() == 3
    publication.publish()
    kept = publication.manifest()
    assert (kept["current"], kept["previous"], kept["failed"]) == (4, 3, 2)
    published, core = publication.tables()[0], site.house.read(DIM)
    assert published.exceptAll(core).count() == core.exceptAll(published).count() == 0


def test_phase_names():
    assert phase_range() == ("raw", "normalize", "core", "analytics")
    assert phase_range("normalize", "core") == ("normalize", "core")
    for bad in (("core", "raw"), ("load", "core")):
        with pytest.raises(ValueError):
            phase_range(*bad)


def test_period_argument_is_checked(site):
    put(site.base, 202613, FIRST)
    with pytest.raises(ValueError):
        site.run(period="202613")
    with pytest.raises(ValueError):
        site.run(period="202502")


def test_contract_refuses_missing_required_values(spark):
    rows = spark.createDataFrame(
        [(1, None, "A", "B", 2000, None, None, None)],
        "id_veiculo long, hash_veiculo string, marca string, modelo string, ano_fabricacao int, "
        "descricao_detran string, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    with pytest.raises(Exception, match="hash_veiculo must not be NULL"):
        conform(rows, DIM).collect()
