"""Loads side by side: leases that run out, id ranges, periods loaded by two sessions at once."""

import threading
import time

import pytest

from motorpool.schemas import DIM, FACT, RAW
from motorpool.sources.leases import Lease
from motorpool.sources.warehouse import Warehouse
from tests.test_job import FIRST, SECOND, Site, put


def test_a_lease_is_held_by_one_and_given_back(spark, tmp_path):
    a, b = (Lease(spark, str(tmp_path), "work") for _ in range(2))
    with a.hold():
        assert a.held() and not b.take()
        with pytest.raises(RuntimeError, match="another job"):
            with b.hold():
                pass
        a.check()
    with b.hold():
        assert b.epoch == 2


def test_a_dead_job_blocks_nobody_and_is_fenced(spark, tmp_path):
    dead, other = (Lease(spark, str(tmp_path), "work", seconds=0.5) for _ in range(2))
    assert dead.take()
    with other.hold(wait=30):
        with pytest.raises(RuntimeError, match="took over"):
            dead.check()
        with pytest.raises(RuntimeError, match="took over"):
            dead.renew()
        dead.release()
        other.check()


def test_a_live_job_keeps_its_lease_beyond_its_seconds(spark, tmp_path):
    a, b = (Lease(spark, str(tmp_path), "work", seconds=2) for _ in range(2))
    with a.hold():
        time.sleep(3)
        assert not b.take()


def test_an_overtaken_load_writes_nothing(spark, tmp_path):
    site = Site(spark, tmp_path)
    put(tmp_path, 202501, FIRST)
    site.run()
    slow = Warehouse(spark, site.house.root, site.prefix, lease_seconds=0.2)
    lease = slow._lease("_core")
    assert lease.take()
    slow._held.append(lease)
    time.sleep(0.3)
    before = slow.commit_record()
    with Warehouse(spark, site.house.root, site.prefix).exclusive("_core"):
        with pytest.raises(RuntimeError, match="took over"):
            slow.commit(before, 1, {})
    assert site.house.commit_record() == before and len(site.facts()) == 3


def test_ranges_of_ids_never_overlap(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    got = []

    def ask():
        for _ in range(8):
            got.append(house.reserve_ids(RAW, "id_raw", 5))

    threads = [threading.Thread(target=ask) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [5 * i for i in range(32)]
    assert house.reserve_ids(RAW, "id_raw", 0) == house.highest_id(RAW, "id_raw") == 160


def test_ids_go_on_after_the_number_older_warehouses_kept(spark, tmp_path):
    from motorpool.sources import files

    house = Warehouse(spark, str(tmp_path))
    files.replace_json(spark, f"{house.folder(RAW)}/_last_id_raw.json", {"value": 40})
    assert house.reserve_ids(RAW, "id_raw", 2) == 40 and house.highest_id(RAW, "id_raw") == 42


def test_two_periods_load_at_once(spark, tmp_path):
    one, two = Site(spark, tmp_path), Site(spark.newSession(), tmp_path)
    put(tmp_path, 202501, FIRST)
    put(tmp_path, 202506, SECOND)
    failed = []

    def load(site, period):
        try:
            site.run(period=period)
        except Exception as error:  # shown by the assertion below
            failed.append(error)

    threads = [threading.Thread(target=load, args=x) for x in ((one, 202501), (two, 202506))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    raw = one.house.read(RAW)
    assert raw.count() == raw.select("id_raw").distinct().count() == 7
    ids = [r.id_veiculo for r in one.house.read(DIM).collect()]
    assert len(ids) == len(set(ids)) == 3
    assert {r.report_period for r in one.house.read(FACT).collect()} == {202501, 202506} and len(one.facts()) == 5
    assert one.house.commit_record()["number"] == 2


def test_the_same_period_is_loaded_by_one(spark, tmp_path):
    site = Site(spark, tmp_path)
    put(tmp_path, 202501, FIRST)
    with site.house.loading(202501):
        with pytest.raises(RuntimeError, match="another job"):
            site.run()
        with pytest.raises(RuntimeError, match="another job"):
            with site.house.exclusive():
                pass
    site.run()
