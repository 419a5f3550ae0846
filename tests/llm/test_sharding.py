"""Shards: equal bytes, whole groups, gapless slots."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.llm import sharding
from motorpool.llm.common import table


def checked(rows, shards):
    """Sizes of the shards; every row has one place, slots have no gaps."""
    slots = [[] for _ in range(shards)]
    loads = np.zeros(shards, np.int64)
    for r in rows:
        body = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 8, zlib.crc32(body), "bytes")
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots)
    return loads


def test_whole_table(spark, small):
    docs = table(spark, small, "documents")
    rows = sharding.shard(docs).collect()
    loads = checked(rows, sharding.SHARDS)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert loads.max() - loads.min() <= max(r.size for r in rows)
    again = sharding.shard(docs).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_hot_text_is_cut_and_other_groups_stay(spark, docs_of):
    texts = ["hot " * 20] * 4000 + [f"text {i} " * 9 for i in range(4000)] + [f"pair {i} " * 9 for i in range(2000) for _ in "ab"]
    rows = sharding.shard(docs_of(texts), 8).collect()
    loads = checked(rows, 8)
    assert loads.max() < 1.03 * loads.mean() and loads.min() > 0.97 * loads.mean()
    homes = {}
    for r in rows:
        homes.setdefault(r.text, set()).add(r.shard)
    assert {t for t, s in homes.items() if len(s) > 1} <= {"hot " * 20}


def test_rows_that_are_all_alike_spread(spark, docs_of):
    rows = sharding.shard(docs_of(["same"] * 3000, ids=[None] * 3000), 6).collect()
    loads = checked(rows, 6)
    assert loads.max() < 1.1 * loads.mean()


def test_edge_cases(spark, docs_of):
    texts, ids = [None, "", "é", "x" * 50_000, "same", "same", "same"], [None, 1, 2, 3, 4, 4, 5]
    docs = docs_of(texts, ids).withColumns({"size": F.lit("x"), "Shard": F.lit(1), "_row": F.lit(2)})
    out = sharding.shard(docs, 3)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", *sharding.ADDED]
    rows = out.collect()
    assert len(rows) == len(texts)
    checked(rows, 3)
    empty = sharding.shard(docs.limit(0), 3)
    assert empty.columns == out.columns and empty.count() == 0


def test_crowded_ranges_are_cut_again(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
    texts = [f"text {i} " * 9 for i in range(20_000)]
    docs = docs_of(texts)
    keys = {**sharding._keys("text", "doc_id"), "_size": sharding.record_size()}
    rows = docs.select(*[c.alias(n) for n, c in keys.items()])
    plan = sharding.plan_shards(rows, 4, 16)
    sizes = [r.bytes for r in sharding._measured(rows, plan.bounds)]
    assert max(sizes) <= sharding.OVERFULL * sum(sizes) / 64


@pytest.mark.parametrize("sizes", [[100, 1, 1, 1], [5] * 40, [1], [50, 50, 3, 2, 1] + [1] * 30])
def test_fill(sizes):
    class Row(tuple):
        bytes = property(lambda self: self[1])
        rows = 1

    shards, limit = 4, 2 * max(1, sum(sizes) / 64)
    loads = [0] * shards
    for r, s, _ in sharding._fill([Row((i, n)) for i, n in enumerate(sizes)], shards, limit):
        loads[s] += sizes[r]
    assert max(loads) <= max(max(sizes), sum(sizes) / shards + limit)


def test_written_shards(spark, docs_of, tmp_path):
    docs = docs_of([f"text {i}" for i in range(300)])
    sharding.write_shards(sharding.shard(docs, 4), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    checked(back.collect(), 4)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={i}" for i in range(4)]


def test_plan_is_native(spark, small):
    plan = sharding.shard_report(table(spark, small, "documents"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "ExistingRDD"))
