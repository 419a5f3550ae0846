"""Neighbour search and near duplicates of vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.llm import near_vectors, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_rows():
    inf, nan = float("inf"), float("nan")
    return [(9000, None, 1), (9100, [0.0] * 6, 1), (9200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (9300, [inf] * 6, 1), (9400, [nan] * 6, 1), (9500, [1.0, 2.0], 1), (9600, [], 1)]


def cloud(n, seed=0, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + 0.25 * rng.normal(size=(n, dims))
    x[n // 2 : n // 2 + 40] = x[0]
    x[n // 2 + 40 : n // 2 + 80] = x[0] + 0.001 * rng.normal(size=(40, dims))
    return x.astype(np.float32)


@pytest.mark.parametrize("n, parts", [(1500, 16), (30, 32), (1, 4)])
def test_neighbours(spark, monkeypatch, n, parts):
    monkeypatch.setattr(neighbours, "PARTS", parts)
    monkeypatch.setattr(neighbours, "BASE_ROWS", 64)
    x = cloud(max(n, 200))[:n]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + odd_rows() + [(None, [1.0] * 6, 0)] + [(0, x[0].tolist(), 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit(1), "keys": F.lit(2), "id": F.lit(3), "vector": F.lit(4)}).repartition(4)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    own = x.astype(np.float64)
    hit = total = 0
    for i in range(0, n, 20):
        d = np.sqrt(((own - own[i]) ** 2).sum(1))
        d[i] = np.inf
        order = np.lexsort((np.arange(n), d))[: min(10, n - 1)]
        found = got.get(i, {})
        assert sorted(found) == list(range(1, len(order) + 1)), (i, found)
        hit += len({v for v, _ in found.values()} & set(order.tolist()))
        total += len(order)
        assert all(abs(d[v] - s) < 1e-12 for v, s in found.values())
        values = [(s, v) for _, (v, s) in sorted(found.items())]
        assert values == sorted(values)
    assert total == 0 or hit / total >= 0.9
    if n > 1000:
        assert [v for _, (v, _) in sorted(got[0].items())] == list(range(n // 2, n // 2 + 10))


def test_parts_are_balanced():
    graph = neighbours.neighbour_graph(cloud(800).astype(np.float64), 8)
    size = np.bincount(neighbours.balanced_parts(graph, 10), minlength=10)
    assert size.sum() == 800 and size.max() <= neighbours.SLACK * 80 + 1


def brute(rows, cosine):
    x = [None if v is None or not v or len(v) != 6 or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.array(v, np.float64) for _, v, _ in rows]
    unit = [None if v is None else v / np.linalg.norm(v) for v in x]
    n = len(rows)
    link = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= cosine:
                link[i].append(j)
    comp = list(range(n))
    out = [None] * n
    for i in range(n):
        if out[i] is None:
            todo, members = [i], {i}
            while todo:
                for j in link[todo.pop()]:
                    if j not in members:
                        members.add(j)
                        todo.append(j)
            least = min((rows[m][0] for m in members if rows[m][0] is not None), default=None)
            for m in members:
                out[m] = least
    return sorted(((rows[i][0], len(link[i]), out[i], rows[i][0] == out[i]) for i in comp), key=repr)


@pytest.mark.parametrize("cell_rows, block", [(2000, 1024), (25, 16)])
def test_near_vectors(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(near_vectors, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_vectors, "PENDING", 100)
    x = cloud(400, 3)
    rows = [(i, v.tolist(), None if i % 17 == 0 else i % 2) for i, v in enumerate(x)] + odd_rows() + [(None, x[1].tolist(), 1), (1, x[1].tolist(), 1), (2, (x[3] * 2).tolist(), 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "id": F.lit(2), "root": F.lit(3), "key": F.lit(4)}).repartition(4)
    got = near_vectors.near_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == brute(rows, 0.93)
    kept = near_vectors.keep_one(df)
    assert kept.columns == df.columns and {r.vec_id for r in kept.collect()} == {r.vec_id for r in got if r.kept}


def test_links_across_cells_of_low_rank_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "CELL_ROWS", 100)
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 64)) + 0.05 * rng.normal(size=(3000, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA).repartition(4)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    cosines = unit @ unit.T
    assert np.abs(cosines - 0.93).min() > 1e-12
    expected = ((cosines >= 0.93).sum(axis=1) - 1).tolist()
    got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(df).collect()}
    assert [got[i] for i in range(len(x))] == expected


def test_blocks_do_not_grow_with_partitions(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "DEALT_ROWS", 200)
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 4)).alias("part"), "id",
        F.array(F.lit(1.0), F.col("id").cast("double")).alias("vector"), F.lit(1).cast("long").alias("extra"),
    ).repartition(60)
    found = near_vectors.blocks(near_vectors._dealt(rows), 2, 100, "<f8").collect()
    assert sorted(i for r in found for i in np.frombuffer(bytes(r.ids), np.int64)) == list(range(3000))
    # each share of a part ends in at most one block that is not full
    assert len(found) <= sum(-(-n // 100) + -(-n // 200) for n in (2000, 250, 250, 250, 250))


def test_large_and_small_labels_together(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "CELL_ROWS", 60)
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 16)
    monkeypatch.setattr(near_vectors, "DEALT_ROWS", 40)
    rows = [(i, v.tolist(), 0 if i % 3 else 1 + i % 7) for i, v in enumerate(cloud(600, 3))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    got = near_vectors.near_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == brute(rows, 0.93)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_vectors.near_vectors(df).count() == 0
    assert neighbours.nearest(df, F.col("vec_id") % 20 == 0).count() == 0
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    rows = near_vectors.near_vectors(odd.where("vec_id < 9500")).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows} == {(v, 0, v, True) for v in (9000, 9100, 9200, 9300, 9400)}
