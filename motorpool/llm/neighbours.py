"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts, so that near vectors share a part; a small
network then learns to tell a vector's part from its components. Every vector is stored under its most probable
part; a query visits the most probable parts, and all vectors there are reranked by exact distance. How many
parts a query visits is read off the sample: as many as hold the wanted share of true neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.vectors import blocks, few_rows_a_batch, first_rows, kept_type, packed, to_matrix, unpacked, usable
from motorpool.session import settle

NEAREST = 10
#: Vectors the index is fitted on at most.
SAMPLE = 10_000
PARTS = 32
GRAPH_NEIGHBOURS = 10
#: Share of true neighbours in the sample that the visited parts must hold.
AIM = 0.98
SLACK = 1.1
HIDDEN = 128
BASE_ROWS = 1024
QUERY_ROWS = 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows."""
    k = min(k, len(x) - 1)
    size = (x**2).sum(1)
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 1024):
        d = size[None] - 2 * (x[s : s + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out[s : s + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Part of each node: grown from seeds along links, then moved to where most of its neighbours are, both
    within a size limit."""
    n = len(graph)
    rng = np.random.default_rng(seed)
    limit = math.ceil(SLACK * n / parts)
    links: list[list[int]] = [list(r) for r in graph.tolist()]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            links[j].append(i)
    part = [-1] * n
    size = [0] * parts
    todo = iter(rng.permutation(n).tolist())
    # one region after the other: each takes n / parts nodes, nearest in the graph first
    for p in range(parts):
        want = (n * (p + 1)) // parts - (n * p) // parts
        front: list[int] = []
        at = 0
        while size[p] < want:
            if at >= len(front):
                start = next((i for i in todo if part[i] < 0), None)
                if start is None:
                    break
                front.append(start)
                part[start] = p
                size[p] += 1
                continue
            for j in links[front[at]]:
                if part[j] < 0 and size[p] < want:
                    part[j] = p
                    size[p] += 1
                    front.append(j)
            at += 1
    for i in range(n):
        if part[i] < 0:
            part[i] = int(np.argmin(size))
            size[part[i]] += 1
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n).tolist():
            votes: dict[int, int] = {}
            for j in links[i]:
                votes[part[j]] = votes.get(part[j], 0) + 1
            best = max(votes, key=lambda p: (votes[p], -p), default=part[i])
            if best != part[i] and votes[best] > votes.get(part[i], 0) and size[best] < limit:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return np.array(part)


class Classifier:
    """One hidden layer, trained by Adam on cross entropy."""

    def __init__(self, dims: int, parts: int, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.shift, self.scale = np.zeros(dims), np.ones(dims)
        self.w = [rng.normal(0, math.sqrt(2 / dims), (dims, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.shift) / self.scale) @ self.w[0] + self.w[1], 0)
        return h @ self.w[2] + self.w[3]

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 25, seed: int = 0) -> Classifier:
        rng = np.random.default_rng(seed)
        self.shift, self.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
        x = (x - self.shift) / self.scale
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(x), 256):
                own = order[s : s + 256]
                h = np.maximum(x[own] @ self.w[0] + self.w[1], 0)
                z = h @ self.w[2] + self.w[3]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(own)), y[own]] -= 1
                p /= len(own)
                back = (p @ self.w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((x[own].T @ back, back.sum(0), h.T @ p, p.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self


def fit(x: np.ndarray, parts: int = PARTS) -> tuple[Classifier, int]:
    """The classifier, and how many parts a query visits."""
    parts = max(1, min(parts, len(x) // 50))
    model = Classifier(x.shape[1], parts)
    if parts == 1:
        return model, 1
    graph = neighbour_graph(x, GRAPH_NEIGHBOURS)
    model.fit(x, balanced_parts(graph, parts))
    ranked = model.ranked(x)
    home = ranked[:, 0]
    # position of each true neighbour's part among the parts of the row that asks
    place = np.argsort(ranked, axis=1)[np.arange(len(x))[:, None], home[graph]]
    held = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    return model, int(np.searchsorted(held, AIM) + 1)


def _dealt(entries: DataFrame, model: Classifier, dims: int, visits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch.column(1), dims)
            part = model.ranked(x)[:, :visits]
            row = np.repeat(np.arange(len(x)), part.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.ravel().astype(str)), *(batch.column(c).take(pa.array(row)) for c in range(3))], names=["part", "id", "vector", "extra"]
            )

    return entries.select("id", "vector", F.lit(0).cast("long").alias("extra")).mapInArrow(run, "part string, id long, vector array<double>, extra long")


def _reranked(pairs: DataFrame, k: int, kind: str) -> DataFrame:
    """(query, id, distance): the nearest entries of each pair of blocks, at most k for a query and task but for ties."""

    def best(query: np.ndarray, entry: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((distance, query))
        query, entry, distance = query[order], entry[order], distance[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        size = np.diff(np.r_[first, len(query)])
        # ties with the k-th stay: which of them counts is decided by their keys
        last = distance[first + np.minimum(size, k) - 1]
        keep = distance <= np.repeat(last, size)
        return query[keep], entry[keep], distance[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, x, _ = unpacked(*row[:3], kind)
                asks, q, _ = unpacked(*row[3:], kind)
                d = np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * (q @ x.T), 0)
                kth = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
                # room for the rounding of this form; the exact one decides
                room = 1e-9 * ((q**2).sum(1) + (x**2).sum(1).max())
                r, c = np.nonzero(d <= (kth + room)[:, None])
                exact = np.sqrt(((q[r] - x[c]) ** 2).sum(1))
                held.append(best(asks[r], ids[c], exact))
                rows += len(held[-1][0])
                if rows > 500_000:
                    held = [best(*(np.concatenate(x) for x in zip(*held)))]
                    rows = len(held[0][0])
        if held:
            out = best(*(np.concatenate(x) for x in zip(*held)))
            for s in range(0, len(out[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[s : s + 50_000]) for x in out], names=["query", "id", "distance"])

    return pairs.mapInArrow(run, "query long, id long, distance double")


def nearest(vectors: DataFrame, is_query, k: int = NEAREST, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row where `is_query` holds.

    Nearness is Euclidean distance in double precision, ties go to the smaller key. Rows with a null key, and
    vectors that are null, zero, hold null or non-finite components, or have another length than the most common
    one, take no part. A row is its key: rows that repeat both key and vector count once. Equal vectors are one
    entry with its k + 1 smallest keys, which is all that any answer can use.
    """
    rows = vectors.where(usable(column) & F.col(key).isNotNull()).select(F.col(key).alias("key"), is_query.alias("asks"), packed(column).alias("vector"))
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common["d"] if common else 1
    rows = rows.where(F.size("vector") == dims)
    spark = vectors.sparkSession
    keys = first_rows(rows.select("h1", "h2", "key").distinct(), ["h1", "h2"], ["key"], k + 1)
    listed = keys.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    shape = rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    entries = settle(shape.join(listed, ["h1", "h2"]).withColumn("id", F.monotonically_increasing_id()), "entries")
    n = entries.count()
    asking = rows.where("asks").select(F.col("key").alias("query_id"), "h1", "h2").distinct()
    asked = settle(asking.join(entries.select("h1", "h2", F.col("id").alias("query")), ["h1", "h2"]), "asked")
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("h1", "h2", F.lit("fit"))).limit(SAMPLE).select("vector").toPandas()["vector"]
    model, visits = fit(np.stack(sample.to_numpy()).astype(np.float64))
    kind = kept_type(vectors, column)
    base = settle(blocks(_dealt(entries, model, dims, 1), dims, BASE_ROWS, kind), "base")
    asking = _dealt(entries.where("asks"), model, dims, visits)
    queries = settle(blocks(asking, dims, QUERY_ROWS, kind), "queries").select("part", *(F.col(c).alias(f"{c}2") for c in ("ids", "vectors", "extra")))
    pairs = base.join(queries, "part").select("ids", "vectors", "extra", "ids2", "vectors2", "extra2")
    # an entry has at least one key, so the k + 1 nearest entries hold the k nearest other keys
    with few_rows_a_batch(spark, (BASE_ROWS + QUERY_ROWS) * (dims * 8 + 16)):
        ranked = settle(_reranked(pairs, k + 1, kind), "ranked")
    near = first_rows(ranked.join(entries.select("id", F.col("keys")[0].alias("least")), "id"), ["query"], ["distance", "least"], k + 1)
    spread = near.join(entries.select("id", "keys"), "id").select("query", "distance", F.explode("keys").alias("vec_id"))
    short = first_rows(spread, ["query"], ["distance", "vec_id"], k + 1)
    answers = settle(short.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "vec_id"))).alias("near")), "answers")
    # without the row itself, in order: places after it move up by one
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.join(answers, "query").select("query_id", F.posexplode(others).alias("pos", "x"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.distance").alias("score"))
    )
