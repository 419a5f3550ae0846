"""Near duplicates among embeddings: spherical k-means cells, blocked cosine products within cells.

Vectors of equal label are linked when their cosine reaches a threshold. Centroids are fitted on a bounded sample;
every vector has the cell of its nearest centroid as home. A link may cross cells, so a vector is also a guest in
near cells: unit vectors x and y with homes c and d satisfy <x, c - d> >= 0 and <y, d - c> >= 0, and these margins
over |c - d| together are at most |x - y|. The lesser is hence at most half the distance that the threshold allows:
with that margin one of the two is a guest at the other's home, whatever the data look like, and no link is lost.
A label that one cell can hold has one cell and no guests, so only large labels pay for copies. Rows of a cell are
dealt over so many tasks as they fill, whatever the number of partitions, so blocks are full and their pairs few.
Homes are compared with homes and guests of their cell in blocks. Each vector carries the list of its cells, so a
link that both homes see is counted in one of them, for both of its ends.
Equal vectors are one entry with a count. Blocks answer with sums and spanning forests, never with all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import fresh_name, local_roots
from motorpool.llm.components import components
from motorpool.llm.vectors import blocks, few_rows_a_batch, kept_type, packed, to_matrix, unpacked, usable
from motorpool.session import settle

COSINE = 0.93
#: Vectors the centroids are fitted on at most.
SAMPLE = 20_000
#: Vectors of one label to a cell that are aimed at, and cells at most.
CELL_ROWS = 2000
MAX_CELLS = 1024
BLOCK_ROWS = 1024
#: Rows of one cell that one task makes blocks of, about.
DEALT_ROWS = 8 * BLOCK_ROWS
#: Cells whose flags one component holds; a float holds as many bits exactly.
FLAGS = 16
#: Links a task gathers before it thins them out to a forest.
PENDING = 200_000


def unit(x: np.ndarray) -> np.ndarray:
    # scaling first keeps very large and very small components finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit vectors; fewer than `k` when there are fewer vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        at = np.concatenate([(x[s : s + 4096] @ c.T).argmax(1) for s in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), c)
    return np.unique(c, axis=0)


def tail(cells: int) -> int:
    """Components behind a vector: its home, and the flags of its cells."""
    return 1 + math.ceil(cells / FLAGS)


def _cells(entries: DataFrame, centroids: np.ndarray, dims: int, cosine: float, share: float) -> DataFrame:
    """(part, id, vector, extra): extra is the entry's count at home, and minus its count as a guest.

    Entries that are not `split` have the first cell for a home and are guests nowhere. Behind its `dims` components a vector has its home and the flags of its cells.
    """
    reach = share * math.sqrt(2 - 2 * cosine) / 2 + 1e-9
    width = dims + tail(len(centroids))
    apart = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = to_matrix(batch.column(2), dims)
            near = unit(raw) @ centroids.T
            split = np.asarray(batch.column(4).to_numpy(zero_copy_only=False), bool)
            home = np.where(split, near.argmax(1), 0)
            guest = near[np.arange(len(raw)), home][:, None] - near <= reach * apart[home]
            guest = np.where(split[:, None], guest, np.arange(len(centroids)) == 0)
            row, cell = np.nonzero(guest)
            label = np.array(batch.column(1).to_pylist(), object)
            part = [f"{a}/{c}" for a, c in zip(label[row], cell)]
            count = batch.column(3).to_numpy()[row]
            flags = np.zeros((len(raw), (width - dims - 1) * FLAGS))
            flags[:, : len(centroids)] = guest
            words = flags.reshape(len(raw), -1, FLAGS) @ 2.0 ** np.arange(FLAGS)
            flat = pa.array(np.column_stack((raw, home, words))[row].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * width, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), batch.column(0).take(pa.array(row)), lists, pa.array(np.where(cell == home[row], count, -count))],
                names=["part", "id", "vector", "extra"],
            )

    own = entries.select("id", F.col("label_key"), "vector", "n", "split")
    return own.mapInArrow(run, "part string, id long, vector array<double>, extra long")


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows shuffled so that a task has about DEALT_ROWS of a part, or the whole part if it is smaller.

    A part of any size is spread by its rows' ids; small ones come whole to one task. The counts have a row a part and
    are settled, so Spark broadcasts them only below its own threshold.
    """
    rows = settle(rows, "cells")
    counts = settle(rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / DEALT_ROWS).cast("int").alias("shares")), "shares")
    share = F.pmod(F.xxhash64("id"), F.col("shares"))
    return rows.join(counts, "part").withColumn("share", share).repartition("part", "share").select("part", "id", "vector", "extra")


def _products(pairs: DataFrame, cosine: float, kind: str, dims: int) -> DataFrame:
    """(id, other, links): a number of links of `id`, and another entry of its component (or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[int, int] = {}
        a, b, held = [], [], 0

        def forest() -> tuple[np.ndarray, np.ndarray]:
            x, y = np.concatenate(a), np.concatenate(b)
            node, at = np.unique(np.r_[x, y], return_inverse=True)
            lab = local_roots(len(node), at[: len(x)], at[len(x) :])
            far = np.flatnonzero(lab != np.arange(len(node)))
            return node[far], node[lab[far]]

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, x, count = unpacked(*row[:3], kind)
                home = count > 0
                if not home.any():
                    continue
                ids, x, count = ids[home], x[home], count[home]
                others, y, weight = unpacked(*row[3:], kind)
                cell, cells = int(x[0, dims]), y[:, dims].astype(np.int64)
                words = x[:, dims + 1 :].astype(np.int64)
                back = words[:, cells // FLAGS] >> (cells % FLAGS) & 1 > 0
                # a link that the other home sees too belongs to the lower of the two
                mine = (cells >= cell) | ~back
                hit = (unit(x[:, :dims]) @ unit(y[:, :dims]).T >= cosine) & (ids[:, None] != others[None]) & mine
                guest = weight < 0
                for who, n in (ids, hit @ np.abs(weight)), (others[guest], count @ hit[:, guest]):
                    for i, own in zip(who.tolist(), n.tolist()):
                        if own:
                            links[i] = links.get(i, 0) + own
                r, c = np.nonzero(hit)
                if len(r):
                    # a forest of this block pair at once, so that dense groups stay small
                    node = np.r_[ids, others]
                    lab = local_roots(len(node), r, len(ids) + c)
                    far = np.flatnonzero(lab != np.arange(len(node)))
                    a.append(node[far])
                    b.append(node[lab[far]])
                    held += len(far)
                if held > PENDING:
                    x, y = forest()
                    a, b, held = [x], [y], 0
        if links:
            keys, values = (np.fromiter(v, np.int64, len(links)) for v in (links.keys(), links.values()))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.int64()), pa.array(values)], names=["id", "other", "links"])
            x, y = forest()
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.zeros(len(x), np.int64))], names=["id", "other", "links"])

    return pairs.mapInArrow(run, "id long, other long, links long")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", column: str = "embedding", label: str = "label", reach: float = 1.0
) -> DataFrame:
    """key, n_links, component_id, kept: one row per row.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do those with a null
    label or of another length than the most common one. Equal vectors of one label link with each other. Null keys
    don't count for component_id, which is null where a component has no other key; a repeated key has a row for
    each of its rows. `kept` is true where the key is the component's smallest.
    """
    hashes = [F.xxhash64("v"), F.xxhash64(F.lit(1), "v")]
    rows = vectors.select(F.col(key).alias("key"), F.col(label).cast("string").alias("label_key"), F.col(column).alias("e"))
    rows = rows.withColumn("ok", usable("e") & F.col("label_key").isNotNull())
    rows = rows.withColumn("v", F.when(F.col("ok"), packed("e"))).drop("e")
    common = rows.where("ok").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common["d"] if common else 1
    rows = rows.withColumn("ok", F.col("ok") & (F.size("v") == dims))
    rows = rows.withColumns({"h1": hashes[0], "h2": hashes[1]})
    entries = rows.where("ok").groupBy("label_key", "h1", "h2").agg(
        F.first("v").alias("vector"), F.min("key").alias("least"), F.count(F.lit(1)).alias("n")
    )
    entries = settle(entries.withColumn("id", F.monotonically_increasing_id()), "entries")
    # one row a label
    sizes = settle(entries.groupBy("label_key").agg(F.count(F.lit(1)).alias("size")), "sizes")
    n = sizes.agg(F.max("size")).first()[0]
    if n:
        sample = entries.orderBy(F.xxhash64("h1", "h2", F.lit("fit"))).limit(SAMPLE).select("vector").toPandas()["vector"]
        fitted = unit(np.stack(sample.to_numpy()).astype(np.float64))
        centroids = spherical_kmeans(fitted, min(MAX_CELLS, math.ceil(n / CELL_ROWS)))
        spread = entries.join(sizes.select("label_key", (F.col("size") > CELL_ROWS).alias("split")), "label_key")
        kind = kept_type(vectors, column)
        width = dims + tail(len(centroids))
        dealt = settle(blocks(_dealt(_cells(spread, centroids, dims, cosine, reach)), width, BLOCK_ROWS, kind), "blocks")
        other = dealt.select("part", *(F.col(c).alias(f"{c}2") for c in ("ids", "vectors", "extra")))
        pairs = dealt.join(other, "part").select("ids", "vectors", "extra", "ids2", "vectors2", "extra2")
        with few_rows_a_batch(vectors.sparkSession, 2 * BLOCK_ROWS * (width * 8 + 16)):
            found = settle(_products(pairs, cosine, kind, dims), "found")
    else:
        found = entries.sparkSession.createDataFrame([], "id long, other long, links long")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    placed = settle(
        entries.select("id", "label_key", "h1", "h2", "least", "n").join(links, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id")),
        "placed",
    )
    least = settle(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    known = placed.join(least, "root").select("label_key", "h1", "h2", "component_id", n_links.alias("n_links"))
    known = settle(known, "known")
    alone = rows.where("NOT ok").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    linked = rows.where("ok").select("key", "label_key", "h1", "h2").join(known, ["label_key", "h1", "h2"])
    out = linked.select("key", "n_links", "component_id").union(alone)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """The rows of `vectors` whose key represents its group."""
    mark = fresh_name(vectors, "kept_key")
    kept = settle(near_vectors(vectors, cosine, key, column, label).where("kept").select(F.col(key).alias(mark)).distinct(), "kept")
    return vectors.join(kept, vectors[key].eqNullSafe(kept[mark]), "left_semi")
