"""Shards of nearly equal bytes by sampled splitters.

Records are ordered by a hash of their text, then by a hash of the row, so equal texts stand side by side. A sample
in which a record's chance grows with its size gives the quantiles of that order; they cut it into many more ranges
than there are shards. Ranges are then measured on all records, and those that hold too much are cut again by a
sample of their own. A text that fills several ranges by itself is cut by the second hash; any other group of equal
texts stays in one range. What cannot be cut, a record that is larger than a range, goes to the emptiest shard,
largest first; all other ranges fill the shards in key order.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.dictionaries import inline_table
from motorpool.llm.common import located, numbered
from motorpool.session import settle

SHARDS = 24
LAW = "bytes"
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 32
#: A range of more than this many times its share of bytes is cut again.
OVERFULL = 2
MAX_ROUNDS = 6
#: Cells of the lookup grid over the first hash: 2 to this power.
GRID_BITS = 12
LOWEST = -(2**63)
ADDED = ("size", "text_crc32", "law", "shard", "slot")


@dataclass(frozen=True)
class Plan:
    """Boundaries and the (range, shard, first slot) of every range; both bounded by the number of ranges."""

    bounds: DataFrame
    places: list[tuple[int, int, int]]


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def record_size(text: str = "text") -> Column:
    return F.octet_length(_body(text)).cast("long") + 8


def _keys(text: str, row: str) -> dict[str, Column]:
    return {"_k1": F.xxhash64(_body(text)), "_k2": F.xxhash64(F.lit("row"), F.col(row))}


def _before(k1: Column, k2: Column) -> Column:
    return (k1 < F.col("_k1")) | ((k1 == F.col("_k1")) & (k2 <= F.col("_k2")))


def with_range(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """`rows` (with _k1, _k2) and the number of boundaries at or below their key.

    The grid has 2^GRID_BITS rows and holds every boundary once, so its broadcast is bounded whatever the data.
    """
    spark = rows.sparkSession
    cells = spark.range(-(2 ** (GRID_BITS - 1)), 2 ** (GRID_BITS - 1)).select(F.col("id").alias("_cell"))
    of = F.shiftright("_k1", 64 - GRID_BITS).alias("_cell")
    held = bounds.groupBy(of).agg(F.collect_list(F.struct("_k1", "_k2")).alias("_here"))
    lower = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<struct<_k1:bigint,_k2:bigint>>")
    grid = (
        cells.join(held, "_cell", "left").withColumn("_here", F.coalesce("_here", none))
        .withColumn("_base", F.coalesce(F.sum(F.size("_here")).over(lower), F.lit(0)))
    )
    passed = F.size(F.filter("_here", lambda b: _before(b["_k1"], b["_k2"])))
    found = rows.withColumn("_cell", of).join(F.broadcast(grid), "_cell")
    return found.withColumn("_range", (F.col("_base") + passed).cast("int")).drop("_cell", "_here", "_base")


def _cuts(rows: DataFrame, crowded: DataFrame, attempt: int) -> DataFrame:
    """New boundaries inside the ranges of `crowded` (_range, _bytes, _pieces), from a size-weighted sample.

    A range gives about SAMPLES_PER_RANGE records a piece, however large it is; each attempt draws others, and
    twice as many.
    """
    rate = F.lit(SAMPLES_PER_RANGE << attempt) * F.col("_pieces") / F.col("_bytes")
    chance = F.least(F.lit(1.0), F.col("_size") * rate)
    draw = F.pmod(F.xxhash64(F.lit(attempt), "_k1", "_k2"), F.lit(2**53)) / F.lit(float(2**53))
    sample = rows.join(F.broadcast(crowded), "_range").where(draw < chance).withColumn("_weight", F.col("_size") / chance)
    order = Window.partitionBy("_range").orderBy("_k1", "_k2")
    upto = F.sum("_weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum("_weight").over(Window.partitionBy("_range"))
    piece = F.floor((upto - F.col("_weight")) * F.col("_pieces") / whole)
    marked = sample.withColumn("_piece", piece).withColumn("_last", F.lag("_piece").over(order))
    # after a heavy record the next one starts a piece too, so the heavy one stands alone
    firsts = marked.where("_last IS NOT NULL AND _piece <> _last").select("_range", "_k1", "_k2").distinct()
    # the first boundary within a text moves to the text's start: only a text with several is cut
    fresh = ~F.lag("_k1").over(order).eqNullSafe(F.col("_k1"))
    return firsts.withColumn("_k2", F.when(fresh, F.lit(LOWEST)).otherwise(F.col("_k2"))).select("_k1", "_k2")


def _measured(rows: DataFrame, bounds: DataFrame) -> list:
    return (
        with_range(rows, bounds).groupBy("_range")
        .agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
             (F.min(F.struct("_k1", "_k2")) == F.max(F.struct("_k1", "_k2"))).alias("one_key"))
        .orderBy("_range").collect()
    )


def _fill(sizes: list, shards: int, large: float) -> list[tuple[int, int, int]]:
    """(range, shard, first slot): ranges above `large` by load, then the others in key order up to one level."""
    loads = [(0, s) for s in range(shards)]
    home: dict[int, int] = {}
    for r in sorted((r for r in sizes if r.bytes > large), key=lambda r: (-r.bytes, r[0])):
        load, s = heapq.heappop(loads)
        home[r[0]] = s
        heapq.heappush(loads, (load + r.bytes, s))
    dealt = dict((s, load) for load, s in loads)
    rest = sum(r.bytes for r in sizes if r[0] not in home)
    low = sorted(dealt.values())
    level = next(
        (top for n in range(shards, 0, -1) if (top := (rest + sum(low[:n])) / n) >= low[n - 1]), low[0] + rest
    )
    edges, total = [], 0.0
    for s in range(shards):
        total += max(0.0, level - dealt[s])
        edges.append(total)
    at, s = 0, 0
    for r in sizes:
        if r[0] not in home:
            while s < shards - 1 and at + r.bytes / 2 > edges[s]:
                s += 1
            home[r[0]] = s
            at += r.bytes
    slots = [0] * shards
    places = []
    for r in sizes:
        s = home[r[0]]
        places.append((r[0], s, slots[s]))
        slots[s] += r.rows
    return places


def plan_shards(rows: DataFrame, shards: int = SHARDS, per_shard: int = RANGES_PER_SHARD) -> Plan:
    """Boundaries and places for settled `rows` (_k1, _k2, _size)."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("_size")).first()[0] or 0
    limit = max(1.0, total / (shards * per_shard))
    bounds = settle(rows.select("_k1", "_k2").limit(0), "bounds")
    crowded = [(0, max(1, total), shards * per_shard)]
    for attempt in range(MAX_ROUNDS):
        table = inline_table(spark, crowded, ("_range", "_bytes", "_pieces"))
        more = settle(bounds.union(_cuts(with_range(rows, bounds), table, attempt)).distinct(), "bounds")
        sizes = _measured(rows, more)
        grown = more.count() > bounds.count()
        bounds = more
        crowded = [
            (r[0], r.bytes, -int(-r.bytes // limit)) for r in sizes if r.bytes > OVERFULL * limit and not r.one_key
        ]
        if not crowded or not grown:
            break
    return Plan(bounds, _fill(sizes, shards, OVERFULL * limit))


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with size, text_crc32, law, shard (0 to shards - 1) and slot (0, 1, ... within the shard).

    Size is the text's UTF-8 bytes plus 8. A null text counts as empty and equals an empty one. Repeated rows are
    records of their own; null keys are allowed. A very long text is a range of its own. An empty input gives no
    rows. Columns of the input that have an added column's name are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    # rows of one place, as behind a join, only tie; so places need no check here
    own, row = located(docs) or numbered(docs, "records")
    narrow = settle(own.select(*[c.alias(n) for n, c in _keys(text, row).items()], record_size(text).alias("_size")), "keys")
    plan = plan_shards(narrow, shards)
    placed = with_range(own.withColumns({**_keys(text, row), "size": record_size(text), "text_crc32": F.crc32(_body(text).cast("binary"))}), plan.bounds)
    order = Window.partitionBy("_range").orderBy("_k1", "_k2", "size", key)
    ranked = placed.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    places = inline_table(spark, plan.places or [(0, 0, 0)], ("_range", "_shard", "_first"))
    out = ranked.join(places, "_range").withColumns({
        "law": F.lit(LAW), "shard": F.col("_shard").cast("int"), "slot": F.col("_first").cast("long") + F.col("_rank"),
    })
    return out.select(*docs.columns, *ADDED)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, in files of one or more ranges each, sorted by slot."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    own = shard(docs.select("doc_id", "text"), shards)
    return own.select("doc_id", *ADDED, F.lit(None).cast("int").alias("grown_shard"))
