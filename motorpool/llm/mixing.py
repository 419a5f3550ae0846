"""Mixing sources by temperature: weights are token shares raised to an exponent and normalised.

The exponent is bisected (many sections at a time, each round one aggregation over the sources) to meet a target
entropy or a limit on how often any source repeats. The weights are then realised as block permutations: a
source's documents fall into blocks by hash, a pass is the blocks in an order of its own, and a source that is
due 2.3 passes gets two whole ones and the first blocks of a third, cut inside the last block to stay within budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.llm.common import fresh_name
from motorpool.session import settle

BYTES_PER_TOKEN = 4
BLOCK_TOKENS = 250_000
#: Most often a source may be read.
REPEATS = 1.5
SECTIONS = 64
SECTION_ROUNDS = 4


def token_estimate(text: str = "text") -> Column:
    """Tokens of a text, estimated from its bytes; 0 for null and empty texts."""
    return F.coalesce(F.ceil(F.octet_length(text) / BYTES_PER_TOKEN), F.lit(0)).cast("long")


def _curve(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent: the entropy of the weights, and the repeats of the smallest source when the largest is
    read once."""
    p = F.col("tokens") / F.col("largest")
    grid = sources.select(p.alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    power = F.pow("p", "a")
    rows = grid.groupBy("a").agg(
        F.sum(power).alias("s"), F.sum(power * F.log("p")).alias("l"), F.max(F.pow("p", F.col("a") - 1)).alias("most")
    )
    return {r["a"]: (math.log(r["s"]) - r["a"] * r["l"] / r["s"], r["most"]) for r in rows.collect()}


def exponent(sources: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None) -> float:
    """The exponent in [0, 1]: the smallest that keeps repeats within the limit, or the largest that reaches the
    entropy (nats). 0 weighs all sources alike, 1 leaves them as they are; both ends are taken where the target
    lies beyond them. `sources` holds (tokens, largest), all above 0."""

    def low_enough(point: tuple[float, float]) -> bool:
        return point[1] <= repeats * (1 + 1e-12) if entropy is None else point[0] < entropy

    low, high = 0.0, 1.0
    for _ in range(SECTION_ROUNDS):
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        curve = _curve(sources, grid)
        if not curve:
            return 1.0
        good = [a for a in grid if low_enough(curve[a])]
        high = good[0] if good else high
        low = max([a for a in grid if a < high], default=low)
        if not good or high == 0.0:
            break
    return high if entropy is None else (low if good else 1.0)


def mix(
    docs: DataFrame,
    repeats: float | None = REPEATS,
    entropy: float | None = None,
    budget: float | None = None,
    tokens: Column | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> tuple[DataFrame, dict[str, str]]:
    """`docs` drawn by source weights, and the names of the columns added.

    `budget` is the number of tokens to draw in all; left out, it is the least at which the largest source is read
    once, so nothing is left out. Added: tokens, weight (of the source), passes (how often the source is due),
    epoch (from 0), block, and block_order (blocks of an epoch are read in this order).
    A null source is a source of its own. Documents without tokens weigh nothing and come once. Equal rows fall
    into one block and are drawn alike. An empty input gives no rows.
    """
    if "source" not in docs.columns:
        raise ValueError("documents need a column source")
    added = ("tokens", "weight", "passes", "epoch", "block", "block_order")
    helpers = ("due", "mix_key", "mix_hash", "blocks", "more", "last_hash")
    names = {x: fresh_name(docs, x) for x in added + helpers}
    due, key, own_hash, block, blocks, more_at, last = (names[x] for x in ("due", "mix_key", "mix_hash", "block", "blocks", "more", "last_hash"))
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    identity = [c for c in ("doc_id", "text") if c in docs.columns]
    sized = docs.withColumns({
        names["tokens"]: token_estimate() if tokens is None else tokens, key: source,
        own_hash: F.xxhash64(*identity, F.lit("mix")),
    })
    size = F.col(names["tokens"])
    sums = settle(
        sized.groupBy(F.col(key).alias("k")).agg(F.sum(size).alias("tokens")).where("tokens > 0"), "sources"
    )
    largest = sums.agg(F.max("tokens")).first()[0]
    own = sums.withColumn("largest", F.lit(largest or 1).cast("double"))
    a = exponent(own, repeats, entropy)
    power = F.pow(F.col("tokens") / F.col("largest"), F.lit(a))
    total = own.agg(F.sum(power)).first()[0] or 1.0
    drawn = budget if budget is not None else total * float(largest or 0)
    # the largest source has power 1, so this budget reads it exactly once
    weighed = settle(
        own.select("k", "tokens", (power / total).alias("weight"))
        .withColumn("passes", F.when(F.abs(F.col("weight") * drawn / F.col("tokens") - 1) < 1e-9, 1.0).otherwise(F.col("weight") * drawn / F.col("tokens")))
        .withColumn("whole", F.floor("passes"))
        .withColumn("left", F.floor((F.col("passes") - F.col("whole")) * F.col("tokens")))
        .withColumn("blocks", F.ceil(F.col("tokens") / block_tokens)),
        "weighed",
    )
    # how the unfinished pass of each source ends: whole blocks, then a hash bound inside one block
    number = F.pmod(F.col("h"), F.col("blocks"))
    light = sized.select(F.col(key).alias("k"), F.col(own_hash).alias("h"), size.alias("n"))
    placed = light.join(weighed, "k").withColumn("b", number)
    turn = F.xxhash64("k", "b", "e")
    before = Window.partitionBy("k").orderBy("turn", "b").rowsBetween(Window.unboundedPreceding, -1)
    ends = settle(
        placed.groupBy("k", "b", F.col("whole").alias("e"), "left").agg(F.sum("n").alias("n"))
        .withColumn("turn", turn).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where("before < left").select("k", "b", "n", (F.col("left") - F.col("before")).alias("room")),
        "ends",
    )
    cut = ends.where("room < n").select("k", "b", "room")
    inside = placed.select("k", "b", "h", "n").join(cut, ["k", "b"]).groupBy("k", "b", "room", "h").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("k", "b").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    bound = settle(
        inside.withColumn("upto", F.sum("n").over(upto)).where("upto <= room").groupBy("k", "b").agg(F.max("h").alias("last")), "bound"
    )
    extra = settle(
        ends.join(bound, ["k", "b"], "left").where("room >= n OR last IS NOT NULL")
        .select("k", "b", F.when(F.col("room") < F.col("n"), F.col("last")).alias("last")),
        "extra",
    )
    shares = weighed.select(
        F.col("k").alias(key), F.col("weight").alias(names["weight"]), F.col("passes").alias(names["passes"]),
        F.col("whole").alias(due), F.col("blocks").alias(blocks),
    )
    more = extra.select(F.col("k").alias(key), F.col("b").alias(block), F.col("last").alias(last), F.lit(1).alias(more_at))
    out = sized.join(shares, key, "left").withColumn(block, F.pmod(F.col(own_hash), F.col(blocks))).join(more, [key, block], "left")
    within = F.col(more_at).isNotNull() & (F.col(last).isNull() | (F.col(own_hash) <= F.col(last)))
    extra_pass = F.when(within, 1).otherwise(0)
    times = F.when(F.col(due).isNull() | (size == 0), 1).otherwise(F.col(due) + extra_pass).cast("int")
    out = out.withColumn(due, times).where(F.col(due) > 0)
    out = out.withColumn(names["epoch"], F.explode(F.sequence(F.lit(0), F.col(due) - 1)))
    out = out.withColumn(names["block_order"], F.xxhash64(key, block, F.col(names["epoch"]).cast("long")))
    return out.select(*docs.columns, *(names[x] for x in added)), {x: names[x] for x in added}
