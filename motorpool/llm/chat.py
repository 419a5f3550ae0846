"""Chat logs to training text: snapshots that longer snapshots contain are collapsed, the rest is rendered.

A logger that stores a conversation again after every turn leaves each state as a conversation of its own. Every
turn gets a hash of all turns up to it (two running 64-bit sums of position, role and text under exclusive or);
the hash at the last turn stands for the whole conversation. A conversation whose hash another one has at an
earlier turn is a prefix of that one and goes; of equal conversations the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.session import settle


def _hash(seed: int) -> Column:
    told = [x for c in ("role", "text") for x in (F.col(c).isNull(), F.coalesce(c, F.lit("")))]
    return F.xxhash64(F.lit(seed), "pos", *told)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text, the prefix hashes a and b, and whether the turn is the last.

    Equal rows of one conversation are one turn. Turns of one number stand by role, then text, nulls first.
    """
    own = turns.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string")).distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = own.withColumns({"pos": F.row_number().over(order), "last": F.lead(F.lit(1)).over(order).isNull()})
    hashed = placed.withColumns({"a": _hash(0), "b": _hash(1)})
    return hashed.withColumns({c: F.bit_xor(c).over(upto) for c in ("a", "b")}).drop("turn")


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies of the conversations that no other one continues; `turns` from `ordered_turns`.

    Both sides are made distinct before they meet, so a first turn or a conversation that very many share is one row.
    """
    whole = turns.where("last").groupBy("pos", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    begun = turns.where("NOT last").select("pos", "a", "b").distinct()
    return whole.join(begun, ["pos", "a", "b"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "copies")


def segment() -> Column:
    """One turn as marked-up text. Markers inside a role or text are broken by a space; a null role is `unknown`."""
    body = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    role = F.coalesce("role", F.lit("unknown"))
    for mark, broken in (("<|", "< |"), ("|>", "| >")):
        role = F.replace(role, F.lit(mark), F.lit(broken))
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("<|end|>\n"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies, rendered: one row per conversation that stays.

    Rows with a null conv_id are one conversation; it yields to an equal one that has an id. Null and empty texts
    are turns like any other. An empty input gives no rows. Columns beyond conv_id, turn, role and text are ignored.
    """
    placed = settle(ordered_turns(turns), "turns")
    kept = settle(maximal(placed), "maximal")
    own = placed.select(F.col("conv_id").alias("id"), "pos", segment().alias("segment"))
    texts = own.join(kept.select("conv_id"), F.col("id").eqNullSafe(F.col("conv_id")), "left_semi")
    joined = texts.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("parts"))
    rendered = joined.select("id", F.array_join(F.transform("parts", lambda x: x["segment"]), "").alias("rendered"))
    return kept.join(rendered, F.col("id").eqNullSafe(F.col("conv_id"))).select("conv_id", "n_turns", "copies", "rendered")


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY pos) AS turns,
             string_agg('<|' || replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') || '|>' || chr(10)
                        || replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered
      FROM o GROUP BY conv_id),
p AS (SELECT DISTINCT list_slice(turns, 1, k) AS pre FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM c))
SELECT min(conv_id) AS conv_id, CAST(n_turns AS INTEGER) AS n_turns, count(*) AS copies, rendered
FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pre = c.turns)
GROUP BY n_turns, turns, rendered
"""
