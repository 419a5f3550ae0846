"""Keyed merge into a stored table, and the record of what it changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.operators.keys import bucket_count, dense_ids
from motorpool.session import settle, settle_counted


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of the keys that stand in more than one row; counted map-side first, so a hot key is no problem."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """A merge source may hold a key once."""
    repeated = repeated_keys(rows, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"merge source repeats key {repeated[0].asDict()}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    *,
    touch: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Full-outer merge: `attributes` come from the source where the key matches, even if NULL.

    Other target columns survive a match unless `touch` sets them; new rows take `on_insert` values.
    One shuffle per side, on the key.
    """
    touch, on_insert = dict(touch or {}), dict(on_insert or {})
    extra = [c for c in target.columns if c not in keys and c not in attributes]
    incoming = source.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in attributes],
        *[F.col(c).alias(f"_new_{c}") for c in extra if c in source.columns],
        F.lit(True).alias("_matched_source"),
    )
    joined = target.withColumn("_matched_target", F.lit(True)).join(incoming, list(keys), "full_outer")
    in_source, in_target = F.col("_matched_source").isNotNull(), F.col("_matched_target").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in attributes:
            return F.when(in_source, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        fresh = on_insert.get(name, F.col(f"_new_{name}") if name in source.columns else F.lit(None))
        kept = F.when(in_source, touch[name]).otherwise(F.col(name)) if name in touch else F.col(name)
        return F.when(in_target, kept).otherwise(fresh).alias(name)

    return joined.select(*[merged(c) for c in target.columns])


def upsert_with_ids(
    target: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    id_column: str,
    highest: int | Callable[[int], int],
    *,
    touch: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, int]:
    """Merge that keeps existing surrogate keys and numbers new rows after `highest`, or what it gives for their number.

    Returns the merged table and the number of new rows. A source that repeats a key is refused; it should
    be settled, since it is read three times. Only the new keys are numbered, and their
    numbers are settled before anything is written, so a task that runs again cannot change them.
    """
    assert_unique(source, [key])
    fresh, inserted = settle_counted(source.select(key).join(target.select(key), key, "left_anti"), "fresh")
    start = highest(inserted) if callable(highest) else highest
    numbered = settle(dense_ids(fresh, key, id_column, start, bucket_count(inserted)), "ids")
    carrying = source.join(numbered, key, "left")
    return upsert(target, carrying, [key], attributes, touch=touch, on_insert=on_insert), inserted


def changes(old: DataFrame, new: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """(key, column, old, new) for every attribute that differs, inserts included."""
    before = old.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in attributes]).alias("_old"))
    after = new.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in attributes]).alias("_new"))
    both = after.join(before, key, "left")
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"_old.{c}").alias("old_value"), F.col(f"_new.{c}").alias("new_value")
        )
        for c in attributes
    ])
    differing = F.filter(pairs, lambda p: ~p["old_value"].eqNullSafe(p["new_value"]))
    action = F.when(F.col("_old").isNull(), "INSERT").otherwise("UPDATE")
    return both.select(key, action.alias("action"), F.inline(differing))


def change_payload(change_rows: DataFrame) -> DataFrame:
    """Changes with one JSON object per change, as an audit table would keep them."""
    body = F.to_json(F.struct("old_value", "new_value"), {"ignoreNullFields": "false"})
    return change_rows.withColumn("payload", body)
