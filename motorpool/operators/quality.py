"""Data-quality reports in long form: one row per check or column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.functions.numbers import lenient_double
from motorpool.schemas import INPUT_COLUMNS
from motorpool.session import settle

#: Digests compared in a reconciliation.
BUCKETS = 4096


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a NULL key counts as an orphan."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _long(one_row: DataFrame, key: str = "check_name", value: str = "n") -> DataFrame:
    entries = F.map_from_arrays(
        F.array(*[F.lit(c) for c in one_row.columns]),
        F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in one_row.columns]),
    )
    return one_row.select(F.explode(entries).alias(key, value))


def conditions_report(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All conditions counted in one pass; (check_name, n)."""
    counted = rows.agg(F.count(F.lit(1)).alias("rows"), *[_count(c).alias(n) for n, c in checks.items()])
    return _long(counted)


def surplus_rows(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of each key as one check row, counted map-side first."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _long(groups.agg(F.sum(F.col("_n") - 1).alias(name)))


def conditions_and_repeats(rows: DataFrame, checks: Mapping[str, Column], keys: Sequence[str], name: str) -> DataFrame:
    """`conditions_report` and `surplus_rows` from one scan: the conditions are sums within the groups of `keys`."""
    counts = {f"_{i}": n for i, n in enumerate(checks)}
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[_count(c).alias(f"_{i}") for i, c in enumerate(checks.values())]
    )
    return _long(groups.agg(
        F.sum("_n").alias("rows"), *[F.sum(c).alias(n) for c, n in counts.items()], F.sum(F.col("_n") - 1).alias(name)
    ))


def raw_report(raw: DataFrame) -> DataFrame:
    """Missing required fields, unreadable numbers and repeated rows of the raw layer."""
    year, count = (lenient_double(F.col(c)) for c in INPUT_COLUMNS[2:])
    checks = {f"null_{c}": F.col(c).isNull() for c in INPUT_COLUMNS}
    checks["bad_ano"] = F.col(INPUT_COLUMNS[2]).isNotNull() & year.isNull()
    checks["bad_qtd"] = F.col(INPUT_COLUMNS[3]).isNotNull() & count.isNull()
    return conditions_and_repeats(raw, checks, ["report_period", *INPUT_COLUMNS], "duplicate_rows")


def norm_report(hashed: DataFrame) -> DataFrame:
    """Hash present, required fields filled, rows that share period, hash and state."""
    checks = {
        "null_hash": F.col("hash_veiculo").isNull(),
        "blank_marca": F.coalesce(F.trim("marca") == "", F.lit(True)),
        "blank_modelo": F.coalesce(F.trim("modelo") == "", F.lit(True)),
        "null_uf": F.col("uf").isNull(),
    }
    return conditions_and_repeats(hashed, checks, ["report_period", "hash_veiculo", "uf"], "shared_cell_rows")


def integrity_report(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Orphan facts, vehicles without facts, missing and repeated hashes."""
    parts = [
        _long(orphans(fact, dim, ["id_veiculo"]).agg(F.count(F.lit(1)).alias("orphan_facts"))),
        _long(orphans(dim, fact, ["id_veiculo"]).agg(F.count(F.lit(1)).alias("vehicles_without_fact"))),
        _long(dim.agg(F.count(F.lit(1)).alias("vehicles"), _count(F.col("hash_veiculo").isNull()).alias("null_hash"))),
        surplus_rows(dim, ["hash_veiculo"], "duplicate_hash"),
        surplus_rows(fact, ["report_period", "id_veiculo", "uf"], "duplicate_cell"),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def profile(rows: DataFrame) -> DataFrame:
    """Per column: rows, NULLs and completeness in hundredths of a percent, in one pass."""
    nulls = [_count(F.col(c).isNull()).alias(c) for c in rows.columns]
    counted = rows.agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    entries = F.map_from_arrays(
        F.array(*[F.lit(c) for c in rows.columns]), F.array(*[F.col(c) for c in rows.columns])
    )
    long = counted.select(F.col("_rows").alias("records"), F.explode(entries).alias("column_name", "nulls"))
    filled = F.expr("((records - nulls) * 10000) div records")
    return long.withColumn("completeness_bp", filled)


def value_profile(rows: DataFrame, column: str) -> DataFrame:
    """Frequency and share (hundredths of a percent) of every value of a column."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("_total", total).select("value", "n", F.expr("(n * 10000) div _total").alias("share_bp"))


def uniqueness_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations, repeated combinations and the rows inside repeated ones."""
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("records"),
        F.count(F.lit(1)).alias("distinct_rows"),
        _count(F.col("n") > 1).alias("repeated_combinations"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_records"),
    )


def hash_collisions(hashed: DataFrame, parts: Sequence[str], key: str = "hash_veiculo") -> DataFrame:
    """Hashes that stand for more than one combination of their parts, and how many each stands for."""
    combinations = hashed.select(key, *parts).distinct()
    counted = combinations.groupBy(key).agg(F.count(F.lit(1)).alias("combinations"))
    return counted.where(F.col("combinations") > 1)


def _digests(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """(bucket, keys, first, second): distinct keys of each bucket, by 128 bits of hash, and the sums without carry of
    these bits. Equal sets have equal digests whatever their order."""
    bits = rows.where(F.col(key).isNotNull()).select(
        F.xxhash64(key).alias("_first"), F.xxhash64(F.lit("second"), F.col(key)).alias("_second")
    )
    return bits.distinct().groupBy(F.pmod("_first", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("keys"), F.bit_xor("_first").alias("first"), F.bit_xor("_second").alias("second")
    )


def compare_digests(staged: DataFrame, stored: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, keys, same) for every bucket that holds keys; `same` where both sides hold the same keys."""
    left, right = _digests(staged, key, buckets), _digests(stored, key, buckets)
    right = right.toDF("bucket", "_keys", "_first", "_second")
    equal = (F.col("keys") == F.col("_keys")) & (F.col("first") == F.col("_first")) & (F.col("second") == F.col("_second"))
    return left.join(right, "bucket", "full_outer").select("bucket", "keys", F.coalesce(equal, F.lit(False)).alias("same"))


def reconcile(staged: DataFrame, stored: DataFrame, key: str = "hash_veiculo", buckets: int = BUCKETS) -> DataFrame:
    """Distinct keys on both sides, on one side only; (check_name, n). A NULL key has no counterpart.

    Buckets of keys are compared by their digests first; keys themselves are shuffled and joined only for buckets
    that differ, and for NULL. Neither side needs to be distinct.
    """
    compared = settle(compare_digests(staged, stored, key, buckets), "digests")
    differing = compared.where(~F.col("same")).select(F.col("bucket").alias("_bucket"))

    def rest(rows: DataFrame, flag: str) -> DataFrame:
        keys = rows.select(key)
        # at most `buckets` rows, hence the broadcast
        at = keys.join(F.broadcast(differing), F.pmod(F.xxhash64(key), F.lit(buckets)) == F.col("_bucket"), "left_semi")
        return at.where(F.col(key).isNotNull()).union(keys.where(F.col(key).isNull())).distinct().withColumn(flag, F.lit(True))

    both = rest(staged, "_staged").join(rest(stored, "_stored"), key, "full_outer")
    in_staged, in_stored = F.col("_staged").isNotNull(), F.col("_stored").isNotNull()
    joined = both.agg(
        _count(in_staged).alias("staged"),
        _count(in_stored).alias("stored"),
        _count(in_staged & in_stored).alias("in_both"),
        _count(in_staged & ~in_stored).alias("only_staged"),
        _count(in_stored & ~in_staged).alias("only_stored"),
    )
    agreed = compared.where("same").agg(F.coalesce(F.sum("keys"), F.lit(0)).alias("_agreed"))
    total = joined.withColumn("_agreed", agreed.scalar())
    return _long(total.select(
        *[(F.col(c) + F.col("_agreed")).alias(c) for c in ("staged", "stored", "in_both")], "only_staged", "only_stored"
    ))
