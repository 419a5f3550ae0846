"""Surrogate keys and file-order record numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.session import settle, settle_counted

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 65_536
#: Where a record stands: file, its name as part of a URL, split of the file, order within the split.
PLACE = ("_file", "_name", "_block", "_row")


def bucket_count(rows: int) -> int:
    """Buckets for `rows` keys: even tasks, and never more buckets than one task can add up.

    Beyond MAX_BUCKETS times ROWS_PER_BUCKET keys (16 billion) buckets grow, and with them the sort of a task.
    """
    return max(8, min(MAX_BUCKETS, rows // ROWS_PER_BUCKET))


def _running_start(counts: DataFrame, order: list[str], total: str) -> DataFrame:
    """Exclusive running sum over a small table of counts (one row per bucket or file split)."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum(total).over(before), F.lit(0)))


def dense_ids(rows: DataFrame, key: str, name: str, start: int = 0, buckets: int = 4096) -> DataFrame:
    """Add `name`: start+1, start+2, ... over rows whose `key` is unique and whose content is settled.

    Rows are numbered inside hash buckets of the key, and each bucket starts after the sizes of the
    ones before it. The keys are unique, so buckets are even whatever the data looks like, and the
    numbers depend on the keys alone: a task that runs again gives the same ones.
    """
    if buckets > MAX_BUCKETS:
        raise ValueError(f"at most {MAX_BUCKETS} buckets")
    bucket: Column = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    tagged = rows.withColumn("_bucket", bucket)
    sizes = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    starts = _running_start(sizes, ["_bucket"], "_size").select("_bucket", "start")
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    # At most MAX_BUCKETS rows of two numbers, so the broadcast is bounded by construction.
    numbered = tagged.withColumn("_position", position).join(F.broadcast(starts), "_bucket")
    number = F.col("_position") + F.col("start") + F.lit(start)
    return numbered.withColumn(name, number.cast("bigint")).drop("_bucket", "_position", "start")


def number_records(*scans: DataFrame) -> tuple[DataFrame, int]:
    """Add file-order numbers to file scans of the same columns, and count their records.

    `file_row` counts within a file, `record` across all files by path, both from 0. A scan may bring the columns
    PLACE itself; its `_row` then has to count without gaps within a file's split.

    The scans are settled first, so split boundaries and numbers come from one and the same read. A
    split then needs only its own first row id and the number of records in front of it.
    """
    columns = [c for c in scans[0].columns if c not in PLACE]
    tagged = None
    for scan in scans:
        located = scan.select(*columns, *PLACE) if PLACE[0] in scan.columns else scan.select(
            *columns,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_name").alias("_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        tagged = located if tagged is None else tagged.unionByName(located)
    stored, total = settle_counted(tagged, "records")
    splits = stored.groupBy("_file", "_name", "_block").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first")
    )
    # Two levels: files are summed first, so the one running sum without a partition sees a row per file.
    per_file = splits.groupBy("_file").agg(F.sum("_size").alias("_size"))
    file_starts = _running_start(per_file, ["_file"], "_size").select("_file", F.col("start").alias("_before"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("file_start", F.coalesce(F.sum("_size").over(in_file), F.lit(0)))
    starts = starts.join(file_starts, "_file").withColumn("start", F.col("_before") + F.col("file_start"))
    # One row per split; settled, so the planner broadcasts it only if it is small enough. A split is
    # at most maxPartitionBytes of text, so the shuffle join beyond that has even keys.
    # The file's name is decoded here too: Spark gives it as part of a URL, where a plus sign stands for itself.
    name = F.url_decode(F.replace("_name", F.lit("+"), F.lit("%2B"))).alias("source_file")
    starts = settle(starts.select("_file", "_block", "_first", "start", "file_start", name), "splits")
    numbered = stored.join(starts, ["_file", "_block"])
    offset = F.col("_row") - F.col("_first")
    result = numbered.select(
        *columns,
        "source_file",
        (F.col("file_start") + offset).alias("file_row"),
        (F.col("start") + offset).alias("record"),
    )
    return result, total
