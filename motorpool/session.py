"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_scratch: str | None = None
#: Each thread has its own, so that jobs side by side remove their own tables only.
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


def build_session(app: str = "motorpool", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans are written for; extra `conf` entries win.

    Partition counts are left to AQE: it coalesces small shuffles and splits skewed ones, so the same
    plan fits a laptop and a cluster once `spark.sql.shuffle.partitions` is sized for the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a private one only for an unset local session."""
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/") + "/motorpool"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="motorpool-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside once their readers are done, as at the end of a job."""
    made: list[str] = []
    before = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(before)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back.

    Two effects matter: later stages survive the loss of executors without recomputing the lineage
    (and see the same rows), and the planner knows the real size, so it picks a broadcast only below
    `spark.sql.autoBroadcastJoinThreshold` and a shuffle join otherwise.
    """
    return settle_counted(df, label)[0]


def settle_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`settle`, plus the number of rows as counted by the write itself."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation(label)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"] or 0
