"""Vectors as rows: which ones count, and which rows hold the same one."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """True for vectors that are neither null nor zero and hold no null or non-finite component."""
    c = F.col(column).cast("array<double>")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & ~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def packed(column: str) -> Column:
    """The components as doubles, for grouping equal vectors: -0.0 becomes 0.0."""
    return F.transform(F.col(column).cast("array<double>"), lambda x: x + F.lit(0.0))


def to_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow column of lists of `dims` doubles as a matrix."""
    flat = column.flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def first_rows(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first `n` rows of each key; Spark limits each task's rows before it shuffles them."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_number_", F.row_number().over(at)).where(F.col("row_number_") <= n).drop("row_number_")


#: Bytes of blocks that Spark hands to a Python worker at a time.
BATCH_BYTES = 24 << 20


def kept_type(vectors: DataFrame, column: str) -> str:
    """The type that holds the components as they are: float where they are floats, else double."""
    return "<f4" if vectors.schema[column].dataType.simpleString() == "array<float>" else "<f8"


@contextlib.contextmanager
def few_rows_a_batch(spark: SparkSession, row_bytes: int) -> Iterator[None]:
    """Rows of whole blocks are large: let Arrow batches hold few of them while an action runs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(1, BATCH_BYTES // max(1, row_bytes))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


BLOCKS = "part string, ids binary, vectors binary, extra binary"


def blocks(df: DataFrame, dims: int, rows: int, kind: str) -> DataFrame:
    """(part, id long, vector array<double>, extra long) as rows of up to `rows` vectors of one part each, with
    components of type `kind`.

    Sorting is within the tasks' own rows: a part of any size is many blocks, in as many tasks as hold its rows.
    """

    def run(batches):
        names = ["part", "ids", "vectors", "extra"]
        kept: list[tuple] = []
        part = None

        def made():
            ids, vectors, extra = (np.concatenate(x) for x in zip(*kept))
            for s in range(0, len(ids), rows):
                own = [ids[s : s + rows].tobytes(), vectors[s : s + rows].tobytes(), extra[s : s + rows].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([x], pa.binary()) for x in own)], names=names)

        for batch in batches:
            parts = np.array(batch.column(0).to_pylist(), object)
            ids, extra = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            vectors = to_matrix(batch.column(2), dims).astype(kind)
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1), len(parts)] if len(parts) else [0]
            for s, e in zip(edges, edges[1:]):
                if kept and (parts[s] != part or sum(len(k[0]) for k in kept) >= rows):
                    yield from made()
                    kept = []
                part = parts[s]
                kept.append((ids[s:e], vectors[s:e], extra[s:e]))
        if kept:
            yield from made()

    return df.select("part", "id", "vector", F.col("extra").cast("long")).sortWithinPartitions("part").mapInArrow(run, BLOCKS)


def unpacked(ids: bytes, vectors: bytes, extra: bytes, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, kind).reshape(len(ids), -1).astype(np.float64), np.frombuffer(extra, np.int64)
