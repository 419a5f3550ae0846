"""What the operators share: tables, row ids, texts as bytes, small numeric helpers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.session import settle

#: Rough bytes of text one step of a Python loop works on.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until no column has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """`df` stored with a unique long per row, and that column's name.

    Ids are drawn once, at the write; a lost executor cannot change them afterwards.
    """
    name = fresh_name(df, "row_id")
    return settle(df.withColumn(name, F.monotonically_increasing_id()), label), name


def located(df: DataFrame) -> tuple[DataFrame, str] | None:
    """`df` with each row's place in its file as an id, and that column's name; None if it is no scan of files.

    It spares the copy that `numbered` makes. Behind a join or union places may repeat: the caller has to check.
    """
    name = fresh_name(df, "row_id")
    try:
        return df.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))), name
    except AnalysisException:
        return None


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as bytes, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def doc_groups(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows holding about `limit` bytes each; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or b"")
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def local_roots(n: int, a: np.ndarray, b: np.ndarray, lab: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each node's component, for nodes 0..n-1 and links a-b, starting from labels `lab`."""
    lab = np.arange(n) if lab is None else lab
    while True:
        x, y = lab[a], lab[b]
        if (x == y).all():
            return lab
        low = np.minimum(x, y)
        np.minimum.at(lab, x, low)
        np.minimum.at(lab, y, low)
        while not np.array_equal(up := lab[lab], lab):
            lab = up


def held_out(column) -> F.Column:
    """True where crc32 of the id's text leaves no remainder by 5; labels of such rows are never learned from."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, y) of at most about `rows` labelled documents that are not held out, chosen by a hash of their id.

    A document labelled twice keeps its larger label; null ids, null labels and null texts teach nothing.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    # a hash below a share keeps each document by itself, so the sample needs no sort of all labels
    share = min(1.0, rows / max(1, known.count()))
    edge = math.floor(share * 2**32)
    picked = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(2**32)) < edge)
    own = docs.select("doc_id", "text").where("text IS NOT NULL")
    return own.join(picked, "doc_id")
