"""Packing tokenised documents into fixed-length sequences by cutting-stock column generation.

A document of n tokens gives full pieces of one sequence each and a last piece of n modulo the length. The
histogram of piece lengths (rounded up to `GRAIN` tokens) is the demand of a cutting-stock problem: a linear
program over patterns of lengths that fit one sequence, whose columns are priced by a knapsack dynamic program.
Its solution is rounded down and the small rest is filled greedily. The histogram has at most length / GRAIN
entries whatever the data, so the program is solved on the driver in bounded time; the pieces themselves are
ranked within their length class and looked up in the patterns by Spark tasks.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorpool.llm.common import doc_groups, utf8
from motorpool.session import settle

LENGTH = 4096
GRAIN = 16
END_ID = 2
#: Words, and parts of words, whose ids a worker remembers, and as many from before.
CACHE_WORDS = 400_000
CACHE_PARTS = 200_000
GROUP_BYTES = 1 << 20
#: Columns priced at most; stopping early costs a little padding, never a document.
MAX_COLUMNS = 3000


def knapsack(value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best total of `value[i - 1]` over multisets of sizes i that fit into `room`, and the counts by size."""
    best = np.zeros(room + 1)
    take = np.zeros(room + 1, np.int64)
    sizes = np.arange(1, len(value) + 1)
    for c in range(1, room + 1):
        k = min(c, len(value))
        with_i = value[:k] + best[c - sizes[:k]]
        i = int(with_i.argmax())
        best[c], take[c] = (with_i[i], i + 1) if with_i[i] > best[c - 1] else (best[c - 1], 0)
    counts = np.zeros(len(value), np.int64)
    c = room
    while c > 0:
        if take[c]:
            counts[take[c] - 1] += 1
            c -= take[c]
        else:
            c -= 1
    return float(best[room]), counts


def patterns(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(counts by size, repetitions) covering `demand[i - 1]` pieces of size i exactly, in bins of `len(demand)`."""
    room = len(demand)
    used = np.flatnonzero(demand)
    out: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    if len(used) > 1:
        m = len(used)
        basis = np.diag((room // (used + 1)).astype(float))
        inverse = np.linalg.inv(basis)
        x = inverse @ demand[used]
        for step in range(MAX_COLUMNS):
            dual = np.zeros(room)
            dual[used] = np.maximum(inverse.sum(axis=0), 0)
            total, counts = knapsack(dual, room)
            if total <= 1 + 1e-7:
                break
            column = counts[used].astype(float)
            turn = inverse @ column
            can = turn > 1e-9
            if not can.any():
                break
            ratio = np.where(can, x / np.where(can, turn, 1), np.inf)
            out_at = int(ratio.argmin())
            basis[:, out_at] = column
            if step % 200 == 199:
                inverse = np.linalg.inv(basis)
            else:
                row = inverse[out_at] / turn[out_at]
                inverse -= np.outer(turn, row)
                inverse[out_at] = row
            x = np.maximum(inverse @ demand[used], 0)
        for k in range(m):
            counts = np.zeros(room, np.int64)
            counts[used] = basis[:, k].round().astype(np.int64)
            has = counts > 0
            n = min(int(x[k] + 1e-6), int((left[has] // counts[has]).min()))
            if n > 0:
                out.append((counts, n))
                left -= n * counts
    while left.any():
        counts, space = np.zeros(room, np.int64), room
        for size in np.flatnonzero(left)[::-1] + 1:
            counts[size - 1] = min(left[size - 1], space // size)
            space -= counts[size - 1] * size
        has = counts > 0
        n = int((left[has] // counts[has]).min())
        out.append((counts, n))
        left -= n * counts
    return out


def slots(plan: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Rows (size, first rank, copies in a sequence, first sequence), sorted by size and rank."""
    rows, sequence = [], 0
    ranks: dict[int, int] = {}
    for counts, n in plan:
        for size in np.flatnonzero(counts) + 1:
            rows.append((size, ranks.get(size, 0), counts[size - 1], sequence))
            ranks[size] = ranks.get(size, 0) + int(counts[size - 1]) * n
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Words that need no more than lower case and splitting; apostrophes and `<` have rules of their own.
PLAIN = re.compile(rf"[{LETTERS}0-9!-&(-;=-@\[-`{{-~]+")
PARTS = re.compile(rf"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")


class WordEncoder:
    """Ids of single words, little-endian 32-bit.

    White space separates tokens in this vocabulary, so a text's ids are those of its words in order. Words of
    Latin letters, digits and common punctuation are cut into parts here and given to the model part by part, which
    spares the tokenizer's work around it; all other words take the tokenizer's whole way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # the model sees bytes beyond ASCII as stand-in characters
        self.table = {c: shown(chr(c))[0][0] for c in (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def part(self, text: str) -> bytes:
        if len(self.parts) > CACHE_PARTS:
            self.older_parts, self.parts = self.parts, {}
        out = self.older_parts.get(text)
        if out is None:
            out = array("I", [t.id for t in self.model.tokenize(text.lower().translate(self.table))]).tobytes()
        self.parts[text] = out
        return out

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if not PLAIN.fullmatch(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        known, parts = self.parts, PARTS.findall(text)
        return b"".join([known.get(p) or self.part(p) for p in parts])

    def ids_of(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids by word, of these words at least. A full memory becomes the older one, and words met again return."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        for word in set(words).difference(known):
            ids = older.get(word)
            known[word] = self.word(word) if ids is None else ids
        return known


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker: tasks that follow one another on it share what it remembers."""
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every document; its ids end with `end_id`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            texts = utf8(batch.column(1))
            for s, e in doc_groups(texts, GROUP_BYTES):
                split = [(t or b"").split() for t in texts[s:e]]
                known = encoder.ids_of(set().union(*split))
                rows: list[tuple] = []
                for i, words in enumerate(split):
                    ids = b"".join([*map(known.__getitem__, words), end])
                    n = len(ids) // 4
                    rows += [(i, at, min(length, n - at), zlib.crc32(ids[4 * at : 4 * (at + length)]), n) for at in range(0, n, length)]
                doc, *rest = (np.array(c, np.int64) for c in zip(*rows))
                keys = batch.column(0).slice(s, e - s).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, rest)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces with the sequence they go to and their offset there: see `pieces` for the other columns.

    Every row of `docs` is a document of its own, also repeated rows and null keys; a null or empty text is the
    end id alone. An empty input gives no rows. Offsets of a sequence leave no gap; padding follows its last piece.
    """
    classes = length // GRAIN
    made = pieces(docs, tokenizer, key, length, end_id).withColumn("piece", F.monotonically_increasing_id())
    made = settle(made.withColumn("size", F.ceil(F.col("length") / GRAIN).cast("int")), "pieces")
    # ranks within a size: counts by writing task first, so that no task numbers a whole size
    task = F.shiftright("piece", 33).alias("task")
    counts = settle(made.groupBy("size", task).agg(F.count(F.lit(1)).alias("n")), "counts")
    demand = np.zeros(classes, np.int64)
    for row in counts.groupBy("size").agg(F.sum("n").alias("n")).collect():
        demand[row["size"] - 1] = row["n"]
    plan = slots(patterns(demand))
    before = Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("size", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = (
        made.withColumn("task", task)
        .withColumn("rank", F.row_number().over(Window.partitionBy("size", "task").orderBy("piece")) - 1)
        .join(offsets, ["size", "task"])
        .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one increasing number per (size, rank), to look both up at once
        edge = np.cumsum(np.r_[0, demand])
        firsts = edge[plan[:, 0] - 1] + plan[:, 1]
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(firsts, edge[size - 1] + rank, "right") - 1
            sequence = plan[at, 3] + (rank - plan[at, 1]) // plan[at, 2]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence)], names=[*names, "sequence_id"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"]
    kind = made.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, piece long, sequence_id long"
    placed = ranked.select(*names, "size", "rank").mapInArrow(place, schema)
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop("piece")
