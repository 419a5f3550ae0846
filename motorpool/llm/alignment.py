"""Which tokens of two vocabularies end together, and how often each pair does over the whole corpus.

A text's tokens by vocabulary A and by B are cut into groups where tokens of both end at one byte. The last tokens of
a group's two sides are linked. Most groups are one token on each side with the same bytes: an array from A ids to the
B id of the same bytes says so, and they are counted in vectors as long as the vocabulary. Only links of the other
groups become (pair, count) rows, distinct within blocks of documents, that are shuffled and added up. Counts then
come back to the block, once a pair, and are summed for its documents.

Texts are aligned unit by unit. A unit starts at a space that follows no white space, where tokens of both sides end
whatever stands around it, so units repeat like words and each is tokenized once a task.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorpool.llm.common import doc_groups, ranges, utf8
from motorpool.session import settle

#: Bytes of text whose units are looked up at a time, and whose pairs are made distinct together.
GROUP_BYTES = 1 << 19
BLOCK_BYTES = 8 << 20
#: Units a task remembers, by number and by characters.
CACHE_UNITS = 300_000
CACHE_CHARS = 16 << 20

SPACE_MARK = "▁"
#: White space that keeps the space behind it in the same unit.
JOINED = re.compile(r"  |[^\S ] ")
UNIT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+\Z")
# Fixed value: the pattern that byte-level vocabularies split texts by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters, digits and signs on which all versions of Unicode agree.
SETTLED = re.compile("[\x00-\u024f\u0400-\u045f\u2010-\u2027]*")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 as it is, the rest from 256 up."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the B id of the same bytes for each A id (-1: none)."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=pieces)
        letters = byte_letters()
        with open(byte_level, encoding="utf-8") as file:
            model = json.load(file)["model"]
        entries = model["vocab"]
        self.a_bytes = [b""] * (1 + max(entries.values()))
        for entry, i in entries.items():
            if all(c in letters for c in entry):
                self.a_bytes[i] = bytes(letters[c] for c in entry)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        own: dict[bytes, int] = {}
        for i, known in enumerate(self.b_bytes):
            # whole pieces come before single bytes, which stand for characters without a piece
            if known and (known not in own or self.b.is_byte(own[known])):
                own[known] = i
        self.same = np.array([own.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        self.a_size, self.b_size = (np.array([len(x) for x in known], np.int64) for known in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(SPACE_MARK)
        self.ranks = self._ranks(model)
        # no piece has a space behind another character, so none crosses the start of a unit
        self.cut = not any(SPACE_MARK in self.b.id_to_piece(i).lstrip(SPACE_MARK) for i in range(len(self.b_bytes)))

    def _ranks(self, model: dict):
        """The A side as ranks, which is quicker, if its ids are in the order of its merges; else None."""
        from tiktoken import Encoding

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        entries = model["vocab"]
        if any(entries[x + y] != 256 + i for i, (x, y) in enumerate(merges)):
            return None
        ranks = {x: i for i, x in enumerate(self.a_bytes[: 256 + len(merges)])}
        return Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(BYTE_PIECE.fullmatch(piece)[1], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def units(self, text: str) -> list[str]:
        """The units of space + text, each without its leading space."""
        spaced = " " + text
        if not self.cut:
            return [text]
        if not JOINED.search(spaced):
            return text.split(" ")
        return [u[1:] for u in UNIT.findall(spaced)]

    def ids(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Token ids of both sides; units come without the space in front."""
        a: list[list[int]] = [[]] * len(units)
        slow = []
        for i, unit in enumerate(units):
            if self.ranks and (unit.isascii() or SETTLED.fullmatch(unit)):
                a[i] = self.ranks.encode_ordinary(" " + unit)
            else:
                slow.append(i)
        for at in range(0, len(slow), 1000):
            part = slow[at : at + 1000]
            for i, found in zip(part, self.a.encode_batch_fast([" " + units[i] for i in part], add_special_tokens=False)):
                a[i] = found.ids
        # an empty input gets no space in front
        return a, [y or [self.space] for y in self.b.encode(units, num_threads=1)]

    def groups(self, units: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per unit: its groups as text (None if tokens do not spell it), tokens of A, of B, links; and all links."""
        told = [(" " + u).encode() for u in units]
        a, b = self.ids(units)
        n_a, n_b, size = (np.fromiter(map(len, x), np.int64, len(units)) for x in (a, b, told))
        flat_a, flat_b = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (a, b))
        long_a, long_b = self.a_size[flat_a], self.b_size[flat_b]
        unit_a, unit_b = np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)
        good = (np.bincount(unit_a, long_a, len(units)) == size) & (np.bincount(unit_b, long_b, len(units)) == size)
        for i in np.flatnonzero(good).tolist() if not self._spelled(a, b, told, good) else ():
            good[i] = self._spelled(a[i : i + 1], b[i : i + 1], told[i : i + 1], good[i : i + 1])
        keep_a, keep_b = good[unit_a], good[unit_b]
        flat_a, flat_b, unit_a = flat_a[keep_a], flat_b[keep_b], unit_a[keep_a]
        # units that are spelled have as many bytes on both sides, so places of all of them together agree
        end_a, end_b = np.cumsum(long_a[keep_a]), np.cumsum(long_b[keep_b])
        at_a = np.flatnonzero(np.isin(end_a, end_b, assume_unique=True))
        at_b = np.searchsorted(end_b, end_a[at_a])
        links = flat_a[at_a] * len(self.b_bytes) + flat_b[at_b]
        n_links = np.bincount(unit_a[at_a], minlength=len(units))
        ids_a, ids_b = flat_a.tolist(), flat_b.tolist()
        parts, i, j = [], 0, 0
        for x, y in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            if x - i == 1 and y - j == 1:
                parts.append(f"{ids_a[i]}|{ids_b[j]}")
            else:
                parts.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        ends = np.cumsum(n_links).tolist()
        texts = [";".join(parts[s:e]) if ok else None for s, e, ok in zip([0, *ends], ends, good.tolist())]
        return texts, n_a, n_b, n_links, links

    def _spelled(self, a: list, b: list, told: list, good: np.ndarray) -> bool:
        whole = b"".join(itertools.compress(told, good))
        return all(
            b"".join(map(known.__getitem__, itertools.chain.from_iterable(itertools.compress(ids, good)))) == whole
            for known, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )


class Aligner:
    """Alignments of texts, with a memory for units."""

    def __init__(self, words: Vocabularies) -> None:
        self.words = words
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.text: list[str | None] = []
        self.n_a, self.n_b = array("q"), array("q")
        self.links, self.starts = array("q"), array("q", [0])

    def learn(self, units: list[str]) -> None:
        text, n_a, n_b, n_links, links = self.words.groups(units)
        self.known.update(zip(units, range(len(self.text), len(self.text) + len(units))))
        self.chars += sum(map(len, units))
        self.text += text
        for own, more in ((self.n_a, n_a), (self.n_b, n_b), (self.starts, len(self.links) + np.cumsum(n_links)), (self.links, links)):
            own.frombytes(more.astype(np.int64).tobytes())

    def align(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Per text: tokens of A, of B, links, hash of the groups; and all links, one text after the other."""
        if len(self.known) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.forget()
        split = []
        for text in texts:
            try:
                split.append(self.words.units(text.decode()) if text else [])
            except UnicodeDecodeError:
                split.append([])
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(list(new))
        seen, shas = [], []
        for units in split:
            at = [*map(self.known.__getitem__, units)]
            parts = [*map(self.text.__getitem__, at)]
            if not at or None in parts:
                seen.append([])
                shas.append("")
            else:
                seen.append(at)
                shas.append(hashlib.sha256(";".join(parts).encode()).hexdigest())
        doc = np.repeat(np.arange(len(seen)), [len(x) for x in seen])
        at = np.concatenate([np.array(x, np.int64) for x in seen])
        starts = np.array(self.starts)
        counts = np.diff(starts)[at]
        links = np.array(self.links)[np.repeat(starts[at], counts) + ranges(counts)]
        sums = [np.bincount(doc, x, len(seen)).astype(np.int64) for x in (np.array(self.n_a)[at], np.array(self.n_b)[at], counts)]
        return *sums, shas, links


ENCODED = "n_a array<bigint>, n_b array<bigint>, n_links array<bigint>, groups_sha256 array<string>, same binary, n_same array<bigint>, odd binary, pairs binary, counts binary"


def _lists(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(keys: pa.Array, parts: list[tuple], same: np.ndarray, size: int) -> pa.RecordBatch:
    """One row for the documents of a block; links by position in the block's sorted distinct pairs."""
    n_a, n_b, n_links, sha, links = zip(*parts)
    links, n_links = np.concatenate(links), np.concatenate(n_links)
    exact = same[links // size] == links % size
    doc = np.repeat(np.arange(len(n_links)), n_links)
    kind = np.uint16 if len(same) <= 1 << 16 else np.int32
    pairs, odd, counts = np.unique(links[~exact], return_inverse=True, return_counts=True)
    columns = {
        "doc_id": keys, "n_a": pa.array(np.concatenate(n_a)), "n_b": pa.array(np.concatenate(n_b)), "n_links": pa.array(n_links),
        "groups_sha256": pa.array([s for x in sha for s in x], pa.string()),
    }
    arrays = [_lists(x) for x in columns.values()]
    blobs = [(links[exact] // size).astype(kind), odd.astype(np.int32), pairs, counts]
    first, *rest = [pa.array([x.tobytes()], pa.binary()) for x in blobs]
    arrays += [first, _lists(pa.array(np.bincount(doc[exact], minlength=len(n_links)))), *rest]
    return pa.RecordBatch.from_arrays(arrays, names=[*columns, "same", "n_same", "odd", "pairs", "counts"])


def encode(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block of documents; a document of more than BLOCK_BYTES is a block by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(Vocabularies(byte_level, pieces))
            texts = utf8(batch.column(1))
            for s, e in doc_groups(texts, BLOCK_BYTES):
                parts = [aligner.align(texts[s + x : s + y]) for x, y in doc_groups(texts[s:e], GROUP_BYTES)]
                yield _block(batch.column(0).slice(s, e - s), parts, aligner.words.same, len(aligner.words.b_bytes))

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id array<{kind}>, {ENCODED}")


def _odd_rows(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): a row for each irregular pair of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                pair = np.frombuffer(pairs, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(np.frombuffer(counts, np.int64))], names=["block", "pair", "n"]
                )

    return blocks.select("block", "pairs", "counts").mapInArrow(run, "block long, pair long, n long")


def _same_rows(blocks: DataFrame, size: int) -> DataFrame:
    """(a, n): the counts of same-byte links of a task's blocks, added up in a vector of the vocabulary's length."""
    kind = np.uint16 if size <= 1 << 16 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(blob, kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["a", "n"])

    return blocks.select("same").mapInArrow(run, "a long, n long")


def align(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `byte_level` is a byte-level BPE file, `pieces` a piece model that puts a space in front. Null, empty and
    undecodable texts, and texts whose tokens don't spell space + text, have no tokens: zeros and ''. Repeated rows
    count each for itself; null keys are kept. An empty input gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    words = Vocabularies(byte_level, pieces)
    size_a, size_b = len(words.a_bytes), len(words.b_bytes)
    blocks = settle(encode(docs, byte_level, pieces, key, text).withColumn("block", F.monotonically_increasing_id()), "blocks")
    odd = _odd_rows(blocks)
    totals = settle(odd.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    # both results are at most as long as a vocabulary
    same_n, best = np.zeros(size_a, np.int64), np.zeros(size_b, np.int64)
    for a, n in _same_rows(blocks, size_a).groupBy("a").agg(F.sum("n")).collect():
        same_n[a] = n
    for b, n in totals.groupBy(F.pmod("pair", F.lit(size_b)).alias("b")).agg(F.max("total")).collect():
        best[b] = n
    known = words.same >= 0
    np.maximum.at(best, words.same[known], same_n[known])
    same_best = np.where(known, same_n == best[words.same], False)
    kind = np.uint16 if size_a <= 1 << 16 else np.int32
    fields = T.StructType([
        T.StructField("doc_id", docs.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType()),
    ])
    names = fields.names

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        pair, total = (right.column(c).to_numpy() for c in ("pair", "total"))
        order = np.argsort(pair)
        pair, total = pair[order], total[order]
        top = total == best[pair % size_b]
        out = []
        for row in left.to_batches():
            for i in range(row.num_rows):
                get = {c: row.column(c)[i] for c in row.schema.names}
                n_links, n_same = (get[c].values.to_numpy() for c in ("n_links", "n_same"))
                same, place = np.frombuffer(get["same"].as_py(), kind), np.frombuffer(get["odd"].as_py(), np.int32)
                n_best, count_sum = np.zeros(len(n_links), np.int64), np.zeros(len(n_links), np.int64)
                for n, flag, count in ((n_same, same_best[same], same_n[same]), (n_links - n_same, top[place], total[place])):
                    ends = np.cumsum(n)
                    for target, values in ((n_best, flag), (count_sum, count)):
                        upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
                        target += upto[ends] - upto[ends - n]
                out.append(pa.Table.from_arrays([
                    get["doc_id"].values, get["n_a"].values, get["n_b"].values, get["n_links"].values, get["n_links"].values,
                    pa.array(n_best), pa.array(count_sum), get["groups_sha256"].values,
                ], names=names))
        return pa.concat_tables(out) if out else pa.Table.from_batches([], schema=None)

    answers = odd.select("block", "pair").join(totals, "pair")
    told = blocks.select("block", "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "same", "n_same", "odd")
    return told.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, fields)
