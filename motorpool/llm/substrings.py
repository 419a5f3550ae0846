"""Removal of word passages that occur more than once, found through difference-cover anchors.

A difference cover modulo v is a set D of residues such that for any two positions i and j some shift k < v puts
both i + k and j + k on residues in D. So it suffices to hash short windows, of `window - v + 1` words, at cover
positions only: two equal passages of `window` words always share such an anchor at the same shift. Steps:

1. every text gives its anchors (hash, text, place); anchors met more than once are reported to their texts;
2. around those, and only there, the match is extended: each full window that holds a shared anchor is hashed,
   and windows met more than once are reported;
3. the words those windows cover are removed.

Step 1 may report too much (32 bits of a hash), never too little; step 2 compares 96 bits of whole windows.
Both meetings happen in tasks dealt by hash, one bucket to a task. What occurs twice within one group of texts is settled there and
sends one row only, so a passage that a third of all documents share is a row per group, not per occurrence.
Texts are known by a 96-bit hash: equal texts have equal windows, so one answer serves all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorpool.llm.common import doc_groups, fresh_name, partitions, ranges, utf8
from motorpool.session import settle

WINDOW_WORDS = 35
#: Perfect difference covers: fixed values.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: Shortest anchor in words, as far as the window allows.
ANCHOR_WORDS = 12
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
KEY = np.dtype([("a", "<i8"), ("b", "<i4")])


def cover_for(window: int) -> tuple[int, np.ndarray]:
    period = max(v for v in COVERS if v == 1 or window - v + 1 >= ANCHOR_WORDS)
    return period, np.array(COVERS[period])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of words[s : s + length] for every s, from prefix sums of a polynomial modulo 2^64."""
    n = len(words)
    powers = np.full((2, n), base, np.uint64)
    powers[1] = pow(base, -1, 2**64)
    powers[:, 0] = 1
    up, down = np.multiply.accumulate(powers, axis=1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and each text's number of words."""
    digest = xxhash.xxh3_64_digest
    parts, counts = [], []
    for text in texts:
        own = (text or b"").split()
        counts.append(len(own))
        parts.append(b"".join(map(digest, own)))
    return np.frombuffer(b"".join(parts), np.uint64), np.array(counts, np.int64)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    keys = np.empty(batch.num_rows, KEY)
    keys["a"], keys["b"] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    return keys


BLOBS = "bucket int, asks binary, told binary, keys binary, places binary"


def _split(at: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, range) of each run of equal values in a sorted array."""
    edge = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(at)]
    for s, e in zip(edge[:-1], edge[1:]):
        if e > s:
            yield int(at[s]), slice(s, e)


def _dealt(upper: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket below `buckets` from the upper halves of hashes."""
    return (upper >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _blobs(hashes: np.ndarray, keys: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that the group has hashes of. What the group holds once asks for an answer; of what it
    holds twice the hash is told once, and its texts and places are known to be met (they follow those that ask)."""
    if not len(hashes):
        return
    order = np.argsort(hashes["a"], kind="stable")
    same = np.r_[False, (hashes["a"][order][1:] == hashes["a"][order][:-1]) & (hashes["b"][order][1:] == hashes["b"][order][:-1])]
    more = same | np.r_[same[1:], False]
    again = np.empty(len(order), bool)
    again[order] = more
    bucket = _dealt(hashes["a"], buckets)
    told = order[more & ~same]
    told = told[np.argsort(bucket[told], kind="stable")]
    telling = {b: hashes["b"][told[at]].tobytes() for b, at in _split(bucket[told])}
    order = np.lexsort((again, bucket))
    rows = []
    for b, at in _split(bucket[order]):
        own = order[at]
        asking = own[~again[own]]
        rows.append((b, hashes["b"][asking].tobytes(), telling.get(b, b""), keys[own].tobytes(), places[own].tobytes()))
    types = [pa.int32(), *[pa.binary()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=["bucket", "asks", "told", "keys", "places"])


def _distinct(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, place), sorted."""
    keys, places = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((places, keys["b"], keys["a"]))
    keys, places = keys[order], places[order]
    keep = np.r_[True, (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])]
    return keys[keep], places[keep]


def _meetings(blobs: DataFrame, width: int) -> DataFrame:
    """(a, b, places binary): for each text, the places whose hash was met more than once.

    Answers go back in two steps, so that their number follows that of the texts: a bucket sends one row to each
    task of the next step, where the places of a text come together.
    """
    n = partitions(blobs.sparkSession)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[tuple]] = {}
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
                met.setdefault(bucket, []).append(row)
        found = []
        for rows in met.values():
            told = [r[1] for r in rows]
            asks = [r[0] for r in rows]
            hashes = np.frombuffer(b"".join([*asks, *told, *told]), np.uint32).reshape(-1, width // 4)
            order = np.lexsort(hashes.T)
            same = np.r_[False, (hashes[order][1:] == hashes[order][:-1]).all(axis=1)]
            shared = np.empty(len(order), bool)
            shared[order] = same | np.r_[same[1:], False]
            at = 0
            for ask, _, keys, places in rows:
                k = len(ask) // width
                keys, places = np.frombuffer(keys, KEY), np.frombuffer(places, np.uint32)
                take = np.r_[shared[at : at + k], np.ones(len(keys) - k, bool)]
                at += k
                if take.any():
                    found.append((keys[take], places[take]))
        met.clear()
        if found:
            keys, places = _distinct(found)
            home = _dealt(keys["a"].view(np.uint64), n)
            order = np.argsort(home, kind="stable")
            rows = [(h, keys[order[at]].tobytes(), places[order[at]].tobytes()) for h, at in _split(home[order])]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["home", "keys", "places"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (np.frombuffer(k, KEY), np.frombuffer(p, np.uint32))
            for batch in batches for k, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        ]
        if not found:
            return
        keys, places = _distinct(found)
        at = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]
        keys = keys[at[:-1]]
        for s in range(0, len(keys), 10_000):
            e = min(len(keys), s + 10_000)
            own = pa.array([places[at[i] : at[i + 1]].tobytes() for i in range(s, e)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys["a"][s:e].copy()), pa.array(keys["b"][s:e].copy()), own], names=["a", "b", "places"])

    sent = blobs.repartitionById(n, "bucket").mapInArrow(meet, "home int, keys binary, places binary")
    return sent.repartitionById(n, "home").mapInArrow(gather, "a long, b int, places binary")


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash for dealing out (its upper half) and hash for comparing, as one sortable value."""
    out = np.empty(len(first), [("a", "<u8"), ("b", second.dtype)])
    out["a"], out["b"] = first, second
    return out


def _anchors(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    period, cover = cover_for(window)
    length = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = _keys(batch), utf8(batch.column(2))
            for s, e in doc_groups(texts):
                words, counts = hashed_words(texts[s:e])
                long = np.flatnonzero(counts >= window)
                if not len(long):
                    continue
                starts = (np.cumsum(counts) - counts)[long]
                # the n-th cover position of a text is (n // |D|) * period + D[n % |D|]
                some = ((counts[long] - length) // period + 1) * len(cover)
                order = ranges(some)
                place = order // len(cover) * period + cover[order % len(cover)]
                doc = np.repeat(np.arange(len(long)), some)
                fits = place + length <= counts[long][doc]
                doc, place = doc[fits], place[fits]
                h = rolling(words, length, BASES[0])[starts[doc] + place]
                yield from _blobs(_pair(h, h.astype(np.uint32)), keys[s:e][long][doc], place.astype(np.uint32), buckets)

    return texts.mapInArrow(run, BLOBS)


def _marked(found: bytes | None, ahead: int, behind: int, n: int) -> np.ndarray:
    """True at each i < n with i in [p - behind, p + ahead) for a place p."""
    edge = np.zeros(n + 1, np.int32)
    if found:
        places = np.frombuffer(found, np.uint32).astype(np.int64)
        places = places[places < n + behind]
        np.add.at(edge, np.clip(places - behind, 0, n), 1)
        np.add.at(edge, np.clip(places + ahead, 0, n), -1)
    return np.cumsum(edge[:n]) > 0


def _windows(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    period, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, marks = _keys(batch), utf8(batch.column(2)), batch.column(3).to_pylist()
            for s, e in doc_groups(texts):
                words, counts = hashed_words(texts[s:e])
                if len(words) < window:
                    continue
                near = [_marked(m, 1, period - 1, max(0, int(c) - window + 1)) for m, c in zip(marks[s:e], counts)]
                places = [np.flatnonzero(x) for x in near]
                doc = np.repeat(np.arange(len(places)), [len(p) for p in places])
                place = np.concatenate(places)
                at = (np.cumsum(counts) - counts)[doc] + place
                first, second = (rolling(words, window, b)[at] for b in BASES)
                rest = np.empty(len(at), [("x", "<u8"), ("y", "<u4")])
                rest["x"], rest["y"] = second, first.astype(np.uint32)
                yield from _blobs(_pair(first, rest), keys[s:e][doc], place.astype(np.uint32), buckets)

    return texts.mapInArrow(run, BLOBS)


def repeated_windows(docs: DataFrame, window: int = WINDOW_WORDS, text: str = "text") -> DataFrame:
    """(a, b, places): for each text hash, the starts (packed uint32) of windows that also start elsewhere."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    texts = docs.select(*text_key(text), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    shared = settle(_meetings(_anchors(texts, window, buckets), 4), "anchors")
    # both tables of places grow with the documents, so they are never broadcast
    near = texts.join(shared.hint("merge"), ["a", "b"])
    return settle(_meetings(_windows(near, window, buckets), 12), "windows")


def text_key(text: str) -> list[F.Column]:
    low = F.xxhash64(F.lit("text"), F.col(text).cast("string"))
    return [F.xxhash64(F.col(text).cast("string")).alias("a"), F.shiftright(low, 32).cast("int").alias("b")]


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`docs` without the words that repeated windows cover, and the names of the columns it adds.

    Words are runs of anything but space and the controls 9 to 13; windows are judged on the input, also within
    one document, also overlapping themselves. A text that loses words becomes its kept words joined by one
    space; other texts stay as they are. Null and empty texts and texts shorter than a window lose nothing.
    Repeated rows of a window's length or more lose everything. Added: number of words, number removed,
    SHA-256 of the kept words joined by one space (lower-case hex).
    """
    names = {x: fresh_name(docs, x) for x in ("n_words", "n_removed", "kept_sha256")}
    found = repeated_windows(docs, window, text)
    a, b, places = fresh_name(docs, "key_a"), fresh_name(docs, "key_b"), fresh_name(docs, "places")
    key = text_key(text)
    own = docs.withColumns({a: key[0], b: key[1], text: F.col(text).cast("string")})
    joined = own.join(found.select(F.col("a").alias(a), F.col("b").alias(b), F.col("places").alias(places)).hint("merge"), [a, b], "left").drop(a, b)
    at = joined.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = utf8(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist()
            out, total, gone, sha = [], [], [], []
            for value, mark in zip(texts, marks):
                words = (value or b"").split()
                n = len(words)
                lost = 0
                if mark:
                    covered = _marked(mark, window, 0, n)
                    lost = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                kept = b" ".join(words)
                out.append(kept if lost else value)
                total.append(n)
                gone.append(lost)
                sha.append(hashlib.sha256(kept).hexdigest())
            columns = [*batch.columns[:at], pa.array(out, pa.binary()).cast(batch.column(at).type), *batch.columns[at + 1 : -1]]
            added = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *added], names=fields)

    kinds = [T.StructField(f.name, f.dataType, True) for f in joined.schema.fields[:-1]]
    more = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType()}
    kinds += [T.StructField(names[c], kind) for c, kind in more.items()]
    fields = [f.name for f in kinds]
    return joined.mapInArrow(run, T.StructType(kinds)), names
