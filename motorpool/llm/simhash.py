"""SimHash fingerprints and their near duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most `bits` bits are found exactly. The 64 bits are cut into segments; by the
pigeonhole principle two such fingerprints agree on some choice of `keep` of `bits + keep` segments. Each choice
is a mask, and the masked pattern is the top node of an index: fingerprints under it are sorted by Gray rank
(neighbours in that order differ in few bits), consecutive ones are grouped, and each group keeps only the bits
its members share beyond what its parent already holds. A search walks down, adding up the differences in those
bits, and leaves a group as soon as the sum passes the limit.

Equal fingerprints are one node with many documents, so exact copies cost one entry. A top node with very many
different fingerprints is cut into blocks, and each pair of blocks is a group of its own; a group answers with
a spanning forest, never with all pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import local_roots, located, numbered, partitions, ranges, utf8
from motorpool.llm.components import components
from motorpool.session import settle, settle_counted

SHINGLE_WORDS = 4
LINK_BITS = 4
FAN_OUT = 16
#: Fingerprints under one top node that one group compares; more are cut into blocks.
BLOCK_ROWS = 50_000
#: Shingles whose bits are unpacked at a time.
VOTE_ROWS = 200_000
SEED = 42


def _votes(digests: list[bytes]) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint_of(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text; 0 for a text without words."""
    own = (text or b"").lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    digest = xxhash.xxh64_digest
    if len(own) <= words:
        n, votes = 1, _votes([digest(joined, SEED)])
    else:
        ends = list(itertools.accumulate(map(len, own), lambda at, k: at + 1 + k))
        starts = [0, *(e + 1 for e in ends[:-words])]
        cuts = zip(starts, ends[words - 1 :])
        n, votes = len(own) - words + 1, np.zeros(64, np.int64)
        while part := [digest(joined[s:e], SEED) for s, e in itertools.islice(cuts, VOTE_ROWS)]:
            votes += _votes(part)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(keys, fp long) per row. A null text counts as empty; the fingerprint of an empty text is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(len(keys)))
            fp = np.fromiter((fingerprint_of(t, words) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(fp)], names=[*keys, "fp"])

    kinds = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keys)
    return docs.select(*keys, F.col(text).cast("string")).mapInArrow(run, f"{kinds}fp long")


def masks(n: int, bits: int = LINK_BITS) -> list[int]:
    """Masks of which two fingerprints within `bits` bits agree on at least one.

    More segments give more masks with longer patterns; the count of fingerprints decides which is cheaper.
    """

    def cut(keep: int) -> list[int]:
        edges = [round(64 * i / (bits + keep)) for i in range(bits + keep + 1)]
        parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
        return [sum(c) for c in itertools.combinations(parts, keep)]

    def cost(keep: int) -> float:
        return math.comb(bits + keep, keep) * (50 + n / 2 ** (64 * keep / (bits + keep)))

    return cut(min(range(1, 5), key=cost))


def gray_rank(x: np.ndarray) -> np.ndarray:
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def linked(fp: np.ndarray, top: np.ndarray, bits: int = LINK_BITS) -> np.ndarray:
    """For fingerprints sorted by (top node, Gray rank): the first row of each one's component within its top node.

    Levels are built bottom up, `FAN_OUT` children to a node, never across top nodes; searched top down.
    """
    n = len(fp)
    every = ~np.uint64(0)
    levels = [{"value": fp, "mask": np.full(n, every), "top": top}]
    while True:
        own = levels[-1]
        run = np.flatnonzero(np.r_[True, own["top"][1:] != own["top"][:-1]])
        if len(run) == len(own["top"]):
            break
        place = np.arange(len(own["top"])) - np.repeat(run, np.diff(np.r_[run, len(own["top"])]))
        first = np.flatnonzero(place % FAN_OUT == 0)
        size = np.diff(np.r_[first, len(place)])
        spread = own["value"] ^ np.repeat(own["value"][first], size)
        mask = ~np.bitwise_or.reduceat(spread | ~own["mask"], first)
        levels.append({"value": own["value"][first], "mask": mask, "top": own["top"][first], "first": first, "size": size})
    rest = [levels[-1]["mask"]]
    for parent, child in zip(levels[:0:-1], levels[-2::-1]):
        rest.append(child["mask"] & ~np.repeat(parent["mask"], parent["size"]))
    root_of = np.repeat(np.arange(len(levels[-1]["top"])), np.diff(np.r_[np.flatnonzero(np.r_[True, top[1:] != top[:-1]]), n]))
    lab = np.arange(n)
    step = max(64, 4_000_000 // max(1, int(np.bincount(root_of).max())))
    for at in range(0, n, step):
        query = np.arange(at, min(n, at + step))
        node, diff = root_of[query], np.zeros(len(query), np.uint8)
        for depth, level in enumerate(levels[::-1]):
            diff = diff + np.bitwise_count((fp[query] ^ level["value"][node]) & rest[depth][node])
            near = diff <= bits
            query, node, diff = query[near], node[near], diff[near]
            if depth < len(levels) - 1:
                size = level["size"][node]
                query, diff = np.repeat(query, size), np.repeat(diff, size)
                node = np.repeat(level["first"][node], size) + ranges(size)
        later = node > query
        lab = local_roots(n, query[later], node[later], lab)
    return lab


def fingerprint_links(fps: DataFrame, bits: int = LINK_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `fps.fp` within `bits` bits."""
    spark = fps.sparkSession
    own, n = settle_counted(fps.select("fp").distinct(), "fingerprints")
    signed = [np.uint64(m).view(np.int64).item() for m in masks(n, bits)]
    patterns = [F.col("fp").bitwiseAND(F.lit(m)).alias("pattern") for m in signed]
    tops = F.array(*[F.struct(F.lit(i).alias("mask"), p) for i, p in enumerate(patterns)])
    keyed = own.select("fp", F.explode(tops).alias("x")).select("fp", "x.mask", "x.pattern")
    large = settle(keyed.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows), "large")
    blocks = F.coalesce(F.ceil(F.col("n") / block_rows).cast("int"), F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    grouped = (
        keyed.join(large, ["mask", "pattern"], "left").select("fp", "mask", "pattern", blocks.alias("blocks"))
        .select("fp", "mask", "pattern", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("fp", F.xxhash64("mask", "pattern", F.least("mine", "other"), F.greatest("mine", "other")).alias("top"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not got or not sum(len(x) for x, _ in got):
            return
        fp, top = (np.concatenate(x) for x in zip(*got))
        fp = fp.view(np.uint64)
        order = np.lexsort((gray_rank(fp), top))
        fp, top = fp[order], top[order]
        lab = linked(fp, top, bits)
        far = np.flatnonzero(lab != np.arange(len(lab)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[far].view(np.int64)), pa.array(fp[lab[far]].view(np.int64))], names=["a", "b"]
        )

    return grouped.repartition(partitions(spark), "top").mapInArrow(run, "a long, b long")


def with_roots(marked: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """Rows with a fingerprint `fp`, plus `root`; rows of one root are linked, directly or through others."""
    roots = settle(components(fingerprint_links(marked, bits)), "roots")
    joined = marked.join(roots, marked["fp"] == roots["node"], "left")
    return joined.select(*marked.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicate_report(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = LINK_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component; nulls don't count).

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows are rows of one fingerprint.
    An empty input gives an empty result.
    """
    found = settle(with_roots(settle(fingerprints(docs, words=words), "marked"), bits), "found")
    least = settle(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return found.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = LINK_BITS) -> DataFrame:
    """`docs` with one row of each component: the smallest doc_id, null ids last, repeated rows by row order."""
    known = located(docs)
    if known:
        own, row = known
        marked, n = settle_counted(fingerprints(own, (row, "doc_id"), words=words), "marked")
        if marked.select(row).distinct().count() < n:
            known = None
    if not known:
        own, row = numbered(docs, "dedup")
        marked = settle(fingerprints(own, (row, "doc_id"), words=words), "marked")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    keep = settle(with_roots(marked, bits).groupBy("root").agg(F.min_by(row, first).alias(row)).select(row), "keep")
    # one row per component: it grows with the documents, so it is never broadcast
    return own.join(keep.hint("merge"), row, "left_semi").drop(row)
