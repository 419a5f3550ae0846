"""Toxicity by a support vector machine over a gap-weighted subsequence kernel, with Nystroem landmarks.

A text is a bag of words. A word's features are its subsequences of three and four characters within the gap
patterns below, each weighted by a decay for every character skipped, so `idxiot` still shares most of what
`idiot` has; characters that are neither letters nor digits are dropped first, and letters written apart by
spaces are joined. Kernel values against landmark words give the Nystroem map, on which a linear machine with
squared hinge loss is trained; because the kernel is an inner product, the machine folds back into one weight per
(hashed) subsequence, and scoring is table lookups.

Labels say whether a text is toxic, not which word is, so training alternates (multiple-instance learning): the
best word of each toxic text is its witness, words of other texts are negatives, the hardest ones first. A text's
decision is that of its worst word, so what else the text says, and how much, does not lower its score; a logistic
curve turns the decision into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import doc_groups, held_out, labelled_sample, utf8

#: Labelled texts trained on at most, about, and their bytes at most, about, in each class of lengths.
TRAIN_ROWS = 4000
TRAIN_BYTES = 4 << 20
LANDMARKS = 256
NEGATIVES = 6000
ROUNDS = 4
#: Offsets of the later characters from the first.
GAPS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4), (1, 2, 3), (2, 3, 4), (1, 3, 4), (1, 2, 4), (2, 4, 6))
DECAY = 0.6
HASH_BITS = 20
#: Longer words are read in overlapping pieces of that length, from each STEP-th character.
LONG = 16
PIECE = 12
STEP = 3
CACHE_WORDS = 400_000
FACTORS = tuple(np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64))

NOT_WORD = re.compile(r"[\W_]+")
SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")


def words_of(text: str) -> set[str]:
    """The distinct words of a text as the kernel sees them."""
    text = text.lower()
    own = set(text.split())
    own.update("".join(run.split()) for run in SPACED.findall(text))
    out = {w if w.isalnum() else NOT_WORD.sub("", w) for w in own}
    out.discard("")
    for w in [w for w in out if len(w) > LONG]:
        out.discard(w)
        out.update(w[at : at + PIECE] for at in range(0, len(w) - PIECE + STEP, STEP))
    return out


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(index of the word, hashed subsequence, weight) for each gap pattern."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    chars = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    ahead = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(chars))
    for gaps in GAPS:
        last = gaps[-1]
        if len(chars) <= last:
            continue
        n = len(chars) - last
        h = chars[:n] * FACTORS[0]
        for k, o in enumerate(gaps, 1):
            h = h + chars[o : o + n] * FACTORS[k]
        h = h ^ (h >> np.uint64(31))
        h = (h * FACTORS[0]) >> np.uint64(64 - HASH_BITS)
        fits = ahead[:n] > last
        yield word[:n][fits], h[fits].astype(np.int64), DECAY ** (last - len(gaps))


def norms(words: list[str]) -> np.ndarray:
    """Square root of the summed squared weights; it depends on the length alone."""
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    total = sum(np.maximum(0, n - g[-1]) * DECAY ** (2 * (g[-1] - len(g))) for g in GAPS)
    return np.sqrt(np.maximum(total, 1e-9))


def project(words: list[str], weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words))
    for word, h, decay in features(words):
        total += np.bincount(word, weights[h] * decay, len(words))
    return total / norms(words)


def dense(words: list[str], columns: np.ndarray, width: int) -> np.ndarray:
    """Normalised feature vectors over the hashed subsequences that `columns` numbers."""
    out = np.zeros((len(words), width))
    for word, h, decay in features(words):
        c = columns[h]
        has = c >= 0
        np.add.at(out, (word[has], c[has]), decay)
    return out / norms(words)[:, None]


def kernel(words: list[str], columns: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel values of words against landmarks; `marks` has a row for each numbered subsequence."""
    out = np.zeros((len(words), marks.shape[1]))
    for word, h, decay in features(words):
        c = columns[h]
        word, c = word[c >= 0], c[c >= 0]
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] += decay * np.add.reduceat(marks[c], first)
    return out / norms(words)[:, None]


def squared_hinge(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights, the last one the bias, of a linear machine in the primal, by Newton steps on the active rows."""
    z = np.c_[z, np.ones(len(z))]
    w = np.zeros(z.shape[1])
    reg = ridge * np.eye(len(w))
    reg[-1, -1] = 1e-6
    active = None
    for _ in range(25):
        now = y * (z @ w) < 1
        if active is not None and np.array_equal(now, active):
            break
        active = now
        za, ca = z[active], cost[active]
        w = np.linalg.solve(reg + (za * ca[:, None]).T @ za, za.T @ (ca * y[active]))
    return w


@dataclass
class Model:
    """Weight of each hashed subsequence, and the logistic curve over the worst word's decision."""

    weights: np.ndarray
    slope: float
    shift: float

    def words(self, words: list[str]) -> np.ndarray:
        return project(words, self.weights)

    def score(self, decided: np.ndarray) -> np.ndarray:
        total = self.slope * decided + self.shift
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(texts: Iterable[str], y: np.ndarray, seed: int = 0) -> Model:
    """Fit on texts and their 0/1 labels. Without both classes every text gets the share of class 1."""
    size = 1 << HASH_BITS
    if not len(y) or y.min() == y.max():
        share = float(np.mean(y)) if len(y) else 0.0
        return Model(np.zeros(size), 0.0, 30.0 if share == 1 else -30.0)
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    bags = [np.array([index.setdefault(w, len(index)) for w in sorted(words_of(t))], np.int64) for t in texts]
    flat = np.concatenate(bags)
    words = list(index)
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    seen = [np.bincount(flat[y[doc] == c], minlength=len(words)) for c in (0, 1)]
    # start: how much more often a subsequence stands in words of toxic texts
    steps = range(0, len(words), 20_000)
    often = [np.zeros(size), np.zeros(size)]
    for s in steps:
        for word, h, _ in features(words[s : s + 20_000]):
            for c in (0, 1):
                often[c] += np.bincount(h, seen[c][s:][word], size)
    total = [o.sum() + 1 for o in often]
    odds = np.log((often[1] + 0.5) / total[1]) - np.log((often[0] + 0.5) / total[0])
    # rare subsequences prove little
    odds *= (often[0] + often[1]) / (often[0] + often[1] + 4)
    value = np.concatenate([project(words[s : s + 20_000], odds) for s in steps])
    weights = odds
    bad = np.flatnonzero(y == 1)
    clean = np.flatnonzero((seen[0] > 0))
    for _ in range(ROUNDS):
        best = np.full(len(bags), -np.inf)
        np.maximum.at(best, doc, value[flat])
        at = np.flatnonzero((value[flat] >= best[doc]) & np.isin(doc, bad))
        witness, times = np.unique(flat[at], return_counts=True)
        hard = clean[np.argsort(-value[clean], kind="stable")[: NEGATIVES // 2]]
        negative = np.unique(np.r_[hard, rng.choice(clean, min(len(clean), NEGATIVES // 2), replace=False)])
        # a word that clean texts have more often than toxic ones is no witness
        fair = seen[1][witness] > seen[0][witness]
        if fair.any():
            witness, times = witness[fair], times[fair]
        negative = np.setdiff1d(negative, witness)
        top = witness[np.argsort(-times, kind="stable")[: LANDMARKS // 2]]
        marks = [words[i] for i in np.r_[top, rng.choice(negative, min(len(negative), LANDMARKS - len(top)), replace=False)]]
        own = np.unique(np.concatenate([h for _, h, _ in features(marks)]))
        columns = np.full(size, -1)
        columns[own] = np.arange(len(own))
        basis = dense(marks, columns, len(own))
        e, v = np.linalg.eigh(basis @ basis.T)
        good = e > 1e-6 * e.max()
        root = (v[:, good] / np.sqrt(e[good]))
        rows = [words[i] for i in np.r_[witness, negative]]
        marked = np.ascontiguousarray(basis.T)
        against = np.concatenate([kernel(rows[s : s + 1000], columns, marked) for s in range(0, len(rows), 1000)])
        sign = np.r_[np.ones(len(witness)), -np.ones(len(negative))]
        cost = np.r_[np.minimum(times, 20.0), np.minimum(seen[0][negative], 20.0)]
        cost = np.where(sign > 0, cost / cost[sign > 0].sum(), cost / max(1e-9, cost[sign < 0].sum())) * len(rows) / 10
        w = squared_hinge(against @ root, sign, cost)
        weights = np.zeros(size)
        weights[own] = basis.T @ (root @ w[:-1])
        value = np.concatenate([project(words[s : s + 20_000], weights) for s in steps])
    decision = np.zeros(len(bags))
    np.maximum.at(decision, doc, value[flat])
    slope, shift = logistic(decision[:, None], y)
    return Model(weights, max(0.0, slope), shift)


def logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Slopes and shift of a logistic curve, with targets drawn in from 0 and 1."""
    ones = y.sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-6 * np.eye(len(w)), a.T @ (target - p) - 1e-6 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on about `rows` labelled texts of any length that are not held out, `bounded` by their bytes."""
    got = bounded(labelled_sample(docs, labels, "toxic", rows)).select("text", "y").orderBy(F.xxhash64("text")).collect()
    return train((r["text"] for r in got), np.array([r["y"] for r in got], np.int64))


def bounded(sample: DataFrame, budget: int = TRAIN_BYTES) -> DataFrame:
    """`sample` (text, y), thinned by a hash of the text so that each class of lengths holds about `budget` bytes.

    Classes are powers of four, so long texts keep a share of their own instead of filling or leaving the sample.
    """
    sized = sample.withColumns({
        "bytes": F.octet_length("text").cast("long"),
        "class": F.floor(F.log2(F.octet_length("text") + F.lit(1)) / 2),
    })
    sums = sized.groupBy("class").agg(F.sum("bytes").alias("total"))
    share = F.floor(F.least(F.lit(1.0), F.lit(budget) / F.greatest(F.col("total"), F.lit(1))) * 2**32)
    edges = {r["class"]: r["edge"] for r in sums.select("class", share.alias("edge")).collect()}
    if not edges:
        return sample
    edge = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in edges.items() for x in pair]), F.col("class"))
    return sized.where(F.pmod(F.xxhash64("text", F.lit("bytes")), F.lit(2**32)) < edge).select(*sample.columns)


def decisions(texts: list[bytes | None], model: Model, known: dict[str, float]) -> np.ndarray:
    """For each text the worst word's decision, at least 0; `known` remembers words."""
    out = np.zeros(len(texts))
    for s, e in doc_groups(texts, 2 << 20):
        bags = [words_of((t or b"").decode("utf-8", "replace")) for t in texts[s:e]]
        if len(known) > CACHE_WORDS:
            known.clear()
        new = list(set().union(*bags).difference(known))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            known.update(zip(part, model.words(part).tolist()))
        out[s:e] = [max(0.0, max(map(known.__getitem__, b), default=0.0)) for b in bags]
    return out


def _shared(spark, model: Model):
    """The model for tasks; its size is that of the hash table, whatever the data."""
    return spark.sparkContext.broadcast((model.weights.astype(np.float32), model.slope, model.shift))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (doc_id, text) as (doc_id, score). Null and empty texts have no word and the decision 0."""
    shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(*shared.value), {}
        for batch in batches:
            score = own.score(decisions(utf8(batch.column(1)), own, known))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `docs` whose text scores below `threshold`, with all their columns."""
    shared = _shared(docs.sparkSession, model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(*shared.value), {}
        for batch in batches:
            clean = own.score(decisions(utf8(batch.column(at)), own, known)) < threshold
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of `docs`, repeated rows and null ids included.

    Null and empty texts score as texts without words; without labels of both kinds all scores are near 0 or 1. An
    empty table gives an empty one.
    """
    out = scored(docs, fit(docs, labels))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
