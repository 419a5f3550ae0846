"""Text quality by a generalised additive model with pairwise interactions.

Each text is described by a few counts and ratios. Cyclic boosting visits the features in turn and fits a tree of
depth two to the current gradient over that feature's bins; the sum of its trees is a lookup table per feature.
Then the pairs whose two-way split lowers the remaining loss most get a table over both features' bins in the
same way. A score is the logistic of the sum of the looked-up entries, added for whole batches at once.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import doc_groups, held_out, labelled_sample, utf8

#: Labelled texts trained on at most, and the length up to which a text serves for training.
TRAIN_ROWS = 8000
TRAIN_CHARS = 50_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.15
#: Rows a leaf must hold.
LEAF_ROWS = 10

FEATURES = (
    "log_words", "word_length", "distinct_share", "stutter_share", "letter_share", "digit_share", "symbol_share", "bar_share",
    "comma_share", "stop_share", "upper_share", "lines_per_word", "distinct_lines", "long_word_share", "short_word_share", "markup_share",
)
OTHER = re.compile(rb"[a-zA-Z\x80-\xff\s]+")


def describe(text: bytes) -> list[float]:
    """The features of one text; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    rest = OTHER.sub(b"", text)
    digits = sum(rest.count(d) for d in (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))
    commas, stops, bars = rest.count(b","), rest.count(b".") + rest.count(b"!") + rest.count(b"?"), rest.count(b"|")
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    lower = text.lower()
    upper = sum(a[:1] != b[:1] for a, b in zip(words, lower.split()))
    return [
        float(np.log1p(n)), float(lengths.mean()), len(set(words)) / n, stutter / n, 1 - len(rest) / size, digits / size,
        (len(rest) - digits - commas - stops - bars) / size, bars / n, commas / n, stops / n, upper / n, len(lines) / n,
        len(set(lines)) / max(1, len(lines)), float((lengths > 15).mean()), float((lengths <= 3).mean()),
        (rest.count(b"<") + rest.count(b"{") + rest.count(b"&") + rest.count(b"#") + rest.count(b"*")) / n,
    ]


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([describe(t or b"") for t in texts]).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """Bin edges and a table per feature, tables per pair of features, and the constant."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], "right")]
        for i, j, left, right, table in self.pairs:
            total += table[np.searchsorted(left, x[:, i], "right"), np.searchsorted(right, x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cut(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Best split of ordered bins by summed gradients and weights: its gain and the first bin of the right side."""
    g, h, n = np.cumsum(gain)[:-1], np.cumsum(weight)[:-1], np.cumsum(rows)[:-1]
    total, mass, count = gain.sum(), weight.sum(), rows.sum()
    value = g**2 / (h + 1) + (total - g) ** 2 / (mass - h + 1) - total**2 / (mass + 1)
    value = np.where((n >= LEAF_ROWS) & (count - n >= LEAF_ROWS), value, -np.inf)
    if not len(value) or not np.isfinite(value.max()):
        return 0.0, 0
    return float(value.max()), int(value.argmax()) + 1


def tree(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of each bin of a tree over ordered bins."""
    best, at = cut(gain, weight, rows) if depth else (0.0, 0)
    if best <= 1e-9:
        return np.full(len(gain), gain.sum() / (weight.sum() + 1))
    parts = [tree(gain[s], weight[s], rows[s], depth - 1) for s in (slice(None, at), slice(at, None))]
    return np.concatenate(parts)


def pair_tree(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int = 2) -> tuple[float, np.ndarray]:
    """The same over a grid: each step splits along the better axis. Returns gain and the grid of leaf values."""
    found = [cut(gain.sum(1 - a), weight.sum(1 - a), rows.sum(1 - a)) for a in (0, 1)] if depth else [(0.0, 0)]
    axis = int(len(found) == 2 and found[1][0] > found[0][0])
    best, at = found[axis]
    if best <= 1e-9:
        return 0.0, np.full(gain.shape, gain.sum() / (weight.sum() + 1))
    parts = []
    for part in (slice(None, at), slice(at, None)):
        box = (part, slice(None)) if axis == 0 else (slice(None), part)
        parts.append(pair_tree(gain[box], weight[box], rows[box], depth - 1))
    return best + parts[0][0] + parts[1][0], np.concatenate([p[1] for p in parts], axis=axis)


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on features and 0/1 labels. Without both classes every text gets the share of class 1."""
    share = float(np.mean(y)) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Model(30.0 if share else -30.0)
    model = Model(float(np.log(share / (1 - share))))

    def edges_of(k: int, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x[:, k], np.arange(1, bins) / bins))

    width = x.shape[1]
    model.edges = [edges_of(k, BINS) for k in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.edges)]
    total = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * tree(*(np.bincount(bins[k], w, size) for w in (g, h, np.ones(len(y)))))
            model.tables[k] += step
            total += step[bins[k]]
    coarse = [edges_of(k, PAIR_BINS) for k in range(width)]
    places = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(coarse)]

    def grids(i: int, j: int) -> list[np.ndarray]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = places[i] * shape[1] + places[j]
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (*slopes(), np.ones(len(y)))]

    ranked = sorted(itertools.combinations(range(width), 2), key=lambda p: -pair_tree(*grids(*p))[0])
    chosen = {p: np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1)) for p in ranked[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (i, j), grid in chosen.items():
            step = RATE * pair_tree(*grids(i, j))[1]
            grid += step
            total += step[places[i], places[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], grid) for (i, j), grid in chosen.items()]
    return model


def described(docs: DataFrame, extra: list[str]) -> DataFrame:
    """The columns `extra` and the features of each text as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(len(extra)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(extra)], pa.array(list(matrix(texts)), pa.list_(pa.float64()))], names=[*extra, "features"]
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    return docs.select(*extra, F.col("text").cast("string")).mapInArrow(run, f"{kinds}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on at most about `rows` labelled texts that are not held out and no longer than TRAIN_CHARS bytes."""
    own = labelled_sample(docs.where(F.octet_length("text") <= TRAIN_CHARS), labels, "quality", rows)
    got = described(own, ["y"]).collect()
    # sums of floats depend on their order: sort, so that a run repeats itself
    got.sort(key=lambda r: (r["features"], r["y"]))
    return train(np.array([r["features"] for r in got]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in got], np.float64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            parts = [model.score(matrix(texts[s:e])) for s, e in doc_groups(texts)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of `docs`, repeated rows and null ids included.

    A null text counts as empty; a text without words has all features 0. Labels of null ids, null labels and
    labels without a text teach nothing; without any label of both kinds all scores are 0 or 1.
    """
    out = scored(docs, fit(docs, labels))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
