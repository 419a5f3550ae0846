"""Repeated passages against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.llm import substrings


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def some_texts(window):
    rng = random.Random(window)
    words = [f"w{i}" for i in range(5000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    exact, more, less = say(window), say(window + 9), say(window - 1)
    texts = [None, "", "   ", "one", " ".join(exact), " ".join(say(20) + exact + say(30)), " ".join(less), " ".join(say(5) + less + say(5))]
    texts += [" ".join(say(rng.randint(0, 60)) + more + say(rng.randint(0, 60))) for _ in range(6)]
    texts += [" ".join(["la"] * (window + 3)), " ".join(say(3) + ["ba", "du"] * window), " ".join(say(40) + exact + say(7) + exact)]
    texts += [" ".join(say(400))] * 3 + [" ".join(say(300) + more * 2 + say(9000))]
    return texts + ["É é " * window, "a\x0bb\x0cc d"]


@pytest.mark.parametrize("window", [2, 14, 35])
def test_removal_equals_counting_windows(docs_of, window):
    texts = some_texts(window)
    docs = docs_of(texts).withColumns({"n_words": F.lit("x"), "key_a": F.lit(1), "places": F.lit(2), "A": F.lit(3), "b": F.lit(4)})
    out, names = substrings.remove_repeats(docs, window)
    assert set(docs.columns) <= set(out.columns)
    got = {r.doc_id: r for r in out.collect()}
    for i, (n, gone, sha, kept) in enumerate(brute(texts, window)):
        r = got[i]
        assert (r[names["n_words"]], r[names["n_removed"]], r["kept_sha256"]) == (n, gone, sha), i
        assert r.text == (kept if gone else texts[i])


def test_repeated_rows_and_null_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    out, _ = substrings.remove_repeats(docs_of([text, text, text, "short"], ids=[None, 1, 1, None]))
    assert sorted((r.doc_id or -1, r.n_removed) for r in out.collect()) == [(-1, 0), (-1, 50), (1, 50), (1, 50)]
    assert substrings.remove_repeats(docs_of([]))[0].count() == 0


@pytest.mark.parametrize("period", substrings.COVERS)
def test_covers_align_any_two_positions(period):
    cover = set(substrings.COVERS[period])
    for gap in range(period):
        assert all(any((i + k) % period in cover and (i + gap + k) % period in cover for k in range(period)) for i in range(period))


def test_rolling_hash_depends_on_the_words_alone():
    rng = np.random.default_rng(0)
    w = rng.integers(0, 2**63, 50, dtype=np.uint64)
    h = substrings.rolling(np.r_[w, w[10:40]], 20, substrings.BASES[0])
    assert (h[50:61] == h[10:21]).all() and len(set(h.tolist())) == len(h) - 11
