"""Toxicity and quality: held-out accuracy on the given labels, and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.llm import quality, toxicity
from motorpool.llm.common import labelled_sample, table

EDGES = [None, "", " \n\t", "x" * 30_000, "é " * 5000, "word", "word", "a b c d e f g"]


def area(y, score):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        ranks[score == v] = ranks[score == v].mean()
    ones = y.sum()
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("operator, label, least", [(toxicity.toxicity, "toxic", 0.9), (quality.quality, "quality", 0.98)])
def test_held_out_labels(spark, operator, label, least):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = operator(docs, labels).join(labels, "doc_id").where(F.col(label).isNotNull()).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    y, score = np.array([r[label] for r in held]), np.array([r.score for r in held])
    assert area(y, score) >= least and ((score >= 0) & (score <= 1)).all()


@pytest.mark.parametrize("operator, threshold", [(toxicity.toxicity, 0.5), (quality.quality, 0.3)])
def test_every_row_gets_a_score(spark, docs_of, operator, threshold):
    texts = EDGES + [f"some text number {i} with more words" for i in range(30)]
    docs = docs_of(texts, ids=[None, *range(1, 7), 6, *range(8, len(texts))]).withColumns({"score": F.lit("x"), "held_out": F.lit(1), "y": F.lit(2)})
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8, 30)] + [(None, 1, 1), (9, None, None), (9, 1, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        rows = operator(docs, given).collect()
        assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    assert operator(docs.limit(0), labels).count() == 0


def test_held_out_and_null_labels_teach_nothing(spark, docs_of):
    docs = docs_of([f"t{i}" for i in range(100)])
    labels = spark.createDataFrame([(i, 1 if i % 3 else None) for i in range(100)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 1000).collect()
    want = {i for i in range(100) if i % 3 and zlib.crc32(str(i).encode()) % 5}
    assert {r.doc_id for r in got} == want
    assert len(labelled_sample(docs, labels, "toxic", 10).collect()) < 30


def test_gapped_and_changed_insults_are_found():
    rng = random.Random(0)
    plain = [f"{a}{b}{c}" for a in ("an", "re", "tion", "the", "er") for b in ("st", "ou", "nd", "") for c in ("in", "es", "ly", "or")]
    insults = ["blockhead", "numskull", "dimwit"]
    texts, y = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(8, 60))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        texts.append(" ".join(words))
        y.append(int(i % 4 == 0))
    model = toxicity.train(texts, np.array(y))
    say = lambda w: f"the rein {w} anstin reoues theor"
    score = lambda t: model.score(toxicity.decisions([t.encode()], model, {}))[0]
    for word in ("blockhead", "BLOCKHEAD!", "b-l-o-c-k-h-e-a-d", "b l o c k h e a d", "blockxhead", "numsskull", "dimw.it", "numskulls", "x" * 60 + "blockhead" + "y" * 60):
        assert score(say(word)) > 0.5, word
    for word in ("reston", "ouandes", "erinly", ""):
        assert score(say(word)) < 0.5, word


def test_score_does_not_fall_with_length():
    rng = random.Random(3)
    clean = lambda n: [rng.choice("the river runs past our old mill and green hills".split()) + rng.choice("abcdef") for _ in range(n)]
    texts = [" ".join(clean(rng.randint(5, 80)) + ["numskull"] * (i % 4 == 0)) for i in range(400)]
    model = toxicity.train(iter(texts), np.array([int(i % 4 == 0) for i in range(400)]))
    long = " ".join(clean(60_000))
    for text, want in ((long + " numskull", 1), (long, 0), ("numskull", 1)):
        assert (model.score(toxicity.decisions([text.encode()], model, {}))[0] > 0.5) == want


def test_sample_is_bounded_in_each_class_of_lengths(docs_of):
    docs = docs_of([f"{i} " + "w" * (10 if i % 2 else 40_000) for i in range(400)]).withColumn("y", F.lit(1))
    assert toxicity.bounded(docs.select("text", "y"), 10**9).count() == 400
    got = [len(r.text) for r in toxicity.bounded(docs.select("text", "y"), 2_000_000).collect()]
    assert sum(n < 100 for n in got) == 200 and 20 <= sum(n > 100 for n in got) <= 90
    assert toxicity.bounded(docs.limit(0).select("text", "y")).count() == 0


def test_folded_weights_are_the_kernel_pair_by_pair():
    """Kernel values by listing every gapped subsequence of both words, against the hashed features."""

    def plain(word):
        text, out = f"^{word}$", {}
        for gaps in toxicity.GAPS:
            for at in range(len(text) - gaps[-1]):
                key = "".join(text[at + o] for o in (0, *gaps)) + str(gaps)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (gaps[-1] - len(gaps))
        return out

    def of_patterns(a, b):
        """Equal characters count as the same subsequence whatever gap pattern made them."""
        merge = lambda p: {k: sum(v for o, v in p.items() if o.split("(")[0] == k) for k in {o.split("(")[0] for o in p}}
        x, y = merge(plain(a)), merge(plain(b))
        return sum(x[k] * y[k] for k in x.keys() & y.keys())

    words, marks = ["idiot", "idxiot", "clown", "é", "abracadabra", "idiots"], ["idiot", "clowns", "abra"]
    own = np.unique(np.concatenate([h for _, h, _ in toxicity.features(marks)]))
    columns = np.full(1 << toxicity.HASH_BITS, -1)
    columns[own] = np.arange(len(own))
    basis = toxicity.dense(marks, columns, len(own))
    got = toxicity.kernel(words, columns, np.ascontiguousarray(basis.T))
    length = lambda w: float(toxicity.norms([w])[0])
    want = np.array([[of_patterns(w, m) / length(w) / length(m) for m in marks] for w in words])
    assert np.allclose(got, want)
    folded = np.zeros(1 << toxicity.HASH_BITS)
    folded[own] = basis.T @ np.array([0.5, -2.0, 1.0])
    assert np.allclose(toxicity.project(words, folded), want @ np.array([0.5, -2.0, 1.0]))


def test_toxic_rows_leave_with_their_columns(docs_of):
    model = toxicity.train(["you fool", "dear friend", "what a fool", "hello there"] * 10, np.array([1, 0, 1, 0] * 10))
    docs = docs_of(["a fool!", "a friend", None, ""]).withColumn("score", F.lit("kept"))
    out = toxicity.without_toxic(docs, model)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 3]


def test_additive_model_learns_a_product():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and model.pairs[0][:2] == (0, 1)


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((500, 3))
    model = quality.train(x, (x[:, 2] > 0.4).astype(float))
    total = model.start + sum(t[np.searchsorted(e, x[7, k], "right")] for k, (e, t) in enumerate(zip(model.edges, model.tables)))
    total += sum(t[np.searchsorted(a, x[7, i], "right"), np.searchsorted(b, x[7, j], "right")] for i, j, a, b, t in model.pairs)
    assert model.score(x)[7] == pytest.approx(1 / (1 + np.exp(-total)))
