"""Mixing: exponents against a plain bisection, and budgets against what is drawn."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from motorpool.llm import mixing


def sources_of(spark, tokens):
    return spark.createDataFrame([(t, float(max(tokens))) for t in tokens], "tokens long, largest double")


def entropy(tokens, a):
    w = [t**a for t in tokens]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


@pytest.mark.parametrize("tokens", [[1000, 100, 10], [7, 7, 7], [10**9, 1], [5]])
def test_exponents(spark, tokens):
    own = sources_of(spark, tokens)
    a = mixing.exponent(own, repeats=2.0)
    most = max((t / max(tokens)) ** (a - 1) for t in tokens)
    assert most <= 2.0 + 1e-9
    assert a == 0 or (min(tokens) / max(tokens)) ** (a - 1e-5 - 1) > 2.0
    aim = 0.6 * math.log(len(tokens))
    a = mixing.exponent(own, repeats=None, entropy=aim)
    if entropy(tokens, 1.0) < aim:
        assert entropy(tokens, a) == pytest.approx(aim, abs=1e-4)
    else:
        assert a == pytest.approx(1.0, abs=1e-4)


def texts_of(sizes):
    return [f"{i:04d}" + "x" * (4 * n - 4) for i, n in enumerate(sizes)]


def test_nothing_is_left_out_and_weights_are_met(docs_of):
    sizes = [5 + i % 7 for i in range(900)]
    sources = ["big" if i % 3 else ["small", None, "mid", "mid"][i % 4] for i in range(900)]
    docs = docs_of(texts_of(sizes), sources=sources).withColumns({"k": F.lit(1), "h": F.lit(2), "tokens": F.lit("x"), "epoch": F.lit("y"), "blocks": F.lit(0)})
    out, names = mixing.mix(docs, repeats=1.7, block_tokens=100)
    rows = out.collect()
    assert set(docs.columns) <= set(out.columns)
    assert {r.doc_id for r in rows} == set(range(900))
    own, drawn, passes = Counter(), Counter(), {}
    for s, n in zip(sources, sizes):
        own[s] += n
    for r in rows:
        drawn[r.source] += r[names["tokens"]]
        passes[r.source] = r[names["passes"]]
    assert max(passes.values()) == pytest.approx(1.7, abs=1e-3) and passes["big"] == 1
    for s, n in own.items():
        assert 0 <= passes[s] * n - drawn[s] <= max(sizes) + 1
    seen = Counter((r.doc_id, r[names["epoch"]]) for r in rows)
    assert set(seen.values()) == {1}
    times = Counter(r.doc_id for r in rows)
    assert set(times.values()) == {1, 2}


def test_a_budget_below_the_corpus_draws_part_of_it(docs_of):
    docs = docs_of(texts_of([10] * 400), sources=["a"] * 300 + ["b"] * 100)
    out, names = mixing.mix(docs, repeats=3.0, budget=1000.0, block_tokens=200)
    rows = out.collect()
    assert 960 <= sum(r[names["tokens"]] for r in rows) <= 1000
    assert max(Counter(r.doc_id for r in rows).values()) == 1


def test_edges(docs_of):
    rows = mixing.mix(docs_of([None, "", "a", "a", "bb" * 9000], ids=[None, 1, 2, 2, 4], sources=["x", "y", None, None, ""]))[0].collect()
    assert sorted((r.doc_id or 0) for r in rows if r.doc_id in (None, 1)) == [0, 1]
    assert {r.doc_id for r in rows} == {None, 1, 2, 4} and sum(r.doc_id == 2 for r in rows) % 2 == 0
    assert mixing.mix(docs_of([]))[0].count() == 0
    assert mixing.mix(docs_of(["", None]))[0].count() == 2
