"""The pipeline: its stages by hand, and what becomes of planted cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from motorpool.llm import toxicity
from motorpool.llm.common import table
from motorpool.llm.queries import QUERIES

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_operators_are_registered():
    names = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    out, docs = [], table(spark, small, "documents")
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def test_all_but_the_last_stage_return_documents(stored):
    for name, df in list(stored.items())[:-1]:
        assert df.columns == DOCS, name


def test_toxic_rows_go_and_clean_rows_stay(spark, small, stored):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}
    assert {r.doc_id for r in stored["toxicity"].collect()} == {i for i, p in scores.items() if not p}


def test_one_of_each_group_of_copies_stays(stored):
    before = stored["toxicity"].collect()
    after = {r.doc_id: r.text for r in stored["simhash_dedup"].collect()}
    assert max(Counter(after.values()).values()) == 1
    assert {r.text for r in before if r.text} >= set(after.values())
    least = {}
    for r in before:
        least[r.text] = min(least.get(r.text, r.doc_id), r.doc_id)
    assert all(least[t] == i for i, t in after.items())


def test_mixing_leaves_nothing_out(stored):
    before, after = (Counter(r.doc_id for r in stored[n].collect()) for n in ("substring_dedup", "mixing"))
    assert set(before) == set(after) and set(after.values()) <= {1, 2}


def test_packing_holds_every_drawn_document(stored):
    drawn = Counter(r.doc_id for r in stored["mixing"].collect())
    first = Counter(r.doc_id for r in stored["packing"].where("start = 0").collect())
    assert first == drawn


def test_edge_cases_pass_every_stage(spark, small, docs_of):
    docs = docs_of([None, "", "  ", "same words here", "same words here", "w " * 40_000, "é ß"], ids=[None, 1, 2, 3, 3, 5, 6], sources=[None, "a", "a", "b", "b", None, ""])
    docs = docs.withColumns({"fp": F.lit(1), "tokens": F.lit("x"), "row_id": F.lit(2)})
    for start in (docs, docs.limit(0)):
        frame = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, small)
            if name != "packing":
                assert out.columns == docs.columns, name
                frame = out
        assert (out.count() > 0) == (start is docs)


def test_run_equals_the_stages(spark, small, stored):
    got = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(tuple, stored["packing"].select("doc_id", "start", "ids_crc32").collect()))
