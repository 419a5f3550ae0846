"""The filter audit against applying every filter to every document in every order."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from motorpool.llm import filter_audit
from motorpool.llm.common import table

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int"


def failed(text, i, first):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    marks = [
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search(r"[#$%&*|]", text)), i is not None and text in first and first[text] < i,
    ]
    return {f for f, m in zip("ABCDE", marks) if m}


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    rows = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good, toxic = ({r[0] for r in labels if r[k] == 1 and r[0] is not None} for k in (1, 2))
    fails = [(s, failed(t, i, first), i in good, i in toxic) for i, t, s in rows]
    out = {}
    for part in {s for s, *_ in fails}:
        own = [f for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                shapley[name] += len(gone)
                fail = [f for f in own if name in f[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fail) - len(gone), sum(f[1] == {name} for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone)
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found(docs, labels):
    rows = filter_audit.audit(filter_audit.mask_counts(docs, labels)).collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in rows}
    assert len(out) == len(rows)
    return out


def test_edge_cases(spark, docs_of):
    prose = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", "", prose, prose, prose, prose + " #", "A" * 9, prose, "w " * 90, "É" * 30 + "B", "x\x0by\x1cz", prose, "\x85 \xa0"]
    ids = [None, 7, 3, 5, 5, 2, 8, 9, None, 10, 11, 12, 13, 14]
    sources = ["a", "a", None, "a", "b", "b", "", "b", "a", "b", "b", "a", "a", "c"]
    docs = docs_of(texts, ids, sources).withColumns({"mask": F.lit("x"), "h": F.lit("y"), "part": F.lit(1), "n": F.lit(2)})
    told = [(5, 1, 0), (5, 0, 1), (13, 1, 1), (None, 1, 1), (99, 1, 1), (8, None, 1), (3, 1, None)]
    want = brute([*zip(ids, texts, sources)], told)
    assert found(docs, spark.createDataFrame(told, LABELS)) == want
    assert found(docs.limit(0), spark.createDataFrame([], LABELS)) == {}
    none = spark.createDataFrame([], LABELS)
    assert found(docs, none) == brute([*zip(ids, texts, sources)], [])


def test_whole_table(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert found(docs, labels) == brute(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


@pytest.mark.parametrize("size", [7, 8, 9, 10])
def test_words_of_long_texts(monkeypatch, size):
    monkeypatch.setattr(filter_audit, "PIECE_BYTES", size)
    for text in (b"aa bb  aa " * 9, b"abcdefgh" * 9, b"ab cdefg hijk abcdefghi j", b" " * 40, b"a" * 8 + b" " * 8 + b"a" * 8):
        assert filter_audit.word_counts(text) == (len(text.split()), len(set(text.split())))


def test_prepass_clears_unique_texts_and_keeps_repeats(spark, docs_of):
    texts = [f"text {i}" for i in range(3000)] + [f"text {i}" for i in range(0, 3000, 60)]
    flagged = filter_audit.flags(docs_of(texts))
    twice, words = filter_audit.sketch(flagged, len(texts))
    kept = {r.doc_id for r in filter_audit.possible_repeats(flagged, twice, words).collect()}
    again = {i for i, t in enumerate(texts) if texts.count(t) > 1}
    assert again <= kept and len(kept) < len(again) + 0.05 * len(texts)
