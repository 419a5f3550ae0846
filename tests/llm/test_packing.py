"""Packing: an exact round trip of ids, and how full the sequences get."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from motorpool.llm import packing
from motorpool.llm.queries import tokenizer_file


def ids_of(texts):
    plain = Tokenizer.from_file(tokenizer_file())
    return [np.array(e.ids + [2], "<u4") for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_every_id_lies_in_one_piece_and_sequences_have_no_gap(docs_of):
    rng = random.Random(3)
    texts = [None, "", " ", "Don't STOP", "it's<|endoftext|>x", "été Σας ΣΑΣ", "1234 ½ ؟!?", "​zero em", "x" * 9000, "a-b_c/d " * 7000]
    texts += [" ".join(f"word{rng.randrange(500)}" for _ in range(rng.randint(1, 900))) for _ in range(60)]
    docs = docs_of(texts).withColumns({"size": F.lit("x"), "rank": F.lit(1), "start": F.lit(2), "piece": F.lit(3)})
    rows = packing.pack(docs, tokenizer_file()).collect()
    want = ids_of(texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want[i]))
            assert r.ids_crc32 == zlib.crc32(want[i][at : at + r.length].tobytes()) and r.length > 0
            at += r.length
        assert at == len(want[i])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH


def test_repeated_rows_and_empty_tables(docs_of):
    rows = packing.pack(docs_of(["a b", "a b", "c"], ids=[1, 1, None]), tokenizer_file()).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 2), (1, 3), (1, 3)]
    assert packing.pack(docs_of([]), tokenizer_file()).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_patterns_cover_the_demand_exactly(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, [1, 5, 400, 30][seed] + 1, 64) * (rng.random(64) < 0.7)
    if seed >= 2:
        demand[20:] = 0
    plan = packing.patterns(demand)
    made = sum((c * n for c, n in plan), np.zeros(64, np.int64))
    assert (made == demand).all()
    assert all(n > 0 and (c * np.arange(1, 65)).sum() <= 64 for c, n in plan)
    if seed >= 2:
        # small sizes leave hardly any room
        assert sum(n for _, n in plan) <= 1.01 * (demand * np.arange(1, 65)).sum() / 64 + 3


def test_knapsack_equals_brute_force():
    value = np.array([1.0, 3.0, 4.2, 5.0])
    best, counts = packing.knapsack(value, 11)
    brute = max(a + 3 * b + 4.2 * c + 5 * d for a in range(12) for b in range(6) for c in range(4) for d in range(3) if a + 2 * b + 3 * c + 4 * d <= 11)
    assert best == pytest.approx(brute) == pytest.approx((counts * value).sum()) and (counts * np.arange(1, 5)).sum() <= 11


def test_tasks_of_a_worker_share_what_it_has_encoded(spark, monkeypatch):
    """Ids stay right when the memory is full and words come back from the older one."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 30)
    monkeypatch.setattr(packing, "CACHE_PARTS", 20)
    encoder, made = packing.WordEncoder(tokenizer_file()), []
    monkeypatch.setattr(encoder, "word", lambda w, f=encoder.word: made.append(w) or f(w))
    rng = random.Random(5)
    words = [f"w{rng.randrange(10 ** rng.randrange(1, 4))}-x" for _ in range(400)]
    want = {w: ids.tobytes() for w, ids in zip(words, (i[:-1] for i in ids_of(words)))}
    for at in range(0, len(words), 10):
        own = [w.encode() for w in words[at : at + 10]] + [b"often"]
        ids = encoder.ids_of(own)
        assert all(ids[w] == want[w.decode()] for w in own[:-1])
    assert made.count(b"often") == 1 and len(encoder.known) <= 41 and len(encoder.older) <= 41

    def seen(batches):
        for batch in batches:
            yield batch.from_arrays([pa.array([id(packing.worker_encoder(tokenizer_file()))])], names=["id"])

    rows = spark.range(4, numPartitions=1).union(spark.range(4, numPartitions=1)).coalesce(1)
    assert rows.mapInArrow(seen, "id long").distinct().count() == 1
