"""SimHash links and components against all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from motorpool.llm import simhash
from motorpool.llm.components import components


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def some_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "one", "one", "ONE", "a b c", "a b c d e", "É é É é", "x" * 50_000, "no break here"]
    for _ in range(25):
        text = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        texts.append(" ".join(text))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
            texts.append("  ".join(text))
    return texts + [" ".join(words * 30)]


def test_report_equals_all_pairs(docs_of):
    texts = some_texts()
    got = {r.doc_id: r for r in simhash.near_duplicate_report(docs_of(texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = roots(range(len(texts)), links)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{f:016x}", root[i]) for i, f in enumerate(fps)}
    assert len(links) > 30


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = simhash.fingerprint_of(text.encode())
    monkeypatch.setattr(simhash, "VOTE_ROWS", 7)
    assert simhash.fingerprint_of(text.encode()) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("n", [1, 2, 700, 3000])
def test_index_finds_all_links(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, 5), dtype=np.uint64), axis=1)
    fp = np.unique(np.r_[base, base[: n // 2] ^ flips[: n // 2]])
    top = np.zeros(len(fp), np.int64)
    order = np.argsort(simhash.gray_rank(fp))
    lab = simhash.linked(fp[order], top, 4)
    links = [(i, j) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp[order][i] ^ fp[order]) <= 4) if i < j]
    assert lab.tolist() == list(roots(range(len(fp)), links).values())


@pytest.mark.parametrize("n", [10, 10**6, 10**9])
def test_any_four_bits_leave_a_mask_untouched(n):
    found = simhash.masks(n)
    rng = random.Random(n)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not diff & m for m in found)


def test_a_hot_top_node_is_cut_into_blocks(spark):
    fps = [1 << i for i in range(40)] + [0, 2**62 + 3]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, block_rows=5)
    got = {r.node: r.root for r in components(links).collect()}
    assert set(got) == {f for f in fps if f != 2**62 + 3} | ({2**62 + 3}) and set(got.values()) == {0}


def test_one_row_of_each_group_stays(docs_of, spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(90))
    docs = docs_of([long, long, "other words here", None, "", long], ids=[7, 3, 5, 9, 8, 3])
    docs = docs.withColumns({"row_id": F.lit("x"), "fp": F.lit(1), "root": F.lit(2)})
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 8]
    # the same rows as a scan of files, and as one scan twice
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    for frame in (stored, stored.union(stored), stored.where("doc_id IS NOT NULL OR true")):
        assert sorted(r.doc_id for r in simhash.drop_near_duplicates(frame).collect()) == [3, 5, 8]
    empty = docs.limit(0)
    assert simhash.drop_near_duplicates(empty).count() == 0
    assert simhash.near_duplicate_report(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    df = spark.createDataFrame(chain + star + [(5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}
