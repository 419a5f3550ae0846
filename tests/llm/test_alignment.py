"""Alignment against tokenizing whole texts and pairing tokens by their ends."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from motorpool.llm import alignment
from motorpool.llm.common import table
from motorpool.llm.queries import tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "a  b", "  x\n y", "\n\n  a \t b\r\n c ", " ", "   ", "a b c　 d", "<|endoftext|> <s> a", "don't 's 12'll\n 's", "a\n", "a \n b ",
    "日本語 テ", "é ́", "\U0001f600 \U0001f469‍\U0001f52c", "x" * 3000, "word " * 3000, "\x00 a\x00", "᠎ a", "<0x41> A",
]


@pytest.fixture(scope="module")
def words():
    return alignment.Vocabularies(*FILES)


def ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def brute(words, texts):
    """Rows of `COLUMNS`, from whole texts."""
    docs, pairs = [], Counter()
    for text in texts:
        told = b" " + (text or "").encode()
        a, b = words.a.encode(" " + (text or ""), add_special_tokens=False).ids, words.b.encode(text or "")
        x, y = [words.a_bytes[i] for i in a], [words.b_bytes[i] for i in b]
        if not text or b"".join(x) != told or b"".join(y) != told:
            docs.append(([], [], [], [], []))
            continue
        end_a, end_b = ends(x), ends(y)
        links = [(a[end_a.index(e)], b[end_b.index(e)]) for e in end_a if e in set(end_b)]
        cuts = sorted(set(end_a) & set(end_b))
        groups = [
            ([i for i, e in zip(a, end_a) if s < e <= t], [i for i, e in zip(b, end_b) if s < e <= t]) for s, t in zip([0, *cuts], cuts)
        ]
        docs.append((a, b, groups, links, text))
        pairs.update(links)
    best = {}
    for (_, b), n in pairs.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for a, b, groups, links, text in docs:
        told = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        sha = hashlib.sha256(told.encode()).hexdigest() if text else ""
        counts = [pairs[p] for p in links]
        out.append((len(a), len(b), len(groups), len(links), sum(n == best[p[1]] for n, p in zip(counts, links)), sum(counts), sha))
    return out


def found(docs):
    return sorted((r.doc_id if r.doc_id is not None else -1, *[r[c] for c in COLUMNS]) for r in alignment.align(docs, *FILES).collect())


def expected(words, ids, texts):
    return sorted((i if i is not None else -1, *row) for i, row in zip(ids, brute(words, texts)))


def test_byte_letters_are_those_of_the_file(words):
    from tokenizers import pre_tokenizers

    assert set(alignment.byte_letters()) == set(pre_tokenizers.ByteLevel.alphabet())
    shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    letters = alignment.byte_letters()
    text = "".join(map(chr, range(1, 0x800)))
    assert bytes(letters[c] for s, _ in shown(text) for c in s) == text.encode()


def test_units_give_what_whole_texts_give(words):
    draw = random.Random(5)
    texts = ODD + ["".join(draw.choice(" \n\t\r a b'1.é　 #́\U0001f600") for _ in range(draw.randrange(50))) for _ in range(2000)]
    aligner = alignment.Aligner(words)
    n_a, n_b, n_links, shas, _ = aligner.align([t.encode() for t in texts])
    want = [(w[0], w[1], w[3], w[6]) for w in brute(words, texts)]
    assert [*zip(n_a, n_b, n_links, shas)] == want


def test_edge_cases(spark, docs_of, words, monkeypatch):
    texts = [None, "", *ODD, "a▁b", "same text here", "same text here", "same text here"]
    ids = [None, *range(1, len(texts) - 2), len(texts) - 3, None]
    docs = docs_of(texts, ids).withColumns({"block": F.lit("x"), "pairs": F.lit(1), "n_a": F.lit(2)})
    assert found(docs) == expected(words, ids, texts)
    assert found(docs.limit(0)) == []


def test_whole_table_in_small_blocks(spark, small, words, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(alignment, "GROUP_BYTES", 5_000)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 500)
    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    docs = table(spark, small, "documents")
    assert found(docs) == expected(words, [r.doc_id for r in rows], [r.text for r in rows])


def test_irregular_pairs_only_are_shuffled(spark, small, words):
    blocks = alignment.encode(table(spark, small, "documents"), *FILES).withColumn("block", F.monotonically_increasing_id())
    size = len(words.b_bytes)
    pairs = [r.pair for r in alignment._odd_rows(blocks).collect()]
    assert pairs and not any(words.same[p // size] == p % size for p in pairs)
