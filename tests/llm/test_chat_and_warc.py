"""Conversations and pages against DuckDB and plain Python."""

import gzip
import hashlib
import random
from base64 import b32encode
from io import BytesIO

import duckdb
import pytest
from pyspark.sql import functions as F

from motorpool.llm import chat, warc
from motorpool.llm.queries import ORACLES, QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    by = {}
    for conv, turn, role, text in set(rows):
        by.setdefault(conv, []).append((turn, role, text))
    key = lambda x: tuple((v is not None, v) for v in x)
    whole = {c: tuple((r, t) for _, r, t in sorted(v, key=lambda x: key(x))) for c, v in by.items()}
    begun = {t[:k] for t in whole.values() for k in range(1, len(t))}
    out = {}
    for c, t in whole.items():
        if t not in begun:
            out.setdefault(t, []).append(c)
    return sorted(((min((c for c in cs if c is not None), default=None), len(t), len(cs)) for t, cs in out.items()), key=repr)


def test_snapshots_collapse(spark):
    rng = random.Random(4)
    rows = []
    for i in range(30):
        turns = [(k, ["user", "assistant", None][rng.randrange(3)], rng.choice(["hi", "", None, "long " * 2000, f"t{i}"])) for k in range(rng.randint(1, 6))]
        for k in range(1, len(turns) + 1):
            if rng.random() < 0.6 or k == len(turns):
                rows += [(100 * i + k, *t) for t in turns[:k]]
    rows += [(7000 + i, 0, "user", "hi") for i in range(50)] + [(8000, 0, "user", "hi"), (8000, 0, "user", "hi")]
    rows += [(9000, 1, "a", "x"), (9000, 1, "b", "y"), (9001, 5, "a", "x"), (None, 0, "user", "alone"), (9002, None, "u", "v")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"pos": F.lit("x"), "a": F.lit(1), "last": F.lit(2)}).repartition(4)
    got = chat.render(df).collect()
    assert sorted(((r.conv_id, r.n_turns, r.copies) for r in got), key=repr) == plain(rows)
    assert all(r.rendered.count("<|end|>") == r.n_turns for r in got)
    assert chat.render(df.limit(0)).count() == 0


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 0, None, "a"), (2, 0, "a", None), (3, 0, "", "a"), (4, 0, "a<|end|>\n<|b|>", "c<|end|>")]
    got = {r.conv_id: r.rendered for r in chat.render(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {1, 2, 3, 4} and got[4].count("<|end|>") == 1 == got[4].count("|>\n") - 1 and got[1] == "<|unknown|>\na<|end|>\n"


@pytest.mark.parametrize("name, tables", [("op7_snapshots", ["conversations"]), ("op9_warc", ["pages"])])
def test_queries_equal_duckdb(spark, small, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(map(repr, (tuple(r) for r in result.fetchall())))
    df = QUERIES[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == want


PAGES = "page_id long, url string, html string"


def test_pages_come_back_from_their_archives(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ROLL_BYTES", 3000)
    pages = [(i, f"http://h{i % 5}.example.org/p{i % 11}?b=2&a=1", ["", None, "<p>same</p>", f"<p>{i}</p>" * (i % 40), "é" * 40_000][i % 5]) for i in range(120)]
    pages += [(None, None, "only null"), (500, "http://[broken", "x\r\n\r\ny\r\n"), (501, "http://a b\r\nEvil: 1", "z"), (502, "", None), (503, "u", "q"), (503, "u", "q")]
    df = spark.createDataFrame(pages, PAGES).withColumns({"digest": F.lit("x"), "kind": F.lit(1), "largest": F.lit(2), "size": F.lit(3)}).repartition(5)
    rows = warc.round_trip(df, root=str(tmp_path / "w")).orderBy("part", "place").collect()
    assert len({(r.part, r.place) for r in rows}) == len(rows) == len(pages)
    urls = {p: u for p, u, _ in pages}
    keys = [warc.url_key(urls[r.page_id]) for r in rows]
    assert keys == sorted(keys)
    got = sorted(repr(tuple(r)[:5]) for r in rows)
    top = {}
    for p, _, h in pages:
        top[h or ""] = max(top.get(h or "", -1), -1 if p is None else p)
    want = []
    for p, _, h in pages:
        data = (h or "").encode()
        other = top[h or ""] not in (p, -1)
        want.append(repr((p, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if other else "response", top[h or ""] if other else None)))
    assert got == sorted(want)
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 5 and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.0\r\n") for f in files)
    assert b"\r\nEvil: 1" not in b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_small_payloads_can_stay_responses(spark):
    rows = warc.round_trip(spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long one"), (4, "d", "long one")], PAGES), min_bytes=5).collect()
    assert {r.page_id: r.refers_to for r in rows} == {1: None, 2: None, 3: 4, 4: None}


@pytest.mark.parametrize("runs", [0, 1, 2, 5, 16])
def test_loser_tree_merges_as_sorting_does(runs):
    rng = random.Random(runs)
    parts = [sorted(rng.choices(range(50), k=rng.choice([0, 1, 30]))) for _ in range(runs)]
    assert list(warc.LoserTree([iter(p) for p in parts])) == sorted(x for p in parts for x in p)


def test_index_is_in_global_order(spark, tmp_path):
    pages = [(i, f"http://h{i % 3}.org/{'hot' if i % 3 else i}", f"p{i}") for i in range(400)]
    runs = warc.write_archives(warc.kinds(spark.createDataFrame(pages, PAGES).repartition(7)), f"file://{tmp_path}/w")
    runs.cache()
    rows = warc.merged_index(runs, range_rows=60).orderBy("part", "place").collect()
    keys = [(r.key, r.time, r.page_id) for r in rows]
    assert len(rows) == 400 and keys == sorted(keys) and len({r.part for r in rows}) > 3


def test_an_archive_cut_between_records_or_grown_is_an_error(spark, tmp_path):
    uri = f"file://{tmp_path}/w"
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", f"page {i} " * 50) for i in range(30)], PAGES).repartition(2)
    index = warc.settle(warc.merged_index(warc.settle(warc.write_archives(warc.kinds(pages), uri), "runs")), "index")
    assert warc.listed_records(index, uri).where("payload_bytes > 0").count() == 30
    last = max(index.collect(), key=lambda r: (r.archive, r.offset))
    with pytest.raises(Exception, match="a record is not in the index"):
        warc.listed_records(index.where((F.col("archive") != last.archive) | (F.col("offset") != last.offset)), uri).collect()
    path = last.archive if last.archive.startswith("/") else f"{tmp_path}/w/{last.archive.rsplit('/', 1)[-1]}"
    with open(path, "r+b") as file:
        file.truncate(last.offset)
    with pytest.raises(Exception, match="a record of the index is not in its archive"):
        warc.listed_records(index, uri).collect()


def test_url_keys():
    assert warc.url_key("http://www.Example.org:80/A?b=2&a=1&PHPSESSID=9") == "org,example)/a?a=1&b=2"
    assert warc.url_key(None) == ")/"


def test_broken_archives_are_errors():
    raw = warc.record("response", "1", "http://a/", "2024-01-01T00:00:00Z", b"hello", warc.digest(b"hello"), None)
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.members(BytesIO(gzip.compress(raw)[:-9])))
    with pytest.raises(ValueError, match="differs"):
        warc.parse(raw.replace(b"hello", b"jello"))
