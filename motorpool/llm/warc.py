"""WARC archives of pages, and a global capture index by external merging.

Tasks write gzip members, one record each, into archives in a shared folder, and keep an index run: the captures
they wrote, sorted by URL key and time. Runs are cut at common bounds, every range of keys goes to one task, and
that task merges its slices of all runs through a loser tree; ranges in order give the capture histories of all
URLs. Of equal payloads one record holds the payload, the others are revisits of it.

An archive is named anew by each attempt to write it; only what finished attempts report is read, so a lost
executor leaves at most an unused file.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import partitions, utf8
from motorpool.session import scratch_path, settle

#: Size at which an archive is closed and the next one begun.
ROLL_BYTES = 64 << 20
LEVEL = 1
READ_BYTES = 1 << 20
#: Captures of one range of the index.
RANGE_ROWS = 50_000
FIRST_CAPTURE = datetime.datetime(2024, 1, 1)
#: Fixed value of the WARC standard.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
SESSION = re.compile(r"(?i)(^|&)(jsessionid|phpsessid|sid|sessionid)=[^&]*")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query in lower case: `com,example)/a?b=1`."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return (url or "").strip().lower()
    query = "&".join(sorted(x for x in SESSION.sub("", parts.query).split("&") if x))
    labels = ",".join(reversed(host.split(".")))
    port = f":{port}" if port not in (None, 80, 443) else ""
    return f"{labels}{port}){parts.path or '/'}{'?' + query if query else ''}".lower()


def record(kind: str, page: str, url: str | None, time: str, payload: bytes, own: str, refers_to: str | None) -> bytes:
    """One WARC record, not compressed. A revisit holds the headers of its response only."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {time}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{own}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record; the block is checked against its digest."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = top.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if "sha1:" + digest(block) != fields["warc-block-digest"]:
        raise ValueError(f"block digest of {fields['warc-record-id']} differs")
    return fields, block


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member, reading a piece at a time."""
    begun = at = 0
    inner, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(READ_BYTES)):
        parts.append(inner.decompress(data))
        rest = inner.unused_data if inner.eof else b""
        at += len(data) - len(rest)
        data = rest
        if inner.eof:
            yield begun, at - begun, b"".join(parts)
            begun, inner, parts = at, zlib.decompressobj(31), []
    if begun != at:
        raise ValueError("archive ends inside a record")


def kinds(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and `refers_to`: the largest page_id of an equal payload where this is another one.

    Null html is an empty payload; null ids rank lowest. Payloads under `min_bytes` are always written out. Rows that
    repeat the largest id are all responses.
    """
    own = pages.select(F.col("page_id"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumns({"sha": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    first = own.where(F.col("size") >= min_bytes).groupBy("sha", "size").agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")
    )
    # most payloads occur once and need no partner
    shared = settle(first.where("n > 1").drop("n"), "shared")
    joined = own.join(shared, ["sha", "size"], "left")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("largest")).alias("refers_to"))


RUN = "run string, key string, time string, page_id string, url string, kind string, digest string, archive string, offset long, length long"


def write_archives(pages: DataFrame, root: str, captured: Column | None = None) -> DataFrame:
    """Write the rows of `kinds` below the folder `root`; returns the index runs, each sorted by key and time.

    `captured` is the capture time; left out, it is page_id seconds after FIRST_CAPTURE, so that runs repeat.
    """
    shift = F.coalesce(F.col("page_id").cast("long"), F.lit(0))
    time = F.timestamp_seconds(F.unix_timestamp(F.lit(str(FIRST_CAPTURE))) + shift) if captured is None else captured
    own = pages.select(
        F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time")
    )
    names = [x.split()[0] for x in RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        me, rows, out, at, path = uuid.uuid4().hex, [], None, 0, ""
        for batch in batches:
            page, url, html, refers, times = (utf8(c) if i == 2 else c.to_pylist() for i, c in enumerate(batch.columns))
            for p, u, payload, r, t in zip(page, url, html, refers, times):
                if out is None or at > ROLL_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(base, recursive=True)
                    path, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                kind, own_digest = "response" if r is None else "revisit", digest(payload)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = packer.compress(record(kind, p or "none", u, t, payload, own_digest, r)) + packer.flush()
                out.write(raw)
                rows.append((me, url_key(u), t, p, u, kind, own_digest, path, at, len(raw)))
                at += len(raw)
        if out is not None:
            out.close()
        rows.sort(key=lambda x: (x[1], x[2], x[3] or ""))
        for s in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[s : s + 10_000]), [pa.string()] * 8 + [pa.int64()] * 2)], names=names)

    return own.mapInArrow(run, RUN)


class LoserTree:
    """Merges sorted iterators: inner nodes hold the losers of their match, so each step plays one path to the top."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.size = len(runs)
        self.losers = [-1] * max(1, self.size)
        self.winner = -1
        for i in range(self.size):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, i: int) -> None:
        node = (i + self.size) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = i
                return
            if self._before(self.losers[node], i):
                i, self.losers[node] = self.losers[node], i
            node //= 2
        self.winner = i

    def __iter__(self) -> Iterator:
        while self.size and self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            node = (i + self.size) // 2
            while node:
                if self._before(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs in one order: `part` and, within it, `place` ascend by key, time and page id.

    Bounds come from Spark's range partitioner and hold key, time and id, so the captures of one URL may spread over
    many ranges. A run's slices arrive as they were cut; the tree puts them together.
    """
    names = [c for c in runs.columns if c != "run"]
    where = [names.index(c) for c in ("key", "time", "page_id")]
    n = max(1, -(-runs.count() // range_rows))
    dealt = runs.repartitionByRange(n, "key", "time", F.coalesce("page_id", F.lit(""))).sortWithinPartitions("run") if n > 1 else runs.coalesce(1)
    schema = "part int, place long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema if f.name != "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        slices: dict[str, list] = {}
        for batch in batches:
            runs_, *rest = (c.to_pylist() for c in batch.columns)
            for r, row in zip(runs_, zip(*rest)):
                slices.setdefault(r, []).append((tuple(row[i] or "" for i in where), row))
        for s in slices.values():
            # fetched blocks of one run may come in any order; joining sorted pieces is what this sort does
            s.sort(key=lambda x: x[0])
        place, out = 0, []
        for _, row in LoserTree([iter(s) for _, s in sorted(slices.items())]):
            out.append((part, place, *row))
            place += 1
            if len(out) == 10_000:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), *(pa.int64() if c in ("offset", "length") else pa.string() for c in names)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=["part", "place", *names])

    return dealt.select("run", *names).mapInArrow(run, schema)


def read_archives(archives: DataFrame, root: str) -> DataFrame:
    """One row per record of the files named in `archives.archive`: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and the record's place. A revisit's size and digest are those of the full payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(path, compression=None) as stream:
                    for offset, length, raw in members(stream):
                        fields, block = parse(raw)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        told = fields["warc-payload-digest"].removeprefix("sha1:")
                        size = int(re.search(rb"(?i)content-length: (\d+)", head)[1])
                        kind = fields["warc-type"]
                        if kind == "response" and (digest(payload), len(payload)) != (told, size):
                            raise ValueError(f"payload of {fields['warc-record-id']} differs")
                        page, refers = (fields.get(f, "<urn:page:none>")[10:-1] for f in ("warc-record-id", "warc-refers-to"))
                        rows.append((page, size, told, kind, refers if kind == "revisit" else None, path, offset, length))
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"]
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                for s in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[s : s + 10_000]), types)], names=names)

    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, archive string, offset long, length long"
    own = archives.select("archive").distinct()
    return own.repartition(partitions(archives.sparkSession)).mapInArrow(run, schema)


def listed_records(index: DataFrame, uri: str) -> DataFrame:
    """The records of the archives with their `part` and `place` in the merged `index`, matched by archive and offset.

    A record that the index doesn't list is an error, and so is an entry whose record is gone, as in a cut archive.
    """
    at = ["archive", "offset", "length"]
    back = read_archives(index, uri).withColumn("_read", F.lit(True))
    joined = back.join(index.select(*at, "part", "place", F.lit(True).alias("_listed")), at, "full_outer")
    unlisted, gone = (F.raise_error(F.lit(x)).cast("long") for x in ("a record is not in the index", "a record of the index is not in its archive"))
    size = F.when(F.col("_listed").isNull(), unlisted).when(F.col("_read").isNull(), gone).otherwise(F.col("payload_bytes"))
    return joined.withColumn("payload_bytes", size).drop("_read", "_listed")


def round_trip(pages: DataFrame, min_bytes: int = 0, root: str | None = None) -> DataFrame:
    """Archive `pages`, merge the index, read the archives back and place their records by it.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to for every page, and its `part` and `place`
    in the global order of capture histories (URL key, time, page id). Columns beyond page_id, url and html are
    ignored; an empty table gives an empty one. Record and index entry without the other are an error.
    """
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    uri = root if "://" in root else f"file://{root.removeprefix('file:')}"
    kind = pages.schema["page_id"].dataType
    runs = settle(write_archives(kinds(pages, min_bytes), uri), "runs")
    records = listed_records(settle(merged_index(runs), "index"), uri)
    number = lambda c: F.when(F.col(c) != "none", F.col(c)).cast(kind).alias(c)
    return records.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"), "part", "place")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
