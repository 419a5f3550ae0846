"""Interaction audit of five document filters: what each removes in every order of application.

Four filters look at one text only. The fifth fails a text that a smaller doc_id has too. For it, a counting Bloom
filter goes first: every text sets CELLS cells of one 64-cell word, chosen by hashes; task-wise counts are added up,
and only cells with a count of two or more are kept. A text with a cell of count one stands nowhere else. The others,
real repeats and a few false ones, are grouped by their full texts, and the group's smallest doc_id is exact.

A document then is a mask of five bits. Masks are counted by part, and every figure of every order is a difference of
two sums over masks, so orders are expanded from 32 counts a part and never from documents.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import utf8
from motorpool.session import settle, settle_counted

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
#: Cells that a text sets, all in one word of 64; words are sized for this many cells a text.
CELLS = 3
CELLS_PER_TEXT = 16
#: Words of the bitmap that marks texts to be grouped: 2^18 times 64 bits.
MARK_WORDS = 1 << 18
#: Bytes of one text whose words are split at a time.
PIECE_BYTES = 1 << 20
MIN_WORDS = 50

UPPER = bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))
SPECIAL = b"#$%&*|"
SPACE = b" \t\n\r\x0b\x0c"


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words; a long text is split piece by piece, each ending at white space."""
    if len(text) <= PIECE_BYTES:
        words = text.split()
        return len(words), len(set(words))
    total, seen, rest = 0, set(), b""
    for at in range(0, len(text), PIECE_BYTES):
        piece = text[at : at + PIECE_BYTES]
        # the last word may go on in the next piece
        words = (rest + piece).split()
        rest = b""
        if words and piece[-1] not in SPACE:
            rest = words.pop()
        total += len(words)
        seen.update(words)
    if rest:
        total += 1
        seen.add(rest)
    return total, len(seen)


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words, distinct = word_counts(text)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, CONTINUED))
    return (
        (words < MIN_WORDS)
        | (100 * distinct < 65 * words) << 1
        | (100 * upper > 5 * points) << 2
        | (len(text.translate(None, SPECIAL)) < len(text)) << 3
    )


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _hashes(body: Column) -> list[Column]:
    return [F.xxhash64(body).alias("h"), F.xxhash64(F.lit("check"), body).alias("g")]


def flags(docs: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, part, h, g, mask) of every document; a null text is an empty one, a null part the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.num_columns - 1))
            mask = np.fromiter(map(text_mask, texts), np.int32, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(mask)], names=["doc_id", "part", "h", "g", "mask"])

    body = _body(text)
    own = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), *_hashes(body), body.alias("body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, part string, h long, g long, mask int")


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), "h"), F.lit(words)).alias("word")


def _cells() -> list[Column]:
    """Cells of the text's word, from six bits of its hash each; two of them may be one."""
    return [F.shiftrightunsigned("g", 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(CELLS)]


def sketch(flagged: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(word, twice): in each word the cells that two or more texts set; and the number of words.

    The counts of the counting Bloom filter are kept sparse, as they are added up within tasks and then between
    them. The rows grow with the texts that repeat. Only hashes are joined to them, never texts.
    """
    words = max(1, -(-n * CELLS_PER_TEXT // 64))
    each = flagged.select(_word(words), F.explode(F.array_distinct(F.array(*_cells()))).alias("cell"))
    counted = each.groupBy("word", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cell)")).alias("twice")), words


def possible_repeats(rows: DataFrame, twice: DataFrame, words: int) -> DataFrame:
    """The rows (with h, g) whose cells all have a count of two or more; every repeated text is among them."""
    met = rows.withColumn("word", _word(words)).join(twice, "word")
    held = F.lit(True)
    for cell in _cells():
        held = held & (F.expr("twice").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), cell)) != 0)
    return met.where(held).drop("word", "twice")


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("g").bitwiseAND(F.lit(63)).cast("int"))


def marked_rows(rows: DataFrame, maybe: DataFrame) -> DataFrame:
    """The rows (with h, g) whose bit is set in a bitmap of the texts of `maybe`.

    The bitmap has MARK_WORDS words of 64 bits at most, so it can be broadcast whatever the data, and texts without
    a mark stay where they are. The more texts repeat, the more others share a bit with one and are grouped for
    nothing; results don't depend on it.
    """
    slot = F.pmod("h", F.lit(MARK_WORDS)).alias("slot")
    bitmap = maybe.select(slot, _bit().alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    met = rows.withColumn("slot", slot).join(F.broadcast(bitmap), "slot")
    return met.where(F.col("bits").bitwiseAND(_bit()) != 0).drop("slot", "bits")


def repeated(docs: DataFrame, flagged: DataFrame, n: int, text: str = "text") -> DataFrame:
    """The rows of `flagged` whose text a smaller doc_id has too.

    Rows of one doc_id and one text don't fail each other, and null ids neither fail nor fail others. Texts are
    compared whole; their hashes only bring the smallest id back to the row that has both this id and this text.
    """
    twice, words = sketch(flagged, n)
    maybe = settle(possible_repeats(flagged, settle(twice, "sketch"), words), "maybe")
    body = _body(text)
    again = marked_rows(docs.select("doc_id", body.alias("body"), *_hashes(body)), maybe)
    # copies meet within their task first, so a text that very many rows share is sent once a task
    first = again.groupBy("body").agg(F.min("doc_id").alias("doc_id"), F.min("h").alias("h"), F.min("g").alias("g"))
    first = settle(first.where("doc_id IS NOT NULL").select("doc_id", "h", "g"), "firsts")
    return maybe.where("doc_id IS NOT NULL").join(first, ["doc_id", "h", "g"], "left_anti")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` with good and toxic (0 or 1). A document labelled twice has a label if one of its rows says so."""
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    return rows.join(told, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): one row per part and combination of failed filters; n may be 0.

    All rows are counted without the last filter. Those that fail it are then taken from the count of their mask
    and added to that of the mask with its bit, so only possible repeats meet the table of first ids.
    """
    flagged, n = settle_counted(flags(docs, part, text), "flags")
    known = with_labels(flagged.select("doc_id", "part", "mask"), labels).withColumn("n", F.lit(1))
    fails = with_labels(repeated(docs, flagged, n, text).select("doc_id", "part", "mask"), labels)
    sign = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.lit(-1).alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(DUPLICATE)).alias("mask"), F.lit(1).alias("n")),
    ))
    moved = fails.select("part", "good", "toxic", sign.alias("x")).select("part", "x.mask", "x.n", (F.col("good") * F.col("x.n")).alias("good"), (F.col("toxic") * F.col("x.n")).alias("toxic"))
    columns = ["part", "mask", "n", "good", "toxic"]
    sums = [F.sum(c).cast("long").alias(c) for c in columns[2:]]
    return known.select(*columns).union(moved.select(*columns)).groupBy("part", "mask").agg(*sums)


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of all filters and step; `counts` from `mask_counts`. No counts, no rows.

    `kept`, `removed` and the losses of a step are differences of `left[S]`, the sum over masks that share no bit
    with the filters S applied so far, so a part needs 32 sums of each kind, whatever the number of orders.
    """
    k = len(FILTERS)
    subsets = range(2**k)
    kinds = ("n", "good", "toxic")
    left = counts.groupBy("part").agg(
        *[F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) == 0, F.col(c))), F.lit(0)) for s in subsets]).alias(c) for c in kinds],
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == 1 << i, F.col("n"))), F.lit(0)) for i in range(k)]).alias("alone"),
    )
    rows = []
    for order in itertools.permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            name = "".join(FILTERS[j] for j in order)
            rows.append({"filter_order": name, "step": step, "own": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    orders = F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,own:int,before:int,after:int>>")

    def at(name: str, index: str | Column) -> Column:
        return F.get(name, F.col(index) if isinstance(index, str) else index)

    def lost(name: str) -> Column:
        return at(name, "before") - at(name, "after")

    bit = F.call_function("shiftleft", F.lit(1), F.col("own"))
    fails = F.get("n", F.lit(0)) - at("n", bit)
    # over all orders, a filter meets each set S of others before it |S|! (k - 1 - |S|)! times
    shares = []
    for i in range(k):
        others = [s for s in subsets if not s >> i & 1]
        terms = [
            (F.get("n", F.lit(s)) - F.get("n", F.lit(s | 1 << i))) * math.factorial(s.bit_count()) * math.factorial(k - 1 - s.bit_count())
            for s in others
        ]
        shares.append(sum(terms[1:], terms[0]))
    parts = left.withColumn("shares", F.array(*shares))
    return parts.select("*", F.inline(orders)).select(
        "part", "filter_order", "step", at("n", "after").alias("kept"), lost("n").alias("removed"),
        (fails - lost("n")).alias("redundant"), at("alone", "own").alias("unique_fails"), lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"), at("shares", "own").alias("shapley"),
    )


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
x AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
              100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
              coalesce(x.doc_id > first_id, false)] AS fail
      FROM x LEFT JOIN l ON x.doc_id = l.doc_id),
o AS (SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e
      FROM range(1, 6) a(i), range(1, 6) b(i), range(1, 6) c(i), range(1, 6) d(i), range(1, 6) e(i)
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT [a, b, c, d, e] AS seq, n.step AS step FROM o, range(1, 6) n(step)),
g AS (SELECT part, fail, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
r AS (SELECT part, seq, step, seq[step] AS own,
             sum(CASE WHEN len(list_filter(seq[:step], lambda i: fail[i])) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fail[seq[step]] AND len(list_filter(seq[:step - 1], lambda i: fail[i])) = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fail[seq[step]] AND len(list_filter(seq[:step - 1], lambda i: fail[i])) > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fail[seq[step]] AND len(list_filter(fail, lambda v: v)) = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fail[seq[step]] AND len(list_filter(seq[:step - 1], lambda i: fail[i])) = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fail[seq[step]] AND len(list_filter(seq[:step - 1], lambda i: fail[i])) = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM g, s GROUP BY part, seq, step)
SELECT part, array_to_string(list_transform(seq, lambda i: substr('ABCDE', CAST(i AS INT), 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
