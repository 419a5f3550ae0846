"""Parallel scan of delimited files whose quoted cells contain line breaks.

A split cannot know by itself whether its first line starts a record or goes on inside a quoted cell. So every line
first says what it does to the quote state: where it ends if it starts outside quotes, and where if it starts inside.
That is one of four functions on two states: it keeps the state, sets it to one of the two, or swaps it. Lines are
composed within their split, splits are composed within their file (a row a split), and each line then learns the
state it really starts in. Lines are sorted within their split once, for both states the split may start in.
A line that starts outside quotes starts a record; lines that don't are joined to it, even
across splits. Only records of several lines are shuffled for that.

Quotes count as CSV readers of the C family have it: a cell that starts with a quote is quoted up to the next quote
that is not doubled, what follows up to the separator is plain text, and quotes in other cells are letters.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from motorpool.session import settle

#: A quoted cell's body, and the closing quote with the plain text behind it.
BODY = r'(?:[^"]++|"")*+'


def _edge(separator: str) -> str:
    return re.escape(separator)


def _cells(edge: str) -> str:
    """Whole cells up to the last separator that ends one: quoted and closed, or without a quote in front."""
    return rf'(?:(?:"{BODY}"[^{edge}]*+|(?!")[^{edge}]*+){edge})*+'


def _leaves_open(text: Column, separator: str) -> Column:
    """True if `text`, starting outside quotes, ends inside a quoted cell."""
    return text.rlike(rf'(?s)^{_cells(_edge(separator))}"{BODY}\z')


def _stays_open(text: Column, separator: str) -> Column:
    """True if `text`, starting inside a quoted cell, ends inside one, that or a later one."""
    edge = _edge(separator)
    return text.rlike(rf'(?s)^{BODY}(?:\z|"[^{edge}]*+{_cells(edge)}"{BODY}\z)')


def _without_return(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r$", "")).otherwise(text)


def read_lines(spark: SparkSession, paths: Sequence[str], encoding: str, separator: str) -> DataFrame:
    """Lines with their place (_file, _name, _block, _row) and what they do to the quote state; stored once.

    Only the line feed ends a line here, so a carriage return inside a quoted cell survives; one in front of the
    line feed that ends a record is dropped later.
    """
    text = F.col("value")
    if encoding != "UTF-8":
        text = F.decode(F.col("value").cast("binary"), encoding)
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), text.alias("line"),
    )
    quote = F.col("line").contains('"')
    bare = _without_return(F.col("line"))
    return settle(
        lines.withColumns({
            "_closed_to": quote & _leaves_open(bare, separator), "_open_to": ~quote | _stays_open(bare, separator),
        }),
        "lines",
    )


def _composed(rows: DataFrame, window: WindowSpec, closed_to: str, open_to: str) -> DataFrame:
    """Add what the rows before each row do together: `_set`, the state they lead to wherever they start (NULL if
    that depends on it), and `_odd`, whether they swap on top of it; see `_state`."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    swap, constant = F.col(closed_to) & ~F.col(open_to), F.col(closed_to) == F.col(open_to)
    rows = rows.withColumn("_odd", F.coalesce(F.sum(swap.cast("int")).over(before), F.lit(0)) % 2 == 1)
    return rows.withColumn("_set", F.last(F.when(constant, F.col(closed_to) != F.col("_odd")), ignorenulls=True).over(before))


def _state(start: bool) -> Column:
    """The state a row starts in if its first row starts in `start`."""
    return F.coalesce("_set", F.lit(start)) != F.col("_odd")


def _stated(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines under both states their split may start in, and the splits with the state they do start in.

    One sort within each split, stored: for each state (0 outside quotes, 1 inside) what a line starts in and how many
    records the split has begun up to it. A split is named by its smallest row id, which spares the sort the file's
    path. Of splits there is a row each: `_start`, `_end`, `_base` (records that begin in front of it in the file) and
    `_whole` (a number of the file).
    """
    # a row a split: the planner broadcasts it if it is small
    parts = settle(lines.groupBy("_file", "_name", "_block").agg(F.min("_row").alias("_split")), "parts")
    own = lines.join(parts.drop("_name"), ["_file", "_block"]).select(
        "_split", "_row", "line", "_closed_to", "_open_to", F.col("line").rlike(r"[^\t\r ]").alias("_filled")
    )
    inside = Window.partitionBy("_split").orderBy("_row")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = _composed(own, inside, "_closed_to", "_open_to").withColumns({"_open0": _state(False), "_open1": _state(True)})
    # blank lines between records are none; inside a quoted cell they belong to it
    told = told.withColumns({f"_begun{s}": F.count_if(~F.col(f"_open{s}") & F.col("_filled")).over(upto) for s in (0, 1)})
    states = settle(told.drop("_odd", "_set"), "states")

    def after(s: int) -> Column:
        return F.max_by(F.when(F.col(f"_open{s}"), F.col("_open_to")).otherwise(F.col("_closed_to")), F.col("_row"))

    whole = states.groupBy("_split").agg(*[c for s in (0, 1) for c in (after(s).alias(f"_to{s}"), F.max(f"_begun{s}").alias(f"_all{s}"))])
    file = Window.partitionBy("_file")
    whole = _composed(whole.join(parts, "_split"), file.orderBy("_block"), "_to0", "_to1").withColumn("_start", _state(False))
    earlier = file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.when(F.col("_start"), F.col("_all1")).otherwise(F.col("_all0"))
    splits = whole.select(
        "_split", "_file", "_name", "_block", "_start", F.when(F.col("_start"), F.col("_to1")).otherwise(F.col("_to0")).alias("_end"),
        F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias("_base"), F.min("_split").over(file).alias("_whole"),
    )
    return states, settle(splits, "splits")


def _placed(states: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with `_open` (the state they start in) and `_record` (the record they belong to, in the file from 0)."""
    start = splits.select("_split", "_block", "_start", "_base", "_whole")
    under = {c: F.when(F.col("_start"), F.col(f"{c}1")).otherwise(F.col(f"{c}0")) for c in ("_open", "_begun")}
    return states.join(start, "_split").select(
        "_whole", "_block", "_row", "line", "_closed_to", "_filled", under["_open"].alias("_open"),
        (F.col("_base") + under["_begun"] - 1).alias("_record"),
    )


def _ends(splits: DataFrame) -> DataFrame:
    return splits.groupBy("_file").agg(F.max_by("_end", "_block").alias("_open"))


def with_state(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with `_open` (the state they start in), and (_file, _open) at the end of each file."""
    states, splits = _stated(lines)
    return _placed(states, splits), _ends(splits)


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(_file, _name, _block, _row, text): a row per record, `_row` its number within the file from 0."""
    alone = ~F.col("_open") & ~F.col("_closed_to")
    single = lines.where(alone & F.col("_filled")).select("_whole", "_block", F.col("_record").alias("_row"), F.col("line").alias("text"))
    joined = lines.where(~alone).groupBy("_whole", "_record").agg(
        F.min("_block").alias("_block"), F.sort_array(F.collect_list(F.struct("_block", "_row", "line"))).alias("lines")
    )
    several = joined.select("_whole", "_block", F.col("_record").alias("_row"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))
    found = single.union(several).join(splits.select("_whole", "_block", "_file", "_name"), ["_whole", "_block"])
    return found.select("_file", "_name", "_block", "_row", _without_return(F.col("text")).alias("text"))


def cells_of(text: Column, separator: str) -> Column:
    """The record's cells as an array, quotes taken off."""
    edge = _edge(separator)
    # a separator in front makes every cell start with one, so that no cell is empty to the pattern
    found = F.regexp_extract_all(F.concat(F.lit(separator), text), F.lit(rf'(?s){edge}("{BODY}"[^{edge}]*+|[^{edge}]*+)'), F.lit(1))

    def bare(cell: Column) -> Column:
        body = F.regexp_extract(cell, rf'(?s)^"({BODY})"', 1)
        tail = F.regexp_replace(cell, rf'(?s)^"{BODY}"', "")
        return F.when(cell.startswith('"'), F.concat(F.replace(body, F.lit('""'), F.lit('"')), tail)).otherwise(cell)

    plain = F.split(text, F.lit(edge), -1)
    return F.when(F.contains(text, F.lit('"')), F.transform(found, bare)).otherwise(plain)


def header_cells(text: str, separator: str) -> list[str]:
    return next(csv.reader([text.removeprefix("﻿")], delimiter=separator))


def scan_quoted(spark: SparkSession, paths: Sequence[str], encoding: str, separator: str) -> tuple[DataFrame, list[list[str]]]:
    """Records (_file, _name, _block, _row, cells; header lines left out) and the header of each file.

    A file that ends inside a quoted cell is an error.
    """
    states, splits = _stated(read_lines(spark, paths, encoding, separator))
    broken = [r._file for r in _ends(splits).where("_open").select("_file").collect()]
    if broken:
        raise ValueError(f"a quoted cell is not closed before the end of {', '.join(sorted(broken))}")
    records = settle(_records(_placed(states, splits), splits), "quoted")
    headers = [header_cells(r.text, separator) for r in records.where("_row = 0").select("text").collect()]
    return records.where("_row > 0").select("_file", "_name", "_block", "_row", cells_of(F.col("text"), separator).alias("cells")), headers
