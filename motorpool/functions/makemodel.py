"""Make/model text split as column expressions.

`I/` in front marks an imported vehicle, the first `/` ends the brand segment, and for imported texts
(also those whose segment is `IMP`) the brand is the longest dictionary entry the rest starts with.

The functions that need the text without `I/` take it as `body`, so that a plan can compute it once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorpool.functions.text import strip_start

IMPORT_SEGMENT = "IMP"
TO_END = 2147483647


def slash_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit("")))


def import_prefixed(text: Column) -> Column:
    return F.coalesce(text.startswith("I/"), F.lit(False))


def drop_import_prefix(text: Column) -> Column:
    return F.when(import_prefixed(text), F.substring(text, 3, TO_END)).otherwise(text)


def first_segment(text: Column, body: Column) -> Column:
    """Part of `body` before its first slash; NULL where the whole text has no slash."""
    return F.when(F.contains(text, F.lit("/")), F.substring_index(body, "/", 1))


def after_segment(body: Column) -> Column:
    """Text after a non-empty first segment and its slash, else the whole body."""
    slash = F.instr(body, "/")
    return F.when(slash > 1, F.substring(body, slash + 1, F.lit(TO_END))).otherwise(body)


def is_imported(text: Column, segment: Column) -> Column:
    return import_prefixed(text) | F.coalesce(segment == IMPORT_SEGMENT, F.lit(False))


def prefix_pattern(brands: Sequence[str]) -> str:
    """Alternation tried longest first, so the longest entry that fits wins."""
    ordered = sorted(set(brands), key=lambda b: (-len(b), b))
    return "^(?:" + "|".join(re.escape(b) for b in ordered) + ")"


def dictionary_prefix(text: Column, brands: Sequence[str]) -> Column:
    """Longest dictionary entry the text starts with; empty if there is none."""
    return F.regexp_extract(text, prefix_pattern(brands), 0)


def drop_prefix(text: Column, prefix: Column) -> Column:
    """Text without the prefix and the blanks after it; unchanged for an empty or NULL prefix."""
    tail = strip_start(F.substring(text, F.length(prefix) + 1, F.lit(TO_END)))
    return F.when(prefix != "", tail).otherwise(text)


def is_handmade(brand: Column) -> Column:
    return F.coalesce(brand.startswith("A."), F.lit(False))
