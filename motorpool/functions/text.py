"""Text clean-up as column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's plain trim() only removes U+0020.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def _letter_table() -> tuple[str, str]:
    """Accented upper-case letters that decompose to A-Z plus marks, and those base letters."""
    accented, plain = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and "A" <= base[0] <= "Z":
            accented.append(chr(code))
            plain.append(base[0])
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _letter_table()


def strip_edges(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def strip_start(col: Column) -> Column:
    return F.ltrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    """Keep the text as it is, but turn a whitespace-only one into NULL."""
    return F.when(strip_edges(col) != "", col)


def clean_cell(col: Column) -> Column:
    """Stripped text; blank becomes NULL."""
    return F.nullif(strip_edges(col), F.lit(""))


def normalize_text(col: Column, drop_punctuation: bool = True) -> Column:
    """Upper case, no accents, single inner spaces, stripped; `.`, `,` and `;` count as spaces."""
    plain = F.translate(F.upper(col), ACCENTED, PLAIN)
    plain = F.regexp_replace(plain, r"\p{Mn}+", "")
    separators = r"[\s\x1c-\x1f\x85\p{Z}" + (".,;" if drop_punctuation else "") + "]+"
    return F.btrim(F.regexp_replace(plain, separators, " "))


def column_slug(name: str, position: int) -> str:
    """Snake-case ASCII column name for a file header; works on names only, never on data."""
    words = re.split(r"[\s_-]+", unicodedata.normalize("NFD", name.lower()))
    kept = [w for w in (re.sub(r"[^a-z0-9]", "", word) for word in words) if w]
    return "_".join(kept) or f"coluna_{position}"
