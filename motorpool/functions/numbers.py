"""Lenient number reading and period literals as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal grammar. Spark's own cast also takes `1d` and `1f`, so only matching text is cast.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SHORT_WHOLE = "^[0-9]{1,9}$"
DECIMAL = r"^[+-]?\d+(\.\d+)?$"


def double_or_infinite(col: Column) -> Column:
    """Number in the text, else NULL; too large a number is infinite.

    Most cells are short whole numbers, and a plain cast reads those without the full grammar.
    """
    other = F.regexp_extract(col, NUMBER, 0).try_cast("double")
    return F.when(col.rlike(SHORT_WHOLE), col.cast("int").cast("double")).otherwise(other)


def is_finite(number: Column) -> Column:
    """False for infinity and for NULL."""
    return F.coalesce(F.abs(number) < F.lit(float("inf")), F.lit(False))


def lenient_double(col: Column) -> Column:
    value = double_or_infinite(col)
    return F.when(is_finite(value), value)


def truncated_int(col: Column) -> Column:
    """Whole number toward zero; outside the INT range the ANSI cast stops the job."""
    return lenient_double(col).cast("int")


def decimal_comma(col: Column) -> Column:
    """`3,5` -> 3.50 as DECIMAL(5,2); first value of a `;` list; anything else NULL."""
    first = F.trim(F.split_part(col, F.lit(";"), F.lit(1)))
    dotted = F.replace(first, F.lit(","), F.lit("."))
    return F.regexp_extract(dotted, DECIMAL, 0).try_cast("decimal(5,2)")


def is_period(col: Column) -> Column:
    """Text is YYYYMM with a month from 01 to 12, ignoring outer blanks."""
    return F.coalesce(F.trim(col).rlike("^[0-9]{4}(0[1-9]|1[0-2])$"), F.lit(False))


def check_period(text: str) -> int:
    """Job-parameter form of `is_period`."""
    if not re.fullmatch(r"[0-9]{4}(0[1-9]|1[0-2])", str(text).strip()):
        raise ValueError(f"period must be YYYYMM with month 01-12, got {text!r}")
    return int(text)
