"""Period folders of delimited text files."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import NA_TOKENS
from motorpool.functions.text import clean_cell, column_slug
from motorpool.operators.keys import PLACE, number_records
from motorpool.schemas import INPUT_COLUMNS
from motorpool.sources import files
from motorpool.sources.quoted import scan_quoted

SEPARATOR = ";"
OVERFLOW = "_overflow"
HEADERS_AT_ONCE = 8

# Headers an input file must have.
REQUIRED_HEADERS = ("UF", "Marca Modelo", "Ano Fabricação Veículo CRV", "Qtd. Veículos")


def list_periods(spark: SparkSession, base: str) -> list[int]:
    """Sub-folders named by six digits, sorted; the month is not checked here."""
    names = [f.name for f in files.listing(spark, base) if f.is_dir]
    return sorted(int(n) for n in names if re.fullmatch(r"[0-9]{6}", n))


def resolve_period(spark: SparkSession, base: str, period: int | None = None) -> tuple[int, str]:
    """The asked-for period or the latest one, and its folder."""
    if not files.exists(spark, base):
        raise ValueError(f"input folder does not exist: {base}")
    if period is None:
        periods = list_periods(spark, base)
        if not periods:
            raise ValueError(f"no YYYYMM folder in {base}")
        period = periods[-1]
    folder = f"{base.rstrip('/')}/{period}"
    if not files.is_dir(spark, folder):
        raise ValueError(f"no folder for period {period}: {folder}")
    return period, folder


def list_inputs(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Matching files of a folder, sorted by path; empty if the folder is missing."""
    if not files.exists(spark, folder):
        return []
    found = [f.path for f in files.listing(spark, folder) if not f.is_dir and fnmatch.fnmatchcase(f.name, pattern)]
    return sorted(found)


@dataclass(frozen=True)
class Reading:
    """How a file is to be read. Files with line breaks inside quotes take a scan of their own, `quoted`."""

    encoding: str = "UTF-8"
    multi_line: bool = False


def _bare(path: str) -> str:
    """Path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def _opens_quote(text: Column, separator: str) -> Column:
    """True if a quote at the start of a cell is not closed within `text`; quotes inside cells don't count."""
    edge = rf"[{re.escape(separator)}\r\n]"
    body = r'(?:[^"]++|"")*+"'
    # whole cells, quoted ones closed right in front of their edge; then one that opens and is not
    whole = rf'(?:(?:"{body}|(?!")[^{edge[1:]}*+){edge})*+'
    return text.rlike(rf'(?s)^{whole}"(?!{body}(?:{edge}|$))')


def inspect(spark: SparkSession, paths: Sequence[str], separator: str = SEPARATOR) -> dict[Reading, list[str]]:
    """Files by the way they must be read, from one parallel pass over their lines.

    A file with a line that is not UTF-8 is Latin-1; in a line that opens a quote at the start of a cell and does
    not close it, the cell goes on in the next line.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        (~F.is_valid_utf8("value")).alias("broken"),
        # most lines hold no quote and need no pattern
        (F.contains("value", F.lit('"')) & _opens_quote(F.col("value"), separator)).alias("open"),
    )
    marks = lines.where("broken OR open").groupBy("file").agg(F.bool_or("broken"), F.bool_or("open")).collect()
    found = {unquote(_bare(m[0])): Reading("ISO-8859-1" if m[1] else "UTF-8", m[2]) for m in marks}
    groups: dict[Reading, list[str]] = {}
    for path in paths:
        groups.setdefault(found.get(_bare(path), Reading()), []).append(path)
    return groups


def _options(reading: Reading, separator: str) -> dict[str, str]:
    return {
        "sep": separator, "header": "true", "encoding": reading.encoding, "quote": '"', "escape": '"',
    }


def _headers(spark: SparkSession, groups: dict[Reading, list[str]], separator: str) -> set[tuple[str, ...]]:
    """The headers of the files, as the reader names them: a small job a file, several at a time."""

    def header(how: Reading, path: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**_options(how, separator)).csv(path).columns)

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return set(pool.map(lambda one: header(*one), [(how, p) for how, ps in groups.items() for p in ps]))


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    separator: str = SEPARATOR,
    reading: Reading | None = None,
    suffixes: Sequence[str] = (".csv",),
) -> list[DataFrame]:
    """Scans of all cells as text under the files' own headers, one for each way of reading.

    Files of one call share a header line. Missing-value tokens are left to `missing_to_null`.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no input files")
    for path in paths:
        if not files.exists(spark, path):
            raise FileNotFoundError(path)
        if not path.lower().endswith(tuple(suffixes)):
            raise ValueError(f"expected {' or '.join(suffixes)}, got {path}")
    groups = {reading: paths} if reading else inspect(spark, paths, separator)
    plain = {how: ps for how, ps in groups.items() if not how.multi_line}
    headers = _headers(spark, plain, separator)
    quoted = {how: scan_quoted(spark, ps, how.encoding, separator) for how, ps in groups.items() if how.multi_line}
    headers |= {_safe(header) for _, found in quoted.values() for header in found}
    if len(headers) != 1:
        raise ValueError(f"files have different headers: {sorted(headers)}")
    names = list(headers.pop())
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, OVERFLOW])
    return [
        spark.read.options(**_options(how, separator), enforceSchema="true").schema(schema).csv(ps) for how, ps in plain.items()
    ] + [_placed(records, names) for records, _ in quoted.values()]


def _safe(header: Sequence[str]) -> tuple[str, ...]:
    """Header cells as column names: empty ones and repeated ones are told apart by their place."""
    low = [h.lower() for h in header]
    return tuple(f"_c{i}" if not h else f"{h}{i}" if low.count(h.lower()) > 1 else h for i, h in enumerate(header))


def _placed(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cells of records under their names; empty cells are NULL, as the plain scan has them."""
    cells = [F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    over = F.when(F.size("cells") > len(names), F.get("cells", F.lit(len(names)))).alias(OVERFLOW)
    return records.select(*cells, over, *PLACE)


def missing_to_null(cell: str):
    """The cell unless it is a missing-value token as written, blanks included."""
    return F.when(~F.col(f"`{cell}`").isin(*NA_TOKENS), F.col(f"`{cell}`"))


def validate_headers(columns: Sequence[str], required: Sequence[str] = REQUIRED_HEADERS) -> None:
    """Required headers under strip and lower case; accents count."""
    found = {c.strip().lower() for c in columns}
    missing = [r for r in required if r.strip().lower() not in found]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; found: {', '.join(columns)}")


def _plain_scan(scan: DataFrame) -> tuple[DataFrame, list[str]]:
    """Cells under slug names, NULL for missing; over-full records stop the job."""
    place = [c for c in PLACE if c in scan.columns]
    names = [c for c in scan.columns if c not in (OVERFLOW, *place)]
    slugs = [column_slug(c, i) for i, c in enumerate(names)]
    if len(set(slugs)) != len(slugs):
        raise ValueError(f"headers fall together: {names}")
    message = F.raise_error(F.lit("record has more fields than the header"))
    guard = F.when(F.col(OVERFLOW).isNotNull(), message.cast("string"))
    cells = [F.coalesce(guard, missing_to_null(c)).alias(s) for c, s in zip(names, slugs)]
    return scan.select(*cells, *place), slugs


def read_records(scans: Sequence[DataFrame]) -> tuple[DataFrame, int]:
    """Clean cells with file-order numbers (slug columns, source_file, file_row, record), and a count."""
    plain = [_plain_scan(scan) for scan in scans]
    numbered, total = number_records(*[rows for rows, _ in plain])
    return numbered.withColumns({c: clean_cell(F.col(c)) for c in plain[0][1]}), total


def load_period(
    spark: SparkSession,
    folder: str,
    *,
    multi_file: bool = False,
    separator: str = SEPARATOR,
    reading: Reading | None = None,
) -> tuple[DataFrame, int]:
    """The period's input columns, source_file, csv_row (header is row 1), record number; their count.

    Several files are only read together when `multi_file` says so.
    """
    paths = list_inputs(spark, folder)
    if not paths:
        raise ValueError(f"no .csv file in {folder}")
    if len(paths) > 1 and not multi_file:
        raise ValueError(f"{len(paths)} files in {folder}; pass multi_file=True to load them together")
    scans = read_delimited(spark, paths, separator, reading)
    validate_headers([c for c in scans[0].columns if c not in (OVERFLOW, *PLACE)])
    records, total = read_records(scans)
    if total == 0:
        raise ValueError(f"no records in {folder}")
    extra = set(records.columns) - {*INPUT_COLUMNS, "source_file", "file_row", "record"}
    if extra:
        raise ValueError(f"columns without a place in the raw layer: {sorted(extra)}")
    row = (F.col("file_row") + 2).alias("csv_row")
    return records.select(*INPUT_COLUMNS, "source_file", row, "record"), total


def write_delimited(rows: DataFrame, path: str, separator: str = SEPARATOR) -> None:
    rows.write.option("sep", separator).option("header", True).option("escape", '"').csv(path)
