"""Files with line breaks in quoted cells: the parallel scan against a sequential reader."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from motorpool.sources import delimited, quoted

HEADER = "UF;Marca Modelo;Ano Fabricação Veículo CRV;Qtd. Veículos\n"


@pytest.fixture()
def tiny_splits(spark):
    """Splits of a few hundred bytes, so that most records and many cells cross a border."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def expected(path, encoding="utf-8"):
    return pd.read_csv(path, sep=";", dtype=str, keep_default_na=False, encoding=encoding).values.tolist()


def scanned(spark, paths):
    rows, _ = quoted.scan_quoted(spark, paths, "UTF-8", ";")
    out = {}
    for r in rows.orderBy("_file", "_row").collect():
        out.setdefault(r._file.rsplit("/", 1)[-1], []).append(r.cells)
    return out


def written(draw):
    """A cell as a file may hold it, in quotes or bare."""
    kind = draw.random()
    text = "".join(draw.choice("ab \n;\"") for _ in range(draw.randrange(40 if kind < 0.1 else 8)))
    if kind < 0.6:
        return '"' + text.replace('"', '""') + '"' + ("tail\"x" if kind < 0.05 else "")
    return "x" + text.replace("\n", "").replace(";", "")


def test_random_files_equal_a_sequential_reader(spark, tmp_path, tiny_splits):
    draw = random.Random(11)
    for name in ("a.csv", "b.csv", "c.csv"):
        lines = ["c1;c2;c3"]
        for _ in range(700):
            if draw.random() < 0.03:
                lines.append(draw.choice(["", "  ", "\t"]))
            lines.append(";".join(written(draw) for _ in range(3)))
        (tmp_path / name).write_text("\n".join(lines) + "\n" * draw.randrange(3), newline="")
    got = scanned(spark, [f"{tmp_path}/{n}" for n in ("a.csv", "b.csv", "c.csv")])
    for name, rows in got.items():
        assert rows == expected(tmp_path / name), name
    assert len(got) == 3


def test_a_cell_across_many_splits_and_carriage_returns(spark, tmp_path, tiny_splits):
    long = "\n".join(f'line {i}; with ""quotes""' for i in range(300))
    body = f'c1;c2\r\nA;"{long}"\r\n"x\r\ny";2\r\n"";"""q"""\r\nlast;"no\nend"'
    (tmp_path / "a.csv").write_text(body, newline="")
    assert scanned(spark, [f"{tmp_path}/a.csv"])["a.csv"] == expected(tmp_path / "a.csv")


def test_header_with_a_line_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"c\n1";c2;;c2\n1;"a\nb";3;4\n')
    scan = delimited.read_delimited(spark, [f"{tmp_path}/a.csv"])[0]
    assert [c for c in scan.columns if not c.startswith("_f")][:4] == ["c\n1", "c21", "_c2", "c23"]
    assert scan.first()[:4] == ("1", "a\nb", "3", "4")


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_loaded_rows_keep_file_and_row_numbers(spark, tmp_path, tiny_splits, encoding):
    def body(tag, n):
        return HEADER + "".join(f'{tag}{i};"MÃO/{i}\nK;{i}";20{i % 10}0;"{i}"\n' for i in range(n))

    (tmp_path / "a.csv").write_bytes(body("A", 150).encode(encoding))
    (tmp_path / "b.csv").write_bytes((HEADER + "SP;FORD/KA;2010;5\nRJ;FORD/KA;2011;6\n").encode(encoding))
    (tmp_path / "c.csv").write_bytes(body("C", 90).encode(encoding))
    rows, total = delimited.load_period(spark, str(tmp_path), multi_file=True)
    got = [(r.source_file, r.csv_row, r.record, r.uf, r.marca_modelo) for r in rows.orderBy("record").collect()]
    want = []
    for name in ("a.csv", "b.csv", "c.csv"):
        for i, (uf, text, *_) in enumerate(expected(tmp_path / name, encoding)):
            want.append((name, i + 2, len(want), uf, text))
    assert got == want and total == len(want)


def test_scan_stays_parallel(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text(HEADER + "".join(f'SP;"A/\n{i}";2010;1\n' for i in range(500)))
    lines = quoted.read_lines(spark, [f"{tmp_path}/a.csv"], "UTF-8", ";")
    assert lines.select("_block").distinct().count() > 20
    scan = delimited.read_delimited(spark, [f"{tmp_path}/a.csv"])[0]
    plan = scan._jdf.queryExecution().toString().lower()
    assert "wholetext" not in plan and "multiline" not in plan


def test_too_many_cells_stop_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + 'SP;"A/\nB";1;2;3\n')
    with pytest.raises(Exception, match="more fields than the header"):
        delimited.load_period(spark, str(tmp_path))[0].collect()


def test_only_records_of_several_lines_are_grouped(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n1;"x\ny"\n2;z\n3;"q"\n')
    lines, ends = quoted.with_state(quoted.read_lines(spark, [f"{tmp_path}/a.csv"], "UTF-8", ";"))
    assert [r._open for r in lines.orderBy("_row").collect()] == [False, False, True, False, False]
    assert [r._open for r in ends.collect()] == [False]
    assert lines.where(~F.col("_open") & ~F.col("_closed_to")).count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_sorted_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('a;b\n1;"x\ny"\n2;z\n3;"q"\n')
    plans, settle = {}, quoted.settle
    monkeypatch.setattr(quoted, "settle", lambda df, label: plans.setdefault(label, _plan(df)) and settle(df, label))
    rows, _ = quoted.scan_quoted(spark, [f"{tmp_path}/a.csv"], "UTF-8", ";")
    assert [r.cells for r in rows.orderBy("_row").collect()] == [["1", "x\ny"], ["2", "z"], ["3", "q"]]
    assert "Window" in plans["states"] and "Window" not in plans["quoted"] and "Window" not in plans["lines"]


def test_each_line_meets_one_pattern_for_each_state(spark):
    """No text is rewritten to learn its quote state, and none without a quote meets a pattern for it."""
    line = F.col("line")
    for told in (quoted._leaves_open(line, ";"), quoted._stays_open(line, ";"), delimited._opens_quote(line, ";")):
        plan = _plan(spark.createDataFrame([('a;"b',)], "line string").select(told.alias("told")))
        assert "regexp_replace" not in plan and plan.count("RLIKE") == 1
