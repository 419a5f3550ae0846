"""Delimited period files and their edge cases."""

import threading

import pytest
from pyspark.sql import functions as F

from motorpool.dictionaries import NA_TOKENS
from motorpool.sources import delimited, files

HEADER = "UF;Marca Modelo;Ano Fabricação Veículo CRV;Qtd. Veículos\n"


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder)


def load(spark, folder, **options):
    rows, total = delimited.load_period(spark, str(folder), **options)
    found = rows.orderBy("record").collect()
    assert len(found) == total
    return found


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_encodings(spark, tmp_path, encoding):
    put(tmp_path, "a.csv", HEADER + "SÃO;CITROËN/C3;2010;5\nRJ;FORD/KA;2011;6\n", encoding)
    rows = load(spark, tmp_path)
    assert [(r.uf, r.marca_modelo) for r in rows] == [("SÃO", "CITROËN/C3"), ("RJ", "FORD/KA")]
    assert [(r.csv_row, r.record, r.source_file) for r in rows] == [(2, 0, "a.csv"), (3, 1, "a.csv")]


def test_cells_blank_lines_quotes_and_tokens(spark, tmp_path):
    body = "\t SP  ;\"A;\"\"B\"\"/C\";2010;5\n\n ;FORD/KA;;\nRJ;X\n"
    body += "".join(f"{t};T/{i};1;1\n" for i, t in enumerate(NA_TOKENS) if t)
    put(tmp_path, "a.csv", HEADER + body)
    rows = load(spark, tmp_path)
    assert (rows[0].uf, rows[0].marca_modelo) == ("SP", 'A;"B"/C')
    assert (rows[1].uf, rows[1].ano_fabricacao_veiculo_crv, rows[1].qtd_veiculos) == (None, None, None)
    assert (rows[2].uf, rows[2].marca_modelo, rows[2].qtd_veiculos) == ("RJ", "X", None)
    assert [r.uf for r in rows[3:]] == [None] * (len(NA_TOKENS) - 1)
    assert [r.csv_row for r in rows] == list(range(2, 2 + len(rows)))


def test_files_of_both_encodings_and_line_breaks_in_quotes(spark, tmp_path):
    put(tmp_path, "a b+ç.csv", HEADER + "SÃO;CITROËN/C3;2010;5\n")
    put(tmp_path, "b.csv", HEADER + "PARÁ;CITROËN/C4;2010;5\n", "latin-1")
    put(tmp_path, "c.csv", HEADER + 'RJ;"FORD/\nKA";2010;5\nMG;FORD/KA;2011;6\n')
    put(tmp_path, "d.csv", "\ufeff" + HEADER + "AC;FORD/KA;2012;7\n")
    rows = load(spark, tmp_path, multi_file=True)
    assert [(r.uf, r.marca_modelo, r.source_file, r.csv_row) for r in rows] == [
        ("SÃO", "CITROËN/C3", "a b+ç.csv", 2), ("PARÁ", "CITROËN/C4", "b.csv", 2), ("RJ", "FORD/\nKA", "c.csv", 2),
        ("MG", "FORD/KA", "c.csv", 3), ("AC", "FORD/KA", "d.csv", 2),
    ]


def test_quotes_inside_cells_keep_a_file_splittable(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + 'SP;FORD/F 15" X;2010;5\nRJ;"A;""B""/C";2011;6\nMG;FORD/KA";2012;7\n')
    paths = delimited.list_inputs(spark, str(tmp_path))
    assert list(delimited.inspect(spark, paths)) == [delimited.Reading()]
    assert [(r.uf, r.marca_modelo) for r in load(spark, tmp_path)] == [("SP", 'FORD/F 15" X'), ("RJ", 'A;"B"/C'), ("MG", 'FORD/KA"')]


@pytest.mark.parametrize("tail", ['RJ;"FORD/KA;2011;6\nMG;FORD/KA;2012;7\n', 'RJ;"A\nB";1;1\nMG;"C;2012;7\nAC;D;1;1\n'])
def test_a_quote_left_open_stops_the_load(spark, tmp_path, tail):
    put(tmp_path, "a.csv", HEADER + "SP;FORD/KA;2010;5\n" + tail)
    with pytest.raises(ValueError, match="not closed"):
        load(spark, tmp_path)


def test_token_match_is_exact(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + "NULL;A/B;1;1\n NULL;A/B;1;1\nNull;A/B;1;1\n")
    assert [r.uf for r in load(spark, tmp_path)] == [None, "NULL", "Null"]


def test_headers(spark, tmp_path):
    put(tmp_path / "ok", "a.csv", " uf ;MARCA MODELO;ano fabricação veículo crv;qtd. veículos\nSP;A/B;1;2\n")
    assert load(spark, tmp_path / "ok")[0].qtd_veiculos == "2"
    put(tmp_path / "accent", "a.csv", "UF;Marca Modelo;Ano Fabricacao Veiculo CRV;Qtd. Veículos\nSP;A/B;1;2\n")
    with pytest.raises(ValueError, match="missing columns: Ano Fabricação"):
        load(spark, tmp_path / "accent")
    put(tmp_path / "extra", "a.csv", HEADER.strip() + ";Município\nSP;A/B;1;2;X\n")
    with pytest.raises(ValueError, match="municipio"):
        load(spark, tmp_path / "extra")


def test_refused_inputs(spark, tmp_path):
    put(tmp_path / "empty", "a.csv", HEADER)
    with pytest.raises(ValueError, match="no records"):
        load(spark, tmp_path / "empty")
    put(tmp_path / "none", "a.CSV", HEADER)
    with pytest.raises(ValueError, match="no .csv file"):
        load(spark, tmp_path / "none")
    put(tmp_path / "long", "a.csv", HEADER + "SP;A/B;1;2;3\n")
    with pytest.raises(Exception, match="more fields than the header"):
        load(spark, tmp_path / "long")
    with pytest.raises(FileNotFoundError):
        delimited.read_delimited(spark, [str(tmp_path / "absent.csv")])
    put(tmp_path / "txt", "a.txt", HEADER)
    with pytest.raises(ValueError, match="expected .csv"):
        delimited.read_delimited(spark, [str(tmp_path / "txt" / "a.txt")])
    upper = put(tmp_path / "upper", "a.CSV", HEADER + "SP;A/B;1;2\n")
    assert delimited.read_delimited(spark, [upper + "/a.CSV"])[0].count() == 1


def test_several_files_need_a_word(spark, tmp_path):
    put(tmp_path, "b.csv", HEADER + "RJ;A/B;1;2\nMG;A/B;1;2\n")
    put(tmp_path, "a.csv", HEADER + "SP;A/B;1;2\n")
    with pytest.raises(ValueError, match="multi_file"):
        load(spark, tmp_path)
    rows = load(spark, tmp_path, multi_file=True)
    assert [(r.uf, r.source_file, r.csv_row, r.record) for r in rows] == [
        ("SP", "a.csv", 2, 0), ("RJ", "b.csv", 2, 1), ("MG", "b.csv", 3, 2),
    ]


def test_numbers_follow_file_order_across_splits(spark, tmp_path):
    lines = "".join(f"S{i};{'X' * (i % 37)}/M;{i};1\n" for i in range(20_000))
    put(tmp_path, "a.csv", HEADER + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows, total = delimited.load_period(spark, str(tmp_path))
        assert total == 20_000
        wrong = rows.where(
            (F.col("ano_fabricacao_veiculo_crv").cast("long") != F.col("record"))
            | (F.col("csv_row") != F.col("record") + 2)
        )
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_periods(spark, tmp_path):
    for name in ("202501", "202613", "202506", "notes", "2025"):
        (tmp_path / name).mkdir()
    (tmp_path / "202701").write_text("a file")
    base = str(tmp_path)
    assert delimited.list_periods(spark, base) == [202501, 202506, 202613]
    assert delimited.resolve_period(spark, base)[0] == 202613
    assert delimited.resolve_period(spark, base, 202501)[1].endswith("/202501")
    with pytest.raises(ValueError):
        delimited.resolve_period(spark, base, 202502)
    with pytest.raises(ValueError):
        delimited.resolve_period(spark, base + "/absent")
    (tmp_path / "bare").mkdir()
    with pytest.raises(ValueError):
        delimited.resolve_period(spark, base + "/bare")
    assert delimited.list_inputs(spark, base + "/absent") == []


def test_municipal_text_file_rolls_up_and_writes(spark, tmp_path):
    from motorpool.operators.reports import roll_up_to_state

    header = "UF;Município;Marca Modelo;Ano Fabricação Veículo CRV;Qtd. Veículos\n"
    body = "SP;A;F/K;2010;3\nSP;B;F/K;2010;4\nSP;B;F/K;2011;1\nRJ;C;;2010;9\n;C;F/K;2010;9\nRJ;C;F/K;2010;\n"
    put(tmp_path, "m.txt", header + body)
    scans = delimited.read_delimited(spark, [str(tmp_path / "m.txt")], suffixes=(".txt",))
    rows, _ = delimited.read_records(scans)
    rolled = roll_up_to_state(rows)
    got = {(r.uf, r.marca_modelo, r.ano_fabricacao_veiculo_crv, r.qtd_veiculos) for r in rolled.collect()}
    assert got == {("SP", "F/K", "2010", 7), ("SP", "F/K", "2011", 1), ("RJ", "F/K", "2010", 0)}
    out = str(tmp_path / "out")
    delimited.write_delimited(rolled, out)
    assert delimited.read_delimited(spark, delimited.list_inputs(spark, out))[0].count() == 3


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/deep/pointer.json"
    assert files.read_json(spark, path) is None
    files.replace_json(spark, path, {"v": 1})
    files.replace_json(spark, path, {"v": 2})
    assert files.read_json(spark, path) == {"v": 2}
    assert [e.name for e in files.listing(spark, f"{tmp_path}/deep") if not e.name.startswith(".")] == ["pointer.json"]


def test_file_names_are_decoded_once_a_split(spark, tmp_path):
    for name in ("a+b c.csv", "d%20e.csv"):
        (tmp_path / name).write_text("UF;Marca Modelo;Ano Fabricação Veículo CRV;Qtd. Veículos\nSP;VW/GOL;2010;1\nRJ;VW/GOL;2010;1\n")
    rows, total = delimited.load_period(spark, str(tmp_path), multi_file=True)
    assert "URLDecode" not in rows._jdf.queryExecution().executedPlan().toString() and total == 4
    assert [r.source_file for r in rows.orderBy("record").collect()] == ["a+b c.csv"] * 2 + ["d%20e.csv"] * 2


def test_headers_are_read_side_by_side(spark, tmp_path, monkeypatch):
    """Each header waits for another one: reading them in turn would never end."""
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("A;B\n1;2\n" if i else "A;C\n1;2\n")
    meet, options = threading.Barrier(3, timeout=60), delimited._options
    monkeypatch.setattr(delimited, "_options", lambda *a: meet.wait() is not None and options(*a))
    found = delimited._headers(spark, {delimited.Reading(): [f"{tmp_path}/{i}.csv" for i in range(3)]}, ";")
    assert found == {("A", "B"), ("A", "C")}
