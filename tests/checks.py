"""Side-by-side check of registered queries against DuckDB: `python tests/checks.py SF_DIR [names]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if both sides have the same columns, types and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(result.fetchall(), names)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = dict(df.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "decimal(5,2)": "DECIMAL(5,2)"}
    for name, kind in ((d[0], str(d[1])) for d in result.description):
        if same.get(kinds[name], kinds[name]) != kind:
            return f"type of {name}: {kinds[name]} != {kind}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for ours, theirs in zip(got, expected):
        if ours != theirs:
            return f"first difference {ours} != {theirs}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from motorpool.plans.oracle import ORACLES
    from motorpool.plans.registry import QUERIES
    from motorpool.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, ORACLES[name]) if name in ORACLES else "no SQL"
        except Exception as error:  # report and go on
            problem = f"error {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:30s} {time.time() - started:7.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
