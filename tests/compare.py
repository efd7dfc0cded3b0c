"""Runs queries in Spark and their SQL in DuckDB and compares whole results.

    python tests/compare.py [--sf 0.01 | --dir PATH] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata")


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(sf_dir.glob("*.parquet")):
        source = f"{file}/*.parquet" if file.is_dir() else file
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value + 0.0))
    return (3, str(value))


def canonical(names: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(cell(r[i]) for i in order) for r in rows])


def kind(type_name: str) -> str:
    for prefix, name in (("timestamp", "timestamp"), ("decimal", "decimal")):
        if type_name.lower().startswith(prefix):
            return name
    return {
        "bigint": "long",
        "integer": "int",
        "varchar": "string",
        "boolean": "bool",
    }.get(type_name.lower(), type_name.lower())


def spark_kind(type_name: str) -> str:
    return {"bigint": "long", "boolean": "bool"}.get(type_name, type_name)


def mismatch(df, con, sql: str) -> str | None:
    """First difference between a Spark result and the SQL's, or None."""
    rows = df.collect()
    got_names, got = canonical(df.columns, rows)
    relation = con.sql(sql)
    want_names, want = canonical(relation.columns, relation.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    got_types = {n: spark_kind(t) for n, t in df.dtypes}
    want_types = {
        n: kind(str(t)) for n, t in zip(relation.columns, relation.types, strict=True)
    }
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"first difference {g} != {w}"
    return None


def main(argv: list[str]) -> int:
    sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir = DATA / "sf0.01"
    if argv[:1] == ["--sf"]:
        sf_dir, argv = DATA / f"sf{argv[1]}", argv[2:]
    elif argv[:1] == ["--dir"]:
        sf_dir, argv = Path(argv[1]), argv[2:]
    spark, con = make_session(), connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if argv and name not in argv:
            continue
        start = time.perf_counter()
        try:
            df = run(spark, str(sf_dir))
            if name in sqls:
                problem = mismatch(df, con, sqls[name])
                state = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                problem, state = None, f"rows {df.count()} {df.dtypes}"
        except Exception as error:  # report and go on with the next query
            problem = state = f"ERROR {str(error)[:1500]}"
        bad += problem is not None
        print(f"{time.perf_counter() - start:6.2f}s {name:24} {state[:1800]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
