"""Compare registered queries with their SQL checks: ``python tests/check.py [--sf 0.01] [prefix ...]``."""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

from acadmetric.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(t) else str(t)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, db: duckdb.DuckDBPyConnection, sql: str | None, allow_empty: bool = False) -> str:
    """Empty when equal, else what differs."""
    table = df.toArrow()
    if sql is None:
        return "" if table.num_rows else "no rows"
    want = pa.table(db.sql(sql).to_arrow_table())
    got_types = {f.name: _kind(f.type) for f in table.schema}
    want_types = {f.name: _kind(f.type) for f in want.schema}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    got_rows = _rows(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    want_rows = _rows(want.column_names, zip(*[c.to_pylist() for c in want.columns]))
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows != {len(want_rows)}"
    if not got_rows and not allow_empty:
        return "no rows on either side"
    for got, expected in zip(got_rows, want_rows):
        if got != expected:
            return f"{got} != {expected}"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("prefix", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{options.sf}"
    spark, db = local_session(8), connect(folder)
    checks, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if options.prefix and not any(name.startswith(p) for p in options.prefix):
            continue
        start = time.perf_counter()
        try:
            problem = compare(run(spark, folder), db, checks.get(name))
        except Exception as error:  # report and go on
            problem = (traceback.format_exc() if "-v" in sys.argv else f"{type(error).__name__}: {error}")[:1500]
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {time.perf_counter() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
