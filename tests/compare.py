"""Run registered queries against their SQL in DuckDB: same columns, types, and rows in any order.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
_KINDS = {"bigint": "int64", "int": "int32", "double": "double", "string": "string", "boolean": "bool"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows, columns, order):
    at = [columns.index(c) for c in order]
    return sorted((tuple(r[i] for i in at) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    described = {d[0]: str(d[1]).lower() for d in result.description}
    theirs, names = result.fetchall(), [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    spark_types = dict(df.dtypes)
    short = {"bigint": "bigint", "integer": "int", "double": "double", "varchar": "string", "boolean": "boolean",
             "int64": "bigint", "int32": "int", "string": "string", "bool": "boolean", "float64": "double", "number": None}
    for name, kind in described.items():
        expected = short.get(kind, kind)
        if expected and expected != spark_types[name]:
            return f"type of {name}: {spark_types[name]} != {kind}"
    order = sorted(names)
    ours = _sorted([tuple(r) for r in df.collect()], df.columns, order)
    theirs = _sorted(theirs, names, order)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(order, a, b) if x != y]
            return f"values {bad} in {a}"
    return None if ours else "no rows"


def main() -> None:
    import __spark_entry__ as entry
    from roamgrid.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in args[1:] or queries:
        start = time.perf_counter()
        try:
            df = queries[name](spark, sf_dir)
            problem = differences(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:22} {time.perf_counter() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
