"""Run registered queries beside their SQL in DuckDB: ``python tests/oracle_check.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, sf_dir: str, function, sql: str | None) -> tuple[str, int]:
    """('ok' | 'rows-only' | what differs, number of Spark rows)."""
    df = function(spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    if sql is None:
        return ("rows-only" if mine else "EMPTY"), len(mine)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} / {sorted(names)}", len(mine)
    same_type = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if t in same_type and same_type[t] != kinds[c]]
    if wrong:
        return f"TYPES {wrong}", len(mine)
    if len(mine) != len(theirs):
        return f"ROWS {len(mine)} / {len(theirs)}", len(mine)
    bad = [(m, t) for m, t in zip(mine, theirs) if m != t]
    return (f"VALUES {len(bad)} differ, first {bad[0]}" if bad else "ok"), len(mine)


if __name__ == "__main__":
    from statweave.queries.catalog import ORACLES, QUERIES
    from statweave.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    session, con = build_session(), duck(folder)
    failed = 0
    for name in chosen:
        began = time.time()
        try:
            verdict, count = compare(session, con, folder, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on with the other queries
            verdict, count = f"ERROR {type(error).__name__} {str(error)[:1200]}", -1
        failed += verdict not in ("ok", "rows-only")
        print(f"{name:32s} {count:8d} rows {time.time() - began:7.2f}s  {verdict}", flush=True)
    print("failed:", failed)
