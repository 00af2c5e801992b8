"""Run registered queries against their DuckDB oracle: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its oracle; empty if nothing does."""
    names = sorted(df.columns)
    expected = con.execute(sql)
    their_names = sorted(column[0] for column in expected.description)
    if names != their_names:
        return [f"columns {names} != {their_names}"]
    order = [column[0] for column in expected.description]
    theirs = sorted((tuple(row[order.index(n)] for n in names) for row in expected.fetchall()), key=repr)
    ours = sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    types = {(type(a).__name__, type(b).__name__) for r, s in zip(ours, theirs) for a, b in zip(r, s)}
    odd = sorted(f"{a}/{b}" for a, b in types if a != b and "NoneType" not in (a, b))
    bad = [(r, s) for r, s in zip(ours, theirs) if repr(r) != repr(s)]
    return [f"types {odd}"] * bool(odd) + [f"{len(bad)} of {len(ours)}: {r} != {s}" for r, s in bad[:2]]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from swaplens.session import local_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = oracle(folder)
    failed = 0
    for name, make in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = make(spark, folder)
            sql = oracle_sql().get(name)
            found = differences(df, con, sql) if sql else [] if df.count() >= 0 else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print("failed", failed)
