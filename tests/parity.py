"""Compare registered queries with their SQL: `python tests/parity.py [sf_dir] [name ...]`."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    return float(value) if type(value).__name__ == "Decimal" else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None where both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(rel.columns, rel.fetchall())
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}; only ours {list((ours - theirs).items())[:4]};"
        f" only SQL {list((theirs - ours).items())[:4]}"
    )


def main() -> int:
    from plotwright.checks import oracle_sql, queries
    from plotwright.session import build_session, drop_work

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="plotwright-parity-"))
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(spark, con, sf_dir, query, sql[name])
                note = "ok" if found is None else found
            else:
                found, note = None, f"rows only: {len(query(spark, sf_dir).collect())}"
        except Exception as error:  # noqa: BLE001
            found = note = f"{type(error).__name__}: {str(error)[:600]}"
        drop_work(spark)
        bad += found is not None
        print(f"{'FAIL' if found else 'pass'} {name} {time.time() - start:.1f}s {note}"[:1200], flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
