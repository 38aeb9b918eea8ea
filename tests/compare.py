"""Run registered queries beside their SQL and compare the results as unordered rows.

``python tests/compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def oracle(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    want = Counter(tuple(plain(row[names.index(n)]) for n in order) for row in cur.fetchall())
    got = Counter(tuple(plain(row[n]) for n in order) for row in df.collect())
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"rows {sum(got.values())} != {sum(want.values())}; only spark {sum(extra.values())} e.g. "
        f"{next(iter(extra), None)}; only sql {sum(missing.values())} e.g. {next(iter(missing), None)}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tickward.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = oracle(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            verdict = compare(df, con, sqls[name]) if name in sqls else f"{df.count()} rows (no SQL)"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
