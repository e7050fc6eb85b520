"""Compare registered queries with their SQL on the given tables.

``python -m tests.oracle [--sf 0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """Python value in a form both engines share."""
    if isinstance(value, decimal.Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if value is None else str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when the results agree, else what differs."""
    df = build(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mine = rows_of(df.columns, df.collect())
    theirs = rows_of(names, result.fetchall())
    if mine == theirs:
        return None
    extra, lacking = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; "
        f"only Spark {list(extra)[:2]}; only SQL {list(lacking)[:2]}"
    )


def main() -> None:
    from canvass.catalog import ORACLE, QUERIES
    from canvass.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name, build in QUERIES.items():
        if args.names and name not in args.names:
            continue
        if args.module and not build.__module__.endswith(args.module):
            continue
        start = time.time()
        try:
            if name not in ORACLE:
                problem = f"no SQL; {len(build(spark, sf_dir).collect())} rows"
            else:
                problem = compare(spark, con, build, ORACLE[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} to look at")


if __name__ == "__main__":
    main()
