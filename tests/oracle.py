"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from gaugeworks.plans.fixtures import TABLES


def cell(value):
    if value is None:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), round(v, 6) if isinstance(v, float) else str(v)) if v is not None else (False, "", 0) for v in row)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of_sql(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def compare(df, con, sql: str) -> str:
    """Empty when equal, else what differs first."""
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    want_names, want = rows_of_sql(con, sql)
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    order = sorted(names)
    gi = [names.index(c) for c in order]
    wi = [want_names.index(c) for c in order]
    a = sorted((tuple(cell(r[i]) for i in gi) for r in got), key=sort_key)
    b = sorted((tuple(cell(r[i]) for i in wi) for r in want), key=sort_key)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        for c, u, v in zip(order, x, y):
            if type(u) is not type(v) and not (u is None or v is None):
                return f"type of {c}: {u!r} ({type(u).__name__}) != {v!r} ({type(v).__name__})"
            if u != v:
                if isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9):
                    return f"float {c}: {u!r} ~ {v!r}"
                return f"value of {c}: {u!r} != {v!r} in {dict(zip(order, x))} vs {dict(zip(order, y))}"
    return ""


def main(argv):
    from gaugeworks.plans import load_all
    from gaugeworks.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    queries, oracles = load_all()
    quiet = {"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session(master="local[8]", shuffle_partitions=8, extra=quiet)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if only and not any(name.startswith(p) for p in only):
            continue
        started = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                text = compare(df, con, oracles[name])
                n = len(rows_of_sql(con, oracles[name])[1])
            else:
                n, text = df.count(), ""
        except Exception as exc:  # report every query
            n, text = -1, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(text)
        print(f"{'BAD ' if text else 'ok  '} {name:32s} n={n:<8d} {time.time() - started:5.1f}s {'' if name in oracles else '(rows only)'} {text}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
