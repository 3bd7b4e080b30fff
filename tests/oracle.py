"""Compare registered queries with their SQL on the same files.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if v is None:
        return "∅"
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted([tuple(str(_norm(r[i])) for i in order) for r in rows])


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return _rows([c[0] for c in cur.description], cur.fetchall())


def differences(spark, con, sf_dir, name, fn, sql):
    """None when equal, else a short description."""
    cols_a, a = spark_rows(fn(spark, sf_dir))
    cols_b, b = sql_rows(con, sql)
    if cols_a != cols_b:
        return f"columns differ: spark {cols_a} sql {cols_b}"
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return f"rows {len(a)} vs {len(b)}; only spark {only_a}; only sql {only_b}"
    return None if a else "EMPTY"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tapecheck.settings import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = local_session(cpus="8")
    con = connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            if name in sqls:
                err = differences(spark, con, sf_dir, name, fn, sqls[name])
            else:
                n = len(fn(spark, sf_dir).collect())
                err = None if n else "EMPTY"
                name += f" (no sql, {n} rows)"
        except Exception as e:  # noqa: BLE001
            err = f"{type(e).__name__}: {str(e)[:600]}"
        bad += err is not None
        print(f"{'ok  ' if err is None else 'FAIL'} {time.time() - t:6.2f}s {name} {err or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
