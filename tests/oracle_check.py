"""Compare registered queries with their oracle SQL (names, kinds of type, rows)."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comarca.plans.workload import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, int):
        return f"{v}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def kind(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"):
        return "integer"
    if t.startswith(("double", "float", "decimal")):
        return "real"
    return {"varchar": "string"}.get(t, t)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    order = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in order) for r in df.select(*[f"`{c}`" for c in order]).collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: kind(str(d[1])) for d in rel.description}
    if sorted(names) != order:
        return f"columns {order} != {sorted(names)}"
    ours = {n: kind(t) for n, t in df.dtypes}
    bad = {n: (ours[n], types[n]) for n in order if ours[n] != types[n]}
    at = [names.index(c) for c in order]
    want = sorted(tuple(canon(r[i]) for i in at) for r in rel.fetchall())
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)}; order {order}\n   only spark {extra}\n   only oracle {missing}"
    return f"types {bad}" if bad else None


def main() -> int:
    from comarca.plans.catalog import QUERIES
    from comarca.plans.oracles import ORACLES
    from comarca.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        if name not in ORACLES:
            print(f"{name:28s} no oracle")
            continue
        try:
            problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:5.1f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
