"""Run named queries on Spark and their SQL on DuckDB, and compare rows and types.

usage: check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tallyhouse.plans import all_queries, all_sql  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "JSON": "string",
}


def plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(con, df, sql: str) -> str:
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if names != sorted(wanted):
        return f"columns {names} vs {sorted(wanted)}"
    for c in names:
        if KINDS.get(wanted[c], wanted[c]) != kinds[c]:
            problems.append(f"type {c}: spark {kinds[c]} duckdb {wanted[c]}")
    order = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(tuple(plain(v) for v in r) for r in con.execute(f"SELECT {order} FROM ({sql})").fetchall())
    mine = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if mine != theirs:
        a, b = mine - theirs, theirs - mine
        problems.append(f"rows spark {sum(mine.values())} duckdb {sum(theirs.values())}; only spark {sum(a.values())} e.g. {list(a)[:2]}; only duckdb {sum(b.values())} e.g. {list(b)[:2]}")
    return "; ".join(problems) or f"ok {sum(mine.values())} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    sqls, failed = all_sql(), 0
    for name, fn in all_queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            verdict = compare(con, df, sqls[name]) if name in sqls else f"rows only {df.count()}"
        except Exception as e:  # report and go on to the next query
            verdict = f"error {type(e).__name__}: {str(e)[:700]}"
        bad = not verdict.startswith(("ok", "rows only"))
        failed += bad
        print(f"{'FAIL' if bad else 'pass'} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
