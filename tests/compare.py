"""Runs a query in Spark and its SQL in DuckDB and compares names, types and rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean", "FLOAT": "float",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql) -> list[str]:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in con.execute(f"describe {sql}").fetchall()}
    cur = con.execute(sql)
    theirs = cur.fetchall()
    out = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for f in spark_df.schema.fields:
        mine = f.dataType.simpleString().replace("timestamp_ntz", "timestamp")
        his = KINDS.get(kinds[f.name], kinds[f.name])
        if mine != his:
            out.append(f"type of {f.name}: {mine} != {his}")
    ours = spark_df.collect()
    a, b = rows_of(spark_df.columns, ours), rows_of(names, theirs)
    if a != b:
        out.append(
            f"rows {sum(a.values())} vs {sum(b.values())}; only ours {list((a - b).items())[:3]}; "
            f"only theirs {list((b - a).items())[:3]}"
        )
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries

    from trafficlake.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                found = differences(df, con, sqls[name])
                note = f"{df.count() if len(argv) > 1 else ''}"
            else:
                found, note = [], f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            found, note = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {note}", *found, sep="\n     " if found else " ", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
