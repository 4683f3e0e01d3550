"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf] [names...]"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v) if v is not None else None


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql) -> str:
    got = spark_df.collect()
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return f"COLUMNS {sorted(set(spark_df.columns) ^ set(columns))}"
    a, b = rows_of(spark_df.columns, got), rows_of(columns, want)
    if a == b:
        types = {d[0]: str(d[1]) for d in res.description}
        loose = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP"}
        off = [
            f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}"
            for f in spark_df.schema.fields
            if loose.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) != types[f.name].replace(" ", "")
        ]
        return f"ok {sum(a.values())}" + (f" TYPES {off}" if off else "") + (" EMPTY" if not a else "")
    extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"DIFF spark={sum(a.values())} sql={sum(b.values())}\n  cols  {sorted(columns)}\n  spark {extra}\n  sql   {missing}"


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    names = args[1:] or list(entry.queries())
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/sf{sf}"
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        began = time.time()
        try:
            df = queries[n](spark, sf_dir)
            result = compare(df, con, oracles[n]) if n in oracles else f"rows {df.count()} (no SQL)"
        except Exception as e:
            result = f"ERROR {type(e).__name__}: {str(e)[:900]}"
        bad += not result.startswith(("ok", "rows"))
        print(f"{n:28s} {time.time() - began:6.2f}s {result}", flush=True)
    print("bad:", bad, "of", len(names))
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
