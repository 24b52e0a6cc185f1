"""Run queries on Spark and their SQL twins on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def spark_rows(df) -> tuple[list[str], list]:
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), rows(names, cur.fetchall())


if __name__ == "__main__":
    from farescope.session import build_session
    from farescope.plans.oracles import all_oracles
    from farescope.plans.registry import all_queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf_dir), all_oracles(), []
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            columns, got = spark_rows(query(spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"{name:24} {sum(got.values()):8} rows, no SQL twin   {took:.1f}s")
                continue
            names, want = duck_rows(con, oracles[name])
            took2 = time.time() - start - took
        except Exception as error:  # noqa: BLE001 - report and go on
            bad.append(name)
            print(f"{name:24} ERROR {str(error)[:1500]}")
            continue
        same = columns == names and got == want
        print(f"{name:24} {sum(got.values()):8} {sum(want.values()):8} {'ok' if same else 'DIFF'} {took:.1f}s {took2:.1f}s")
        if not same:
            bad.append(name)
            if columns != names:
                print("  columns", columns, names)
            print("  only spark", list((got - want).items())[:3])
            print("  only sql  ", list((want - got).items())[:3])
    print("bad:", bad)
