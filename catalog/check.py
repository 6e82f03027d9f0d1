"""Compare every registered query with its SQL: python -m catalog.check [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

from catalog.oracles import oracle_sql
from catalog.queries import QUERIES
from jobsignal.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if the query and its SQL agree in names, types and rows, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(_plain(v) for v in r) for r in df.select(*columns).collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"columns {columns} != {sorted(rel.columns)}"
    want_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    types = {c: t for c, t in df.dtypes if want_types[c] != t}
    order = [rel.columns.index(c) for c in columns]
    want = Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    if got != want:
        return (f"rows {got.total()} != {want.total()}; only Spark "
                f"{str(list((got - want).items())[:2])[:700]}; only SQL "
                f"{str(list((want - got).items())[:2])[:700]}")
    if not got:
        return "no rows"
    if types:
        return f"types {types} != { {c: want_types[c] for c in types} }"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("catalog-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # one broken query must not hide the others
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
