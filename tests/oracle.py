"""Side-by-side check of the registered queries: `python tests/oracle.py DIR [name...]`."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def frozen(value):
    """Rows can be counted when their lists, structs and maps can be hashed."""
    if isinstance(value, dict):
        return frozenset((k, frozen(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(frozen(v) for v in value)
    return value


def sql_rows(sf: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'").fetchall()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(frozen(r[i]) for i in order) for r in cur.fetchall())
    con.close()
    return sorted(names), rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(frozen(r[n]) for n in names) for r in df.collect())


def compare(spark, sf: str, name: str) -> tuple[int, list, list]:
    """Row count, rows only Spark has, rows only the SQL has."""
    import __spark_entry__ as entry

    names, got = spark_rows(entry.queries()[name](spark, sf))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return sum(got.values()), [], []
    want_names, want = sql_rows(sf, sql)
    if names != want_names:
        return sum(got.values()), [names], [want_names]
    return sum(got.values()), list((got - want).items()), list((want - got).items())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            n, extra, missing = compare(spark, sys.argv[1], name)
        except Exception as e:  # keep going: this is a report
            print(f"ERROR {name}: {str(e)[:600]}", flush=True)
            continue
        good = "ok   " if not extra and not missing and n else "DIFF "
        kind = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{good} {name} rows={n} {time.time() - start:.1f}s{kind}", flush=True)
        if good != "ok   ":
            print("   spark:", str(extra[:2])[:500], len(extra))
            print("   sql:  ", str(missing[:2])[:500], len(missing))
