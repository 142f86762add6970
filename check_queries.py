"""Run every query beside its SQL oracle and report differences.

    python check_queries.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workload.inputs import TABLES
from workload.oracles import ORACLES
from workload.queries import QUERIES


def canonical(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 9) if isinstance(v, float) else v

    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    failures = 0
    for name in names:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got = [tuple(r) for r in df.collect()]
        except Exception as error:
            failures += 1
            print(f"FAIL {name}: spark: {str(error)[:600]}")
            continue
        seconds = time.time() - started
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows, {seconds:.2f}s")
            continue
        try:
            result = duck.execute(ORACLES[name])
            columns = [c[0] for c in result.description]
            types = [str(c[1]) for c in result.description]
            want = result.fetchall()
        except Exception as error:
            failures += 1
            print(f"FAIL {name}: oracle: {str(error)[:600]}")
            continue
        if sorted(columns) != sorted(df.columns):
            failures += 1
            print(f"FAIL {name}: columns {sorted(df.columns)} / {sorted(columns)}")
            continue
        a, b = canonical(df.columns, got), canonical(columns, want)
        if a != b:
            failures += 1
            print(f"FAIL {name}: {len(got)} / {len(want)} rows")
            print("   only spark ", list((a - b).items())[:3])
            print("   only oracle", list((b - a).items())[:3])
            continue
        oracle_types = dict(zip(columns, types))
        kinds = {c: (t, oracle_types[c]) for c, t in df.dtypes}
        odd = {c: k for c, k in kinds.items() if not same_type(*k)}
        print(f"ok   {name}: {len(got)} rows, {seconds:.2f}s" + (f" types {odd}" if odd else ""))
    print(f"{failures} failures")
    return 1 if failures else 0


def same_type(spark_type: str, duck_type: str) -> bool:
    pairs = {
        "string": "VARCHAR",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "date": "DATE",
    }
    return pairs.get(spark_type) == duck_type


if __name__ == "__main__":
    sys.exit(main())
