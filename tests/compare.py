"""Run registered queries and their SQL side by side: python tests/compare.py sf0.01 [names]."""

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else float(value) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


def oracle_rows(sf_dir: str, sql: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = db.execute(sql)
    return normal([c[0] for c in cursor.description], cursor.fetchall())


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def main() -> None:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, only = f"/root/testdata/{sys.argv[1]}", sys.argv[2:]
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            columns, rows = spark_rows(query(spark, sf_dir))
            seconds = time.time() - start
            if name not in oracles:
                print(f"{name:28s} no oracle {len(rows)} rows {seconds:.2f}s", flush=True)
                continue
            wanted_columns, wanted = oracle_rows(sf_dir, oracles[name])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {str(error)[:500]}", flush=True)
            continue
        same = columns == wanted_columns and rows == wanted
        bad += not same
        print(f"{name:28s} {'ok' if same else 'DIFFERS'} {len(rows)} rows {seconds:.2f}s", flush=True)
        if not same:
            print("   ", columns, wanted_columns if columns != wanted_columns else "", len(rows), len(wanted))
            here, there = set(rows), set(wanted)
            mine, theirs = sorted(here - there, key=repr), sorted(there - here, key=repr)
            print("    spark ", len(mine), mine[:3], "\n    oracle", len(theirs), theirs[:3], flush=True)
    print("differing:", bad, "of", len(queries))


if __name__ == "__main__":
    main()
