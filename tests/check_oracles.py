"""Compare every query with its SQL: ``python tests/check_oracles.py [sf_dir] [names..]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def open_tables(sf_dir: str):
    duck = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            duck.execute(
                f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')"
            )
    return duck


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same_rows(df, result):
    """Same names, types and rows, in any order; else the first difference."""
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    ours_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    ours = _sorted_rows(df.columns, df.collect())
    theirs = _sorted_rows(list(theirs_types), result.fetchall())
    if sorted(ours_types) != sorted(theirs_types):
        return False, (ours_types, theirs_types)
    for a, b in zip(ours, theirs):
        if a != b:
            return False, (a, b)
    if len(ours) != len(theirs):
        return False, (len(ours), len(theirs))
    # DuckDB may count in wider integers than bigint; any other difference is one.
    wider = {n: (ours_types[n], t) for n, t in theirs_types.items() if ours_types[n] != t}
    bad = {n: p for n, p in wider.items() if p not in (("BIGINT", "HUGEINT"), ("BIGINT", "INTEGER"), ("INTEGER", "BIGINT"))}
    return not bad, bad or f"{len(ours)} rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck, queries, oracles, bad = open_tables(sf_dir), contract.queries(), contract.oracle_sql(), []
    for name in names or queries:
        start = time.time()
        same, detail = same_rows(queries[name](spark, sf_dir), duck.execute(oracles[name]))
        print(f"{'ok ' if same else 'BAD'} {name} {detail} {time.time() - start:.1f}s", flush=True)
        if not same:
            bad.append(name)
    print("mismatches:", bad)
    return len(bad)


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(where, sys.argv[2:])))
