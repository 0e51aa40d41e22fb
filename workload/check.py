"""Compare registered queries with their SQL: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.inputs import TABLES
from workload.queries import QUERIES


def local_session(cores: int = 8) -> SparkSession:
    """A local session with small-data settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # One aggregate over many columns has more fields than the default of 100.
        .config("spark.sql.codegen.maxFields", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the given tables as views."""
    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return base


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def as_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns sorted by name, in a comparable order."""
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    picked = [tuple(_cell(row[at]) for at in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def difference(name: str, spark: SparkSession, sf_dir: str, base: duckdb.DuckDBPyConnection) -> str | None:
    """What differs between the query and its SQL, or None."""
    query = QUERIES[name]
    df = query.run(spark, sf_dir)
    got = as_rows(df.columns, [tuple(row) for row in df.collect()])
    answer = base.execute(query.sql)
    names = [column[0] for column in answer.description]
    want = as_rows(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for ours, theirs in zip(got, want):
        if ours != theirs:
            return f"{ours} and {theirs}"
        if [type(v) for v in ours] != [type(v) for v in theirs]:
            return f"types of {ours} and {theirs}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    base = oracle(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            if QUERIES[name].sql is None:
                rows = QUERIES[name].run(spark, sf_dir).collect()
                note = f"no SQL, {len(rows)} rows"
            else:
                found = difference(name, spark, sf_dir, base)
                note = "ok" if found is None else f"DIFFERS {found}"
        except Exception as error:  # report and go on with the next query
            note = f"DIFFERS {type(error).__name__}: {str(error)[:600]}"
        bad += note.startswith("DIFFERS")
        print(f"{name:28s} {time.time() - started:7.2f}s  {note}", flush=True)
    print(f"{bad} of {len(names)} differ")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
