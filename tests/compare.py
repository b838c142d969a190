"""Compare queries with their SQL forms: columns, types, and rows in any order."""

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chronolex-test-"))
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def difference(df, connection, sql: str) -> str | None:
    """None when the results agree, otherwise what differs."""
    types = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if mine != types:
        return f"schema: {sorted(mine.items())} vs {sorted(types.items())}"
    names = sorted(mine)
    ours = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    cursor = connection.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql})")
    theirs = sorted(tuple(plain(v) for v in r) for r in cursor.fetchall())
    if ours == theirs:
        return None
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"rows {len(ours)} vs {len(theirs)}; only ours {only_ours}; only SQL {only_theirs}"


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as entry

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                result = difference(df, connection, oracles[name])
                result = f"ok {df.count()} rows" if result is None else f"DIFFERS {result}"
            else:
                result = f"rows {len(df.collect())}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += result.startswith(("DIFFERS", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.2f}s {result[:1500]}", flush=True)
    print(f"{bad} bad of {len(names or queries)}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
