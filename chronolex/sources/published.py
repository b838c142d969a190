"""Sets of tables that readers see whole: a set is there once its marker is, never in part."""

import uuid

from pyspark.sql import DataFrame, SparkSession

MARKERS, SETS = "_published", "sets"


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def published_sets(spark: SparkSession, base_path: str) -> list[str]:
    """Names of the published sets, oldest first."""
    return _names(spark, f"{base_path}/{MARKERS}")


def publish(tables: dict[str, DataFrame], base_path: str) -> dict[str, str]:
    """Write a set of tables and publish it; returns name -> path. Runs actions.

    Each set has a folder of its own. Its marker is an empty file written last, whose name is all it says, so
    there is no moment at which it is half written: a job that fails in between leaves the former set in
    place. Of two jobs at the same time the one with the larger name is read, as a whole.
    """
    spark = next(iter(tables.values())).sparkSession
    earlier = published_sets(spark, base_path)
    number = int(earlier[-1].split("-")[0]) + 1 if earlier else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    paths = {table: f"{base_path}/{SETS}/{name}/{table}" for table in tables}
    for table, df in tables.items():
        df.write.parquet(paths[table])
    marker, files = _folder(spark, f"{base_path}/{MARKERS}/{name}")
    files.create(marker, False).close()
    return paths


def current_set(spark: SparkSession, base_path: str) -> dict[str, str]:
    """The tables of the newest published set: name -> path."""
    names = published_sets(spark, base_path)
    if not names:
        raise FileNotFoundError(f"nothing is published at {base_path}")
    folder = f"{base_path}/{SETS}/{names[-1]}"
    return {table: f"{folder}/{table}" for table in _names(spark, folder)}


def drop_earlier_sets(spark: SparkSession, base_path: str, keep: int = 2) -> list[str]:
    """Delete all but the `keep` newest published sets, markers first; returns their names.

    Folders without a marker stay: one of them may be a set that is being written.
    """
    if keep < 1:
        raise ValueError("the newest set stays")
    dropped = published_sets(spark, base_path)[:-keep]
    for part in (MARKERS, SETS):
        for name in dropped:
            path, files = _folder(spark, f"{base_path}/{part}/{name}")
            files.delete(path, True)
    return dropped
