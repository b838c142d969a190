"""Intermediate tables in the folder that driver and executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession

# For sessions that name no spark.checkpoint.dir; may be set while the session runs.
FOLDER = "chronolex.scratch.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or by FOLDER where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER, None)
    if not folder:
        raise ValueError(f"set spark.checkpoint.dir or {FOLDER} to a folder that all executors share")
    return folder


def name_folder(spark: SparkSession) -> str:
    """For entry points: in a session that names no folder, use one below its warehouse, which is shared too."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER, None)):
        spark.conf.set(FOLDER, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
    return shared_folder(spark)


def run_folder(spark: SparkSession) -> str:
    """Everything that this application writes lies below it; `drop_run` deletes it."""
    return f"{shared_folder(spark).rstrip('/')}/chronolex/{spark.sparkContext.applicationId}"


def drop_run(spark: SparkSession) -> None:
    """Delete the run folder. Only for the owner of the run, once no table is read any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the run folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner real file sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
