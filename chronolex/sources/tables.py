"""Year-partitioned tables: writers and readers."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.ml import PipelineModel


def write_year(
    df: DataFrame,
    base_path: str,
    year: int | None = None,
    ts_col: str | None = "ingestion_ts",
    compression: str = "snappy",
    rebalance: bool = True,
    row_group_bytes: int | None = None,
) -> None:
    """Replace the year partitions present in `df` and leave every other year alone.

    Rerunning a year gives the same table. `year` fills the column when it is absent. The rebalance
    hint lets adaptive execution cut a large year into several files and merge small ones; rows that come
    from a table by years, task for task, need no such shuffle. Spark reads a file in parts no smaller than its
    row groups; with smaller ones (`row_group_bytes`, uncompressed) a year of few files is still read by all cores.
    """
    if ts_col:
        df = df.withColumn(ts_col, F.current_timestamp())
    if "year" not in df.columns:
        if year is None:
            raise ValueError("the data has no year column and no year was given")
        df = df.withColumn("year", F.lit(year).cast("int"))
    writer = (
        (df.hint("rebalance", "year") if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("year")
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(base_path)


def append_rows(df: DataFrame, base_path: str, partition_by: list[str] | None = None) -> None:
    """Append, optionally partitioned. Not idempotent; use `write_year` for reruns."""
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(base_path)


def read_year(spark: SparkSession, base_path: str, year: int) -> DataFrame:
    """One year of a partitioned table: only its folder is listed, and `year` stays a column."""
    return spark.read.parquet(base_path).filter(F.col("year") == year)


def _numeric_predictions(df: DataFrame) -> DataFrame:
    columns = [c for c in ("pred_label", "prob_democrat", "prob_republican") if c in df.columns]
    return df.withColumns(
        {"year": F.col("year").cast("int"), **{c: F.col(c).try_cast("double") for c in columns}}
    )


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def year_folders(spark: SparkSession, base_path: str) -> dict[int, str]:
    """The year folders of a table that are there, by year."""
    context = spark.sparkContext
    base = context._jvm.org.apache.hadoop.fs.Path(base_path)
    found = base.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(base)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    return {int(n[5:]): f"{base_path}/{n}" for n in sorted(names) if n.startswith("year=") and n[5:].lstrip("-").isdigit()}


def load_prediction_exports(spark: SparkSession, exports: dict[int, str]) -> DataFrame:
    """Union of per-year exports by column name; absent years are skipped, bad numbers are NULL."""
    frames = []
    for year, path in exports.items():
        frame = _read_if_present(spark, path)
        if frame is None:
            continue
        if "year" not in frame.columns:
            frame = frame.withColumn("year", F.lit(year))
        frames.append(_numeric_predictions(frame))
    if not frames:
        raise FileNotFoundError(f"no prediction export found in {sorted(exports.values())}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_predictions(spark: SparkSession, base_path: str) -> DataFrame:
    """All years of the partitioned prediction table."""
    frame = _read_if_present(spark, base_path)
    if frame is None:
        raise FileNotFoundError(f"no prediction table at {base_path}")
    return _numeric_predictions(frame)


def numeric_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {"year": F.col("year").cast("int"), "metric_value": F.col("metric_value").try_cast("double")}
    )


def matching_metrics(metrics: DataFrame, pattern: str) -> DataFrame:
    """Rows whose metric name matches, ignoring case; a NULL name does not match."""
    return metrics.filter(F.col("metric_name").rlike(f"(?i){pattern}"))


def load_drift_metrics(spark: SparkSession, base_path: str, metric_filter: str | None = None) -> DataFrame:
    frame = _read_if_present(spark, base_path)
    if frame is None:
        raise FileNotFoundError(f"no drift metrics at {base_path}")
    metrics = numeric_metrics(frame)
    return matching_metrics(metrics, metric_filter) if metric_filter else metrics


def write_drift_metrics(metrics: DataFrame, base_path: str) -> None:
    """Metric rows by year, replacing the years present; stamped `computed_ts`."""
    write_year(metrics, base_path, ts_col="computed_ts")


def save_feature_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_feature_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
