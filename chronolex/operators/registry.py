"""Run log and model versions as tables."""

import json
import uuid

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex.schema import ARCHIVED, PRODUCTION, STAGING

MIN_ACCURACY = 0.70
MIN_F1_GAIN = 0.01

RUN_SCHEMA = (
    "run_id string, model_name string, feature_table string, feature_version string, "
    "data_version string, params map<string,string>"
)


# What stands between and for absent values in the text of a row.
SEPARATOR, ABSENT = "\x1f", "\x00"


def row_digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """`digest`: the first 15 hex digits of the MD5 of each row's values as text, as a number."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)) for c in columns]
    return df.select(F.conv(F.substring(F.md5(F.concat_ws(SEPARATOR, *texts)), 1, 15), 16, 10).cast("decimal(38,0)").alias("digest"))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> str:
    """Rows and the sum of their digests: the version of a table's content. Runs one aggregate.

    Sums do not depend on the order of rows, nor on partitions or files, and those of disjoint parts add up;
    repeated rows count. Columns are taken in the given order, or by name. An empty table is "0-0".
    """
    found = row_digests(df, columns or sorted(df.columns)).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("digest"), F.lit(0)).alias("s")
    )
    row = found.head()
    return f"{row['n']}-{row['s']}"


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_row(
    model_name: str,
    params: dict,
    run_id: str | None = None,
    feature_table: str = "features",
    feature_version: str = "v1",
    data_version: str = "v1",
) -> tuple:
    texts = {k: str(v) for k, v in params.items()}
    return (run_id or new_run_id(), model_name, feature_table, feature_version, data_version, texts)


def run_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per run; a training job adds a handful."""
    return spark.createDataFrame(rows, RUN_SCHEMA)


def latest_version(versions: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Newest version of each model name in a stage; an aggregate, so long histories are no hot group."""
    newest = F.max_by(F.struct("version", "stage", "run_id", "accuracy", "f1"), "version")
    return (
        versions.filter(F.col("stage") == stage)
        .groupBy("name")
        .agg(newest.alias("v"))
        .select("name", "v.*")
    )


def production_version(versions: DataFrame, name: str) -> str:
    """Version of the Production model, 'unknown' if there is none. Reads one row."""
    row = latest_version(versions.filter(F.col("name") == name)).head()
    return str(row["version"]) if row else "unknown"


def promote(versions: DataFrame) -> DataFrame:
    """Per name: newest Staging version to Production, former Production to Archived.

    Names without a Staging version stay as they are.
    """
    staged = F.when(F.col("stage") == STAGING, F.col("version"))
    newest = (
        versions.groupBy("name").agg(F.max(staged).alias("_new")).filter(F.col("_new").isNotNull())
    )
    # One name with a long history is a hot key of the streamed side, which adaptive execution may cut.
    joined = versions.join(newest, "name", "left")
    stage = (
        F.when((F.col("stage") == STAGING) & (F.col("version") == F.col("_new")), PRODUCTION)
        .when(F.col("_new").isNotNull() & (F.col("stage") == PRODUCTION), ARCHIVED)
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("stage", stage).drop("_new")


def select_best(
    versions: DataFrame, min_accuracy: float = MIN_ACCURACY, min_f1_gain: float = MIN_F1_GAIN
) -> DataFrame:
    """The Staging candidate that passes the gate with the highest F1.

    The gate: enough accuracy, and an F1 gain over the current Production F1 if there is any.
    """
    current = (
        versions.filter(F.col("stage") == PRODUCTION)
        .select(F.max_by("f1", "version").alias("production_f1"))
        .scalar()
    )
    gained = F.coalesce(F.col("f1") >= current + min_f1_gain, current.isNull())
    return (
        versions.filter((F.col("stage") == STAGING) & (F.col("accuracy") >= min_accuracy) & gained)
        .orderBy(F.col("f1").desc(), "name", "version")
        .limit(1)
    )


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """A saved model of whatever class its metadata names."""
    metadata = json.loads(spark.read.text(f"{path}/metadata").head()["value"])
    if metadata["class"].endswith("PipelineModel"):
        return PipelineModel.load(path)
    return DefaultParamsReader.loadParamsInstance(path, spark.sparkContext)


def load_production_model(spark: SparkSession, versions: DataFrame, name: str, base_path: str) -> tuple[Model, str]:
    """The Production model (saved below `base_path` by run id) and its version."""
    row = latest_version(versions.filter(F.col("name") == name)).head()
    if row is None:
        raise LookupError(f"no Production version of {name}")
    return load_model(spark, f"{base_path}/{row['run_id']}"), str(row["version"])
