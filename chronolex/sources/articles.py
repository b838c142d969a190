"""Article and metadata sources."""

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chronolex import schema
from chronolex.functions.labels import label_from_tags


def scan_articles(spark: SparkSession, path: str, with_article_id: bool = False) -> DataFrame:
    """Article Parquet. `article_id` is a hash of the content, so moving or compacting files keeps it.

    Articles that agree in everything share an id; `distinct_article_ids` tells them apart.
    """
    columns = [F.col(f.name) for f in schema.ARTICLE_SCHEMA]
    if with_article_id:
        columns.append(F.md5(F.to_json(F.struct(*columns)).cast("binary")).alias("article_id"))
    return spark.read.parquet(path).select(*columns)


def distinct_article_ids(articles: DataFrame) -> DataFrame:
    """Number the copies of an article: the first keeps its id, later ones add their number.

    Only ids that occur more than once are counted and joined back, without the text of the others.
    """
    shared = articles.groupBy("article_id").agg(F.count("*").alias("_copies")).filter("_copies > 1")
    single = articles.join(shared, "article_id", "left_anti")
    # Copies are equal in all columns, so one row and a count stand for all of them.
    one = articles.join(shared, "article_id", "left_semi").dropDuplicates(["article_id"])
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_number")
    copies = one.join(shared, "article_id").select("*", number)
    named = F.when(F.col("_number") > 1, F.concat_ws("#", "article_id", "_number")).otherwise(F.col("article_id"))
    return single.unionByName(copies.withColumn("article_id", named).select(*articles.columns))


def in_year(articles: DataFrame, year: int) -> DataFrame:
    """Rows of one calendar year; plain date bounds, so Parquet statistics skip row groups."""
    first, after = datetime.date(year, 1, 1), datetime.date(year + 1, 1, 1)
    return articles.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(after)))


def read_articles(spark: SparkSession, path: str, year: int, with_article_id: bool = False) -> DataFrame:
    return in_year(scan_articles(spark, path, with_article_id), year)


def scan_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata CSV with a header; columns go by name, must be the declared ones, and stay strings.

    Columns beyond the declared ones are read over; a missing one is an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.METADATA_SCHEMA if f.name not in header]
    if missing:
        raise ValueError(f"metadata lacks the columns {', '.join(missing)}")
    declared = {f.name: f.dataType for f in schema.METADATA_SCHEMA}
    types = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header])
    return spark.read.option("header", True).schema(types).csv(path).select("contents", "series")


def label_metadata(
    metadata: DataFrame,
    delimiter: str = schema.TAG_DELIMITER,
    labels: dict[str, float] | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """Usable series with their tag list and numeric label."""
    skipped = schema.EXCLUDED_SERIES if excluded is None else excluded
    return (
        metadata.dropna(subset=["series"])
        .filter(~F.col("series").isin(skipped))
        .select(
            "series",
            F.col("contents").alias("metadata"),
            label_from_tags(F.col("contents"), delimiter, labels).alias("label"),
        )
    )


def read_metadata(
    spark: SparkSession,
    path: str,
    delimiter: str = schema.TAG_DELIMITER,
    labels: dict[str, float] | None = None,
) -> DataFrame:
    return label_metadata(scan_metadata(spark, path), delimiter, labels)
