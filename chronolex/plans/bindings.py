"""The test tables seen as articles, metadata, predictions, scores and model versions.

Each binding exists twice: as a DataFrame and as the SQL text of a common table expression.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SEPARATOR = "\n"
MIN_WORDS = 5
PRED_REF_YEAR = 1995


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _article_date() -> Column:
    doc = F.col("doc_id")
    return F.make_date(
        F.expr("CAST(1869 + (doc_id DIV 20) % 6 AS INT)"), (1 + doc % 12).cast("int"), (1 + doc % 28).cast("int")
    )


def _article_columns() -> list[Column]:
    return [
        F.col("source").alias("series"),
        F.expr("CAST(doc_id DIV 240 AS STRING)").alias("issue"),
        _article_date().alias("date"),
        F.col("text"),
        F.col("doc_id").alias("article_id"),
    ]


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(*_article_columns())


def english_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with their year and a learnable label: 1 marks English."""
    return documents(spark, sf_dir).select(
        *_article_columns(),
        F.year(_article_date()).alias("year"),
        F.when(F.col("lang") == "en", 1.0).otherwise(0.0).alias("label"),
    )


ARTICLES = """articles AS (
  SELECT source AS series, CAST(doc_id // 240 AS VARCHAR) AS issue,
    make_date(1869 + (doc_id // 20) % 6, 1 + doc_id % 12, 1 + doc_id % 28) AS date, text, doc_id AS article_id
  FROM documents)"""


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("CAST(substr(source, 4) AS INT) % 4")
    contents = (
        F.when(F.col("source") == "src0", "republican; democratic")
        .when(number == 0, "democratic; weekly")
        .when(number == 1, "republican; daily")
        .when(number == 2, "independent")
    )
    known = table(spark, sf_dir, "documents").select("source").distinct().select(
        F.col("source").alias("series"), contents.alias("contents")
    )
    unusable = spark.createDataFrame(
        [("xref", "democratic"), ("(no report.)", "republican"), (None, "democratic")],
        "series string, contents string",
    )
    return known.unionByName(unusable)


METADATA = """metadata AS (
  SELECT DISTINCT source AS series, CASE WHEN source = 'src0' THEN 'republican; democratic'
    WHEN CAST(substr(source, 4) AS INT) % 4 = 0 THEN 'democratic; weekly'
    WHEN CAST(substr(source, 4) AS INT) % 4 = 1 THEN 'republican; daily'
    WHEN CAST(substr(source, 4) AS INT) % 4 = 2 THEN 'independent' ELSE NULL END AS contents
  FROM documents
  UNION ALL SELECT 'xref', 'democratic' UNION ALL SELECT '(no report.)', 'republican'
  UNION ALL SELECT NULL, 'democratic')"""

LABELLED_METADATA = (
    METADATA
    + """, series_labels AS (
  SELECT series, contents AS metadata, CASE
    WHEN list_contains(string_split(contents, '; '), 'democratic') THEN 0.0::DOUBLE
    WHEN list_contains(string_split(contents, '; '), 'republican') THEN 1.0::DOUBLE
    WHEN list_contains(string_split(contents, '; '), 'independent') THEN 2.0::DOUBLE
    ELSE 3.0::DOUBLE END AS label
  FROM metadata WHERE series IS NOT NULL AND series NOT IN ('xref', '(no report.)'))"""
)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_quantity") / 50
    year = F.col("year")
    drifted = F.when(year <= 1996, p).when(year <= 1998, p * p).otherwise(p * p * p)
    flag = F.col("l_returnflag")
    model = (
        F.when(flag == "A", "logistic_regression").when(flag == "N", "naive_bayes").otherwise("linear_svc")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("year", F.year("l_shipdate"))
        .withColumn("prob_republican", drifted)
        .select(
            F.col("l_suppkey").cast("string").alias("series"),
            F.col("l_orderkey").cast("string").alias("issue"),
            F.col("l_linenumber").cast("long").alias("paragraph_id"),
            "year",
            F.when(F.col("prob_republican") >= 0.5, 1.0).otherwise(0.0).alias("pred_label"),
            (1 - F.col("prob_republican")).alias("prob_democrat"),
            "prob_republican",
            model.alias("model_name"),
            F.lit("1").alias("model_version"),
        )
    )


PREDS = """preds AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series, CAST(l_orderkey AS VARCHAR) AS issue,
    CAST(l_linenumber AS BIGINT) AS paragraph_id, CAST(year AS INTEGER) AS year,
    CASE WHEN p1 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred_label,
    1 - p1 AS prob_democrat, p1 AS prob_republican, model_name, '1' AS model_version
  FROM (SELECT *, year(l_shipdate) AS year,
    CASE l_returnflag WHEN 'A' THEN 'logistic_regression' WHEN 'N' THEN 'naive_bayes' ELSE 'linear_svc' END AS model_name,
    CASE WHEN year(l_shipdate) <= 1996 THEN l_quantity/50
         WHEN year(l_shipdate) <= 1998 THEN (l_quantity/50)*(l_quantity/50)
         ELSE (l_quantity/50)*(l_quantity/50)*(l_quantity/50) END AS p1 FROM lineitem))"""


def reference_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("series"),
        F.col("doc_id").cast("string").alias("issue"),
        F.lit(1).cast("long").alias("paragraph_id"),
        F.when(F.col("n_chars") >= 1500, 1.0).otherwise(0.0).alias("pred_label"),
    )


def current_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "source").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    )
    return joined.select(
        F.col("source").alias("series"),
        F.col("doc_id").cast("string").alias("issue"),
        F.lit(1).cast("long").alias("paragraph_id"),
        F.col("quality").cast("double").alias("pred_label"),
    )


FLIP_PREDS = """ref_preds AS (
  SELECT source AS series, CAST(doc_id AS VARCHAR) AS issue, 1::BIGINT AS paragraph_id,
    CASE WHEN n_chars >= 1500 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred_label FROM documents),
cur_preds AS (
  SELECT d.source AS series, CAST(d.doc_id AS VARCHAR) AS issue, 1::BIGINT AS paragraph_id,
    CAST(l.quality AS DOUBLE) AS pred_label FROM documents d JOIN labels l USING (doc_id))"""


def eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    )
    return joined.select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        (F.col("n_chars") / F.lit(40000.0)).alias("score"),
        F.when(F.col("n_chars") >= 500, 1.0).otherwise(0.0).alias("prediction"),
    )


EVAL_SCORES = """eval_scores AS (
  SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, d.n_chars / 40000.0::DOUBLE AS score,
    CASE WHEN d.n_chars >= 500 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM documents d JOIN labels l USING (doc_id))"""


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model version rows derived from orders: a name per priority, a version per order."""
    status = F.col("o_orderstatus")
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("version"),
        F.when(status == "O", "Staging").when(status == "F", "Production").otherwise("Archived").alias("stage"),
        F.concat(F.lit("run-"), F.col("o_custkey")).alias("run_id"),
        (price / 500000.0).alias("accuracy"),
        (price / 600000.0).alias("f1"),
    )


VERSIONS = """versions AS (
  SELECT o_orderpriority AS name, o_orderkey AS version,
    CASE o_orderstatus WHEN 'O' THEN 'Staging' WHEN 'F' THEN 'Production' ELSE 'Archived' END AS stage,
    'run-' || o_custkey AS run_id, o_totalprice / 500000.0::DOUBLE AS accuracy, o_totalprice / 600000.0::DOUBLE AS f1
  FROM orders)"""
