"""Data contracts over the bound tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex import schema
from chronolex.operators import contracts as C, drift as D, paragraphs as P
from chronolex.plans import bindings as B, model_queries as M, text_queries as TQ
from chronolex.plans.catalog import query, rounded, with_ctes
from chronolex.plans.drift_queries import DATA_ROWS, REF, SCORES

MINIMUM = 100

# Predictions with gaps: unlabelled documents have no label, long ones leave the probability range.
SPARSE = """sparse AS (
  SELECT d.source AS series, CAST(d.doc_id AS VARCHAR) AS issue, CAST(1869 + d.doc_id % 6 AS INTEGER) AS year,
    CAST(l.quality AS DOUBLE) AS pred_label, CAST(l.quality AS DOUBLE) AS label,
    1 - d.n_chars / 10000.0::DOUBLE AS prob_democrat, d.n_chars / 10000.0::DOUBLE AS prob_republican
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = B.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    labels = B.table(spark, sf_dir, "labels").select("doc_id", "quality")
    p = F.col("n_chars") / F.lit(10000.0)
    return documents.join(labels, "doc_id", "left").select(
        F.col("source").alias("series"),
        F.col("doc_id").cast("string").alias("issue"),
        (1869 + F.col("doc_id") % 6).cast("int").alias("year"),
        F.col("quality").cast("double").alias("pred_label"),
        F.col("quality").cast("double").alias("label"),
        (1 - p).alias("prob_democrat"),
        p.alias("prob_republican"),
    )


def check_sql(stage: str, source: str, checks: list[tuple]) -> str:
    """Report rows of (name, level, aggregate, low, high), one SELECT per check."""

    def bound(value) -> str:
        return "NULL::DOUBLE" if value is None else f"{value}::DOUBLE"

    selects = [
        f"""SELECT '{stage}' AS stage, '{name}' AS check, '{level}' AS level, round(CAST({aggregate} AS DOUBLE), 6) AS observed,
          {bound(low)} AS low, {bound(high)} AS high FROM {source}"""
        for name, level, aggregate, low, high in checks
    ]
    return f"""SELECT stage, "check", level, observed, low, high,
      coalesce(observed >= low, true) AND coalesce(observed <= high, true) AS passed FROM ({' UNION ALL '.join(selects)})"""


def _nulls(columns: list[str]) -> list[tuple]:
    return [(f"null_{c}", "warning", f"count(*) - count({c})", None, 0) for c in columns]


RAW = check_sql(
    "raw",
    "articles",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        ("row_count", "error", "count(*)", MINIMUM, None),
        *_nulls(["series", "issue", "date"]),
        ("text_length_out_of_bounds", "warning", "count_if(length(text) NOT BETWEEN 10 AND 500000)", None, 0),
    ],
)
METADATA = check_sql(
    "metadata",
    "metadata",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        ("row_count", "error", "count(*)", 1, None),
        *_nulls(["series"]),
        *[
            (f"label_{t}", "warning", f"count_if(list_contains(string_split(contents, '; '), '{t}'))", 1, None)
            for t in ("democratic", "republican", "independent")
        ],
    ],
)
PROCESSED = check_sql(
    "processed",
    "numbered",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        ("row_count", "error", "count(*)", MINIMUM, None),
        *_nulls(["series", "issue", "year"]),
        ("text_length_min", "info", "min(length(text))", None, None),
        ("text_length_max", "warning", "max(length(text))", None, 100000),
        ("text_length_avg", "info", "avg(length(text))", None, None),
        ("short_paragraphs", "warning", "count_if(len(regexp_split_to_array(text, '\\s+')) < 2)", None, 0),
    ],
)
PREDICTIONS = check_sql(
    "predictions",
    "sparse",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        ("row_count", "warning", "count(*)", MINIMUM, None),
        *_nulls(["series", "issue", "year", "pred_label"]),
        ("unexpected_pred_label", "warning", "count_if(pred_label NOT IN (0, 1, 2, 3))", None, 0),
        ("prob_democrat_out_of_range", "warning", "count_if(prob_democrat NOT BETWEEN 0 AND 1)", None, 0),
        ("prob_republican_out_of_range", "warning", "count_if(prob_republican NOT BETWEEN 0 AND 1)", None, 0),
    ],
)
FEATURES = check_sql(
    "features",
    "sums",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        ("row_count", "warning", "count(*)", MINIMUM, None),
        *_nulls(["series", "issue", "year", "paragraph_id"]),
        ("null_features", "warning", "count(*) - count(weight)", None, 0),
        ("empty_vectors", "warning", "count_if(nonzero < 1)", None, 0),
    ],
)
DRIFT = check_sql(
    "drift_metrics",
    "data_rows",
    [
        ("missing_columns", "error", "0 * count(*)", None, 0),
        *_nulls(["year", "ref_year", "model_name", "metric_name", "metric_value"]),
    ],
)
NUMBERED = (B.ARTICLES, TQ.LINES, TQ.NUMBERED)


def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stage_report(B.articles(spark, sf_dir), "raw", MINIMUM)


def processed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = P.split_into_paragraphs(P.with_year(B.articles(spark, sf_dir)), B.SEPARATOR)
    return rounded(C.stage_report(numbered, "processed", MINIMUM), "observed")


def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stage_report(sparse(spark, sf_dir), "predictions", MINIMUM)


@query("contract_raw", with_ctes(B.ARTICLES, select=RAW))
def contract_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_report(spark, sf_dir)


@query("contract_expected_labels", with_ctes(B.METADATA, select=METADATA))
def contract_expected_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stage_report(B.metadata(spark, sf_dir), "metadata", 1)


@query("contract_processed", with_ctes(*NUMBERED, select=PROCESSED))
def contract_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_report(spark, sf_dir)


@query("contract_predictions", with_ctes(SPARSE, select=PREDICTIONS))
def contract_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_report(spark, sf_dir)


@query("contract_features", lambda: with_ctes(*M.feature_ctes(M.TRAIN_YEAR), select=FEATURES))
def contract_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = spark.read.parquet(M.vocabulary_features(spark, sf_dir))
    return C.stage_report(features, "features", MINIMUM)


@query(
    "contract_report",
    with_ctes(
        *NUMBERED, B.METADATA, SPARSE, B.PREDS, SCORES, DATA_ROWS,
        select=f"{RAW} UNION ALL {METADATA} UNION ALL {PROCESSED} UNION ALL {PREDICTIONS} UNION ALL {DRIFT}",
    ),
)
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.union_reports(
        [
            raw_report(spark, sf_dir),
            contract_expected_labels(spark, sf_dir),
            processed_report(spark, sf_dir),
            prediction_report(spark, sf_dir),
            C.stage_report(D.data_drift(B.predictions(spark, sf_dir), REF), "drift_metrics"),
        ]
    )


@query(
    "contract_nulls",
    with_ctes(SPARSE, select=f"SELECT * FROM ({PREDICTIONS}) WHERE starts_with(\"check\", 'null_')"),
)
def contract_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sparse(spark, sf_dir)
    return C.run_checks(rows, "predictions", C.null_counts(rows, C.EXPECTATIONS["predictions"]["not_null"]))


@query(
    "contract_text_bounds",
    with_ctes(
        B.ARTICLES,
        select="""SELECT series, count(*) AS rows, count_if(length(text) NOT BETWEEN 10 AND 500000)::BIGINT AS out_of_bounds
          FROM articles GROUP BY series""",
    ),
)
def contract_text_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.text_bounds(B.articles(spark, sf_dir), ["series"])


@query(
    "contract_schema",
    with_ctes(
        *NUMBERED,
        select="""SELECT 'processed' AS stage, c AS "column", t AS declared_type,
            CASE WHEN c = 'label' THEN NULL ELSE t END AS actual_type, n AS null_rows, c <> 'label' AND (n = 0 OR c = 'text') AS passed
          FROM (SELECT 'series' AS c, 'string' AS t, count(*) - count(series) AS n FROM numbered
            UNION ALL SELECT 'issue', 'string', count(*) - count(issue) FROM numbered
            UNION ALL SELECT 'year', 'int', count(*) - count(year) FROM numbered
            UNION ALL SELECT 'paragraph_id', 'bigint', count(*) - count(paragraph_id) FROM numbered
            UNION ALL SELECT 'text', 'string', count(*) - count(text) FROM numbered
            UNION ALL SELECT 'label', 'double', 0 * count(*) FROM numbered)""",
    ),
)
def contract_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs before labelling against the processed schema: `label` is absent."""
    numbered = P.split_into_paragraphs(P.with_year(B.articles(spark, sf_dir)), B.SEPARATOR)
    return C.schema_conformance(numbered, schema.PROCESSED_SCHEMA, "processed")


@query(
    "train_label_presence",
    with_ctes(
        B.ARTICLES, B.LABELLED_METADATA, TQ.INGESTED,
        select="""SELECT year, count_if(label = 0)::BIGINT AS label_0_rows, count_if(label = 1)::BIGINT AS label_1_rows,
            bool_or(label = 0) AND bool_or(label = 1) AS ok FROM ingested GROUP BY year""",
    ),
)
def train_label_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.train_label_presence(TQ.ingested(spark, sf_dir))


@query("label_distribution", with_ctes(SPARSE, select="SELECT label, count(*) AS count FROM sparse GROUP BY label"))
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.label_distribution(sparse(spark, sf_dir))


@query(
    "text_length_stats",
    with_ctes(
        B.ARTICLES,
        select="SELECT min(length(text)) AS min_len, max(length(text)) AS max_len, round(avg(length(text)), 6) AS avg_len FROM articles",
    ),
)
def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(C.text_length_stats(B.articles(spark, sf_dir)), "avg_len")


@query(
    "label_imbalance",
    with_ctes(
        B.ARTICLES, B.LABELLED_METADATA,
        select="""SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / min(n), 6) AS ratio, max(n) / min(n) > 4.0 AS imbalanced
          FROM (SELECT label, count(*) AS n FROM articles JOIN series_labels USING (series) GROUP BY label)""",
    ),
)
def label_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = P.ingest(B.articles(spark, sf_dir), TQ.stored_metadata(spark, sf_dir))
    return rounded(C.label_imbalance(labelled), "ratio")
