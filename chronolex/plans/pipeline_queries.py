"""From text to alerts: train on one year, score all years, measure drift against it, alert."""

from pyspark.sql import DataFrame, SparkSession

from chronolex import schema
from chronolex.operators import alerts as AL, contracts as C, drift as D, summaries as S
from chronolex.plans import drift_queries as DQ, model_queries as M
from chronolex.plans.catalog import query, rounded, with_ctes
from chronolex.plans.contract_queries import MINIMUM, check_sql
from chronolex.plans.summary_queries import SUMMARY
from chronolex.sources import scratch, tables

PREDS = """preds AS (SELECT series, issue, paragraph_id, year, pred_label, prob_democrat, prob_republican,
    'naive_bayes' AS model_name, '1' AS model_version FROM scored_rows)"""


def _against_training_year(ctes: str) -> str:
    """A drift expression of the prediction queries with the training year as reference."""
    return ctes.replace(str(DQ.REF), str(schema.REFERENCE_YEAR))


def _ctes() -> tuple[str, ...]:
    return (*M.feature_ctes(M.TRAIN_YEAR), *M.BAYES, PREDS)


def _report_ctes() -> tuple[str, ...]:
    own = (DQ.SCORES, DQ.DATA_ROWS, DQ.CLASS_ROWS, DQ.SUMMARY_ROWS, DQ.YEAR_FLIP_ROWS, DQ.REPORT)
    return (*_ctes(), *map(_against_training_year, own))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years scored with the Production model, stored and read again."""
    path = scratch.fresh_path(spark, "predictions")
    scored = M._scored(spark, M.vocabulary_features(spark, sf_dir), "naive_bayes")
    tables.write_year(scored, path, ts_col="prediction_ts")
    return tables.load_predictions(spark, path)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of the stored predictions, itself stored and read again."""
    path = scratch.fresh_path(spark, "drift")
    tables.write_drift_metrics(D.drift_report(predictions(spark, sf_dir), schema.REFERENCE_YEAR), path)
    return tables.load_drift_metrics(spark, path)


@query("pipeline_drift", lambda: with_ctes(*_report_ctes(), select=f"SELECT {DQ.TALL_ROUNDED} FROM report"))
def pipeline_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report(spark, sf_dir), "metric_value").drop("computed_ts")


@query(
    "pipeline_alerts",
    lambda: with_ctes(
        *_report_ctes(), "metrics AS (SELECT * FROM report)", DQ.ALERTS,
        select="SELECT level, year, model_name, metric_name, round(metric_value, 6) AS metric_value, threshold, message FROM alerts",
    ),
)
def pipeline_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the stored drift report, stamped, stored and read again."""
    path = scratch.fresh_path(spark, "alerts")
    AL.stamped(AL.drift_alerts(report(spark, sf_dir))).write.parquet(path)
    return rounded(spark.read.parquet(path).drop("timestamp"), "metric_value")


@query("pipeline_year_summary", lambda: with_ctes(*_ctes(), select=SUMMARY))
def pipeline_year_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.year_summary(predictions(spark, sf_dir))


PREDICTION_CHECKS = [
    ("missing_columns", "error", "0 * count(*)", None, 0),
    ("row_count", "warning", "count(*)", MINIMUM, None),
    *[(f"null_{c}", "warning", f"count(*) - count({c})", None, 0) for c in ("series", "issue", "year", "pred_label")],
    ("unexpected_pred_label", "warning", "count_if(pred_label NOT IN (0, 1, 2, 3))", None, 0),
    ("prob_democrat_out_of_range", "warning", "count_if(prob_democrat NOT BETWEEN 0 AND 1)", None, 0),
    ("prob_republican_out_of_range", "warning", "count_if(prob_republican NOT BETWEEN 0 AND 1)", None, 0),
]


@query("pipeline_contract", lambda: with_ctes(*_ctes(), select=check_sql("predictions", "preds", PREDICTION_CHECKS)))
def pipeline_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored rows against the prediction contract."""
    return C.stage_report(predictions(spark, sf_dir), "predictions", MINIMUM)
