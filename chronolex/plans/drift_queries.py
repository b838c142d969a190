"""Drift, alerts and their round trips over predictions derived from lineitem."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex.operators import alerts as AL, drift as D
from chronolex.plans import bindings as B
from chronolex.plans.catalog import query, rounded, with_ctes
from chronolex.sources import scratch, tables

REF = B.PRED_REF_YEAR
GROUPS = "model_name, model_version"


def bin_case(column: str) -> str:
    """Left-closed bin index; the edges are the doubles 0.1 * k."""
    return f"""CASE WHEN {column} < 0 OR {column} > 1 THEN NULL
      WHEN {column} >= 0.9::DOUBLE THEN 9 WHEN {column} >= 0.8::DOUBLE THEN 8
      WHEN {column} >= 7000000000000001e-16 THEN 7 WHEN {column} >= 6000000000000001e-16 THEN 6
      WHEN {column} >= 0.5::DOUBLE THEN 5 WHEN {column} >= 0.4::DOUBLE THEN 4
      WHEN {column} >= 30000000000000004e-17 THEN 3 WHEN {column} >= 0.2::DOUBLE THEN 2
      WHEN {column} >= 0.1::DOUBLE THEN 1 ELSE 0 END"""


def histogram_ctes(column: str) -> str:
    return f"""binned AS (
  SELECT {GROUPS}, year, {bin_case(column)} AS bin FROM preds WHERE {column} IS NOT NULL),
sizes AS (SELECT {GROUPS}, year, count(*) AS n FROM binned GROUP BY ALL),
hist AS (
  SELECT s.model_name, s.model_version, s.year, s.n, CAST(g.i AS INTEGER) AS bin, count(b.bin) AS c
  FROM sizes s CROSS JOIN range(10) AS g(i) LEFT JOIN binned b
    ON b.model_name = s.model_name AND b.model_version = s.model_version AND b.year = s.year AND b.bin = g.i
  GROUP BY ALL)"""


def score_ctes(column: str) -> str:
    return (
        histogram_ctes(column)
        + f""", pairs AS (
  SELECT h.*, r.c AS rc, r.n AS rn, sum(h.c + 1e-10) OVER w AS cs, sum(r.c + 1e-10) OVER w AS rs
  FROM hist h JOIN hist r ON r.model_name = h.model_name AND r.model_version = h.model_version
    AND r.bin = h.bin AND r.year = {REF} WHERE h.year <> {REF}
  WINDOW w AS (PARTITION BY h.model_name, h.model_version, h.year)),
scores AS (
  SELECT {GROUPS}, year, {REF}::INTEGER AS ref_year,
    round(sum(((c + 1e-6) / (n + 1e-5) - (rc + 1e-6) / (rn + 1e-5))
      * ln(((c + 1e-6) / (n + 1e-5)) / ((rc + 1e-6) / (rn + 1e-5)))), 6) AS psi,
    round(sum((rc + 1e-10) / rs * ln(((rc + 1e-10) / rs) / ((c + 1e-10) / cs))), 6) AS kl
  FROM pairs GROUP BY {GROUPS}, year)"""
    )


TALL = f"year, ref_year, {GROUPS}, metric_name, metric_value"
SCORES = score_ctes("prob_republican")

DATA_ROWS = f"""data_rows AS (
  SELECT year, ref_year, {GROUPS}, 'psi_prob_republican' AS metric_name, psi AS metric_value FROM scores
  UNION ALL SELECT year, ref_year, {GROUPS}, 'kl_prob_republican', kl FROM scores)"""

CLASS_ROWS = f"""class_rows AS (
  SELECT year, {REF}::INTEGER AS ref_year, {GROUPS},
    'pred_class_' || CAST(CAST(pred_label AS BIGINT) AS VARCHAR) || '_fraction' AS metric_name,
    count(*) / sum(count(*)) OVER (PARTITION BY {GROUPS}, year) AS metric_value
  FROM preds WHERE year <> {REF} GROUP BY {GROUPS}, year, pred_label)"""

def _exact(value: str) -> str:
    """A sum of decimals, which no order of rows changes."""
    return f"sum(CAST({value} AS DECIMAL(28,18)))"


def _mean(value: str) -> str:
    return f"{_exact(value)} / count({value})"


def _variance(p: str) -> str:
    return f"greatest({_mean(f'{p} * {p}')} - ({_mean(p)}) * ({_mean(p)}), 0)"


SUMMARY_ROWS = f"""prob_wide AS (
  SELECT year, {GROUPS}, {_mean('greatest(prob_democrat, prob_republican)')} AS mean_confidence,
    {_mean('prob_democrat')} AS mean_prob_democrat, {_mean('prob_republican')} AS mean_prob_republican,
    {_variance('prob_democrat')} AS var_prob_democrat, {_variance('prob_republican')} AS var_prob_republican,
    avg(CASE WHEN prob_democrat > 0.7::DOUBLE OR prob_democrat < 1 - 0.7::DOUBLE THEN 1.0 ELSE 0.0 END) AS high_confidence_fraction_democrat,
    avg(CASE WHEN prob_republican > 0.7::DOUBLE OR prob_republican < 1 - 0.7::DOUBLE THEN 1.0 ELSE 0.0 END) AS high_confidence_fraction_republican
  FROM preds WHERE year <> {REF} GROUP BY ALL),
prob_rows AS (
  SELECT year, {REF}::INTEGER AS ref_year, {GROUPS}, metric_name, metric_value
  FROM (UNPIVOT prob_wide ON mean_confidence, mean_prob_democrat, mean_prob_republican, var_prob_democrat,
    var_prob_republican, high_confidence_fraction_democrat, high_confidence_fraction_republican
    INTO NAME metric_name VALUE metric_value))"""

YEAR_FLIP_ROWS = f"""flip_rows AS (
  SELECT c.year, {REF}::INTEGER AS ref_year, c.model_name, c.model_version, 'label_flip_rate' AS metric_name,
    avg(CASE WHEN c.pred_label <> r.pred_label THEN 1.0 ELSE 0.0 END) AS metric_value
  FROM preds c JOIN preds r ON r.series = c.series AND r.issue = c.issue AND r.paragraph_id = c.paragraph_id
    AND r.model_name = c.model_name AND r.model_version = c.model_version
  WHERE r.year = {REF} AND c.year <> {REF} GROUP BY ALL)"""

# A value halfway between two results is rounded as the decimal it stands for, not as its binary neighbour.
ROUNDED = "CAST(round(CAST(metric_value AS DECIMAL(38,15)), 6) AS DOUBLE) AS metric_value"
TALL_ROUNDED = f"year, ref_year, {GROUPS}, metric_name, {ROUNDED}"
REPORT = f"""report AS (
  SELECT {TALL} FROM data_rows UNION ALL SELECT {TALL} FROM class_rows
  UNION ALL SELECT {TALL} FROM prob_rows UNION ALL SELECT {TALL} FROM flip_rows)"""

FLIPS = """flips AS (
  SELECT count(*) AS overlap, count_if(r.pred_label <> c.pred_label)::BIGINT AS flipped
  FROM ref_preds r JOIN cur_preds c USING (series, issue, paragraph_id))"""

# Drift rows of the predictions plus the flip rate of the two prediction sets over the same paragraphs.
METRICS = f"""metrics AS (
  SELECT {TALL} FROM data_rows
  UNION ALL SELECT 1870::INTEGER, 1869::INTEGER, 'logistic_regression', '2', 'label_flip_rate', flipped / overlap FROM flips)"""


def _template(alias: str) -> str:
    text = "t.template"
    for placeholder, value in [
        ("{value:.4f}", "printf('%.4f', metric_value)"),
        ("{threshold}", "CAST(t.threshold AS VARCHAR)"),
        ("{year}", "CAST(year AS VARCHAR)"),
        ("{model}", "model_name"),
    ]:
        text = f"replace({text}, '{placeholder}', {value})"
    return f"{text} AS {alias}"


_ROWS = ", ".join(
    f"('{name}', {threshold}::DOUBLE, '{level}', '{template}')" for name, threshold, level, template in AL.THRESHOLDS
)
ALERTS = f"""thresholds(metric_name, threshold, level, template) AS (VALUES {_ROWS}),
alerts AS (
  SELECT t.level, m.year, m.model_name, m.metric_name, m.metric_value, t.threshold, {_template('message')}
  FROM metrics m JOIN thresholds t ON t.metric_name = m.metric_name AND m.metric_value >= t.threshold
  QUALIFY row_number() OVER (PARTITION BY m.year, m.model_name, m.model_version, m.metric_name ORDER BY t.threshold DESC) = 1)"""

METRIC_CTES = (B.PREDS, SCORES, DATA_ROWS, B.FLIP_PREDS, FLIPS, METRICS)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    flips = D.label_flip_rate(B.reference_predictions(spark, sf_dir), B.current_predictions(spark, sf_dir))
    flip_rows = D.metric_rows(
        flips.withColumns(
            {
                "year": F.lit(1870),
                "ref_year": F.lit(1869),
                "model_name": F.lit("logistic_regression"),
                "model_version": F.lit("2"),
            }
        ),
        {"label_flip_rate": F.col("label_flip_rate")},
    )
    return D.data_drift(B.predictions(spark, sf_dir), REF).unionByName(flip_rows)


@query(
    "prob_bin_counts",
    with_ctes(
        B.PREDS, histogram_ctes("prob_republican"),
        select=f"SELECT {GROUPS}, year, bin, c AS count FROM hist",
    ),
)
def prob_bin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.bin_rows(D.bin_histogram(B.predictions(spark, sf_dir))).withColumnRenamed("pos", "bin")


@query("drift_scores", with_ctes(B.PREDS, SCORES, select="SELECT * FROM scores"))
def drift_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drift_scores(B.predictions(spark, sf_dir), REF)


@query("drift_scores_democrat", with_ctes(B.PREDS, score_ctes("prob_democrat"), select="SELECT * FROM scores"))
def drift_scores_democrat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drift_scores(B.predictions(spark, sf_dir), REF, "prob_democrat")


@query("data_drift_rows", with_ctes(B.PREDS, SCORES, DATA_ROWS, select=f"SELECT {TALL} FROM data_rows"))
def data_drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.data_drift(B.predictions(spark, sf_dir), REF)


@query(
    "drift_severity",
    with_ctes(
        B.PREDS, SCORES,
        select="""SELECT *, CASE WHEN psi >= 0.2::DOUBLE THEN 'critical' WHEN psi >= 0.1::DOUBLE THEN 'moderate'
          ELSE 'none' END AS drift_severity FROM scores""",
    ),
)
def drift_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drift_severity(D.drift_scores(B.predictions(spark, sf_dir), REF))


@query("class_balance", with_ctes(B.PREDS, CLASS_ROWS, select=f"SELECT {TALL_ROUNDED} FROM class_rows"))
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.class_balance(B.predictions(spark, sf_dir), REF), "metric_value")


@query("prob_summary", with_ctes(B.PREDS, SUMMARY_ROWS, select=f"SELECT {TALL_ROUNDED} FROM prob_rows"))
def prob_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.probability_summary(B.predictions(spark, sf_dir), REF), "metric_value")


@query(
    "label_flip_rate",
    with_ctes(
        B.FLIP_PREDS, FLIPS,
        select="SELECT overlap, flipped, round(flipped / overlap, 6) AS label_flip_rate FROM flips WHERE overlap > 0",
    ),
)
def label_flip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    flips = D.label_flip_rate(B.reference_predictions(spark, sf_dir), B.current_predictions(spark, sf_dir))
    return rounded(flips, "label_flip_rate")


@query(
    "concept_drift_rows",
    with_ctes(
        B.PREDS, CLASS_ROWS, SUMMARY_ROWS, YEAR_FLIP_ROWS,
        f"all_rows AS (SELECT {TALL} FROM class_rows UNION ALL SELECT {TALL} FROM prob_rows UNION ALL SELECT {TALL} FROM flip_rows)",
        select=f"SELECT {TALL_ROUNDED} FROM all_rows",
    ),
)
def concept_drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.concept_drift(B.predictions(spark, sf_dir), REF), "metric_value")


REPORT_CTES = (B.PREDS, SCORES, DATA_ROWS, CLASS_ROWS, SUMMARY_ROWS, YEAR_FLIP_ROWS, REPORT)


@query("drift_report", with_ctes(*REPORT_CTES, select=f"SELECT {TALL_ROUNDED} FROM report"))
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.drift_report(B.predictions(spark, sf_dir), REF), "metric_value")


@query("drift_metrics_roundtrip", with_ctes(*REPORT_CTES, select=f"SELECT {TALL_ROUNDED} FROM report"))
def drift_metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "drift")
    tables.write_drift_metrics(D.drift_report(B.predictions(spark, sf_dir), REF), path)
    return rounded(tables.load_drift_metrics(spark, path), "metric_value").drop("computed_ts")


@query(
    "load_drift_metrics_filtered",
    with_ctes(*REPORT_CTES, select=f"SELECT {TALL_ROUNDED} FROM report WHERE regexp_matches(metric_name, '(?i)PROB_rep')"),
)
def load_drift_metrics_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "drift")
    report = D.drift_report(B.predictions(spark, sf_dir), REF)
    tables.write_drift_metrics(report.withColumn("metric_value", F.col("metric_value").cast("string")), path)
    loaded = tables.load_drift_metrics(spark, path, metric_filter="PROB_rep")
    return rounded(loaded, "metric_value").drop("computed_ts")


@query(
    "drift_over_time",
    with_ctes(
        B.PREDS, SCORES, DATA_ROWS,
        select="""SELECT model_name, year, metric_value, 0.1::DOUBLE AS warning_threshold, 0.2::DOUBLE AS critical_threshold
          FROM data_rows WHERE metric_name = 'psi_prob_republican'""",
    ),
)
def drift_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.operators.summaries import drift_over_time as series

    return series(D.data_drift(B.predictions(spark, sf_dir), REF))


@query(
    "drift_alerts",
    with_ctes(
        *METRIC_CTES, ALERTS,
        select="SELECT level, year, model_name, metric_name, round(metric_value, 6) AS metric_value, threshold, message FROM alerts",
    ),
)
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(AL.drift_alerts(metrics(spark, sf_dir)), "metric_value")


@query(
    "alert_summary",
    with_ctes(
        *METRIC_CTES, ALERTS,
        select="""SELECT count(*) AS total, count_if(level = 'CRITICAL')::BIGINT AS critical,
          count_if(level = 'WARNING')::BIGINT AS warning FROM alerts""",
    ),
)
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AL.alert_summary(AL.drift_alerts(metrics(spark, sf_dir)))


@query(
    "retrain_flags",
    with_ctes(
        *METRIC_CTES, ALERTS,
        select="""SELECT p.year, p.rows, coalesce(a.n, 0)::BIGINT AS critical_alerts,
            (coalesce(a.n, 0) > 0 OR p.rows < 100) AS retrain
          FROM (SELECT year, count(*) AS rows FROM preds GROUP BY year) p
          LEFT JOIN (SELECT year, count_if(level = 'CRITICAL') AS n FROM alerts GROUP BY year) a USING (year)""",
    ),
)
def retrain_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.predictions(spark, sf_dir).groupBy("year").agg(F.count("*").alias("rows"))
    return AL.retrain_flags(AL.drift_alerts(metrics(spark, sf_dir)), rows, min_rows=100)
