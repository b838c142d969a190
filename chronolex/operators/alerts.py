"""Threshold alerts over drift metric rows."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Per metric, the thresholds with their level and message.
THRESHOLDS = [
    ("psi_prob_republican", 0.2, "CRITICAL",
     "PSI={value:.4f} exceeds critical threshold {threshold} for year={year}, model={model}. "
     "Significant distribution shift in prob_1."),
    ("psi_prob_republican", 0.1, "WARNING",
     "PSI={value:.4f} exceeds warning threshold {threshold} for year={year}, model={model}. "
     "Moderate distribution shift detected."),
    ("kl_prob_republican", 1.0, "CRITICAL",
     "KL divergence={value:.4f} is critically high for year={year}, model={model}."),
    ("kl_prob_republican", 0.3, "WARNING",
     "KL divergence={value:.4f} is elevated for year={year}, model={model}."),
    ("label_flip_rate", 0.4, "CRITICAL",
     "Label flip rate={value:.4f} for year={year}, model={model}. "
     "Over 40 pct of paragraphs changed predicted party vs 1869."),
    ("label_flip_rate", 0.2, "WARNING",
     "Label flip rate={value:.4f} for year={year}, model={model}. "
     "20+ pct of paragraphs changed predicted party vs 1869."),
]


def threshold_table(spark: SparkSession, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    return spark.createDataFrame(
        thresholds, "metric_name string, threshold double, level string, template string"
    )


def _message() -> Column:
    # format_number rounds half-even on the exact binary value, as the placeholder asks.
    value = F.replace(F.format_number("metric_value", 4), F.lit(","), F.lit(""))
    text = F.col("template")
    for placeholder, filled in [
        ("{value:.4f}", value),
        ("{threshold}", F.col("threshold").cast("string")),
        ("{year}", F.col("year").cast("string")),
        ("{model}", F.coalesce("model_name", F.lit("unknown"))),
    ]:
        text = F.replace(text, F.lit(placeholder), filled)
    return text


def drift_alerts(metrics: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """One alert per metric row that reaches a threshold: the highest one it reaches.

    NULL, NaN and unregistered metrics give none. Thresholds become one row per metric, so each
    metric row meets at most one registry row and no window is needed.
    """
    if thresholds is None:
        # The built-in registry is a handful of fixed rows.
        registry = F.broadcast(_by_metric(threshold_table(metrics.sparkSession)))
    else:
        registry = _by_metric(thresholds)
    value = F.col("metric_value")
    reached = F.filter("steps", lambda s: value >= s["threshold"])
    return (
        metrics.filter(value.isNotNull() & ~F.isnan(value))
        .join(registry, "metric_name", "inner")
        .withColumn("step", F.get(reached, F.lit(0)))
        .filter(F.col("step").isNotNull())
        .select("*", "step.threshold", "step.level", "step.template")
        .select("level", "year", "model_name", "metric_name", "metric_value", "threshold", _message().alias("message"))
    )


def _by_metric(thresholds: DataFrame) -> DataFrame:
    """Steps of each metric, highest threshold first."""
    step = F.struct("threshold", "level", "template")
    return thresholds.groupBy("metric_name").agg(F.sort_array(F.collect_set(step), asc=False).alias("steps"))


def stamped(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("timestamp", F.current_timestamp())


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Totals by level; the alert table itself holds the details."""
    return alerts.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("level") == "CRITICAL").alias("critical"),
        F.count_if(F.col("level") == "WARNING").alias("warning"),
    )


def retrain_flags(alerts: DataFrame, rows_by_year: DataFrame, min_rows: int) -> DataFrame:
    """Per year: retrain when any CRITICAL alert fired or the year has too few rows."""
    critical = alerts.groupBy("year").agg(F.count_if(F.col("level") == "CRITICAL").alias("critical_alerts"))
    joined = rows_by_year.join(critical, "year", "left")
    count = F.coalesce("critical_alerts", F.lit(0).cast("long"))
    return joined.select(
        "year", "rows", count.alias("critical_alerts"), ((count > 0) | (F.col("rows") < min_rows)).alias("retrain")
    )
