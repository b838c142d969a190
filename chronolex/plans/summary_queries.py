"""Dashboard summaries and prediction tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronolex.operators import contracts as C, drift as D, summaries as S
from chronolex.plans import bindings as B
from chronolex.plans.catalog import ORACLES, query, rounded, with_ctes
from chronolex.plans.drift_queries import REF, REPORT_CTES
from chronolex.sources import published, scratch, tables

PRED_COLUMNS = "series, issue, paragraph_id, year, pred_label, prob_democrat, prob_republican, model_name, model_version"

SUMMARY = """SELECT year, model_name, round(p, 4) AS partisan_fraction, n AS total_paragraphs,
    round(greatest(0.0, (p + z2 / (2 * n)) / (1 + z2 / n) - s), 4) AS ci_lower,
    round(least(1.0, (p + z2 / (2 * n)) / (1 + z2 / n) + s), 4) AS ci_upper
  FROM (SELECT *, 1.96::DOUBLE * sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n) AS s
    FROM (SELECT year, model_name, count(*) AS n, count_if(pred_label = 1) / count(*) AS p,
        1.96::DOUBLE * 1.96::DOUBLE AS z2 FROM preds GROUP BY ALL))"""


@query("year_summary", with_ctes(B.PREDS, select=SUMMARY))
def year_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.year_summary(B.predictions(spark, sf_dir))


@query(
    "filter_models_years",
    with_ctes(
        B.PREDS,
        select=f"""SELECT {PRED_COLUMNS} FROM preds
          WHERE model_name IN ('logistic_regression', 'linear_svc') AND year BETWEEN 1996 AND 1998""",
    ),
)
def filter_models_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.filter_models_years(
        B.predictions(spark, sf_dir), ["logistic_regression", "linear_svc"], 1996, 1998
    )


@query(
    "model_metrics_pivot",
    with_ctes(
        *REPORT_CTES,
        select="""SELECT model_name,
            round(avg(metric_value) FILTER (metric_name = 'psi_prob_republican'), 4) AS psi_prob_republican,
            round(avg(metric_value) FILTER (metric_name = 'kl_prob_republican'), 4) AS kl_prob_republican,
            round(avg(metric_value) FILTER (metric_name = 'mean_confidence'), 4) AS mean_confidence
          FROM report GROUP BY model_name""",
    ),
)
def model_metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = D.drift_report(B.predictions(spark, sf_dir), REF)
    return S.model_metrics_pivot(report, ["psi_prob_republican", "kl_prob_republican", "mean_confidence"])


@query(
    "confidence_heatmap",
    with_ctes(
        B.PREDS,
        """b AS (SELECT year, CASE WHEN p < 0 OR p > 1 THEN NULL
            WHEN p <= 0.1::DOUBLE THEN 0 WHEN p <= 0.2::DOUBLE THEN 1 WHEN p <= 30000000000000004e-17 THEN 2
            WHEN p <= 0.4::DOUBLE THEN 3 WHEN p <= 0.5::DOUBLE THEN 4 WHEN p <= 6000000000000001e-16 THEN 5
            WHEN p <= 7000000000000001e-16 THEN 6 WHEN p <= 0.8::DOUBLE THEN 7 WHEN p <= 0.9::DOUBLE THEN 8 ELSE 9 END AS bin
          FROM (SELECT year, prob_republican AS p FROM preds WHERE prob_republican IS NOT NULL)),
        c AS (SELECT y.year, g.i, count(b.bin) AS n FROM (SELECT DISTINCT year FROM b) y CROSS JOIN range(10) AS g(i)
          LEFT JOIN b ON b.year = y.year AND b.bin = g.i GROUP BY ALL)""",
        select="""SELECT year, '0.' || CAST(i AS VARCHAR) AS bin,
            round(coalesce(n / nullif(sum(n) OVER (PARTITION BY year), 0), 0), 6) AS density FROM c""",
    ),
)
def confidence_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.confidence_heatmap(B.predictions(spark, sf_dir)), "density")


@query(
    "prob_histogram",
    with_ctes(
        B.PREDS,
        select="""SELECT model_name, year, CAST(least(floor(prob_republican * 30), 29) AS INTEGER) AS bin, count(*) AS count
          FROM preds WHERE prob_republican BETWEEN 0 AND 1 GROUP BY ALL""",
    ),
)
def prob_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prob_histogram(B.predictions(spark, sf_dir))


@query(
    "prob_ecdf",
    with_ctes(
        B.PREDS,
        select="""SELECT DISTINCT year, prob_republican AS p,
            round(cume_dist() OVER (PARTITION BY year ORDER BY prob_republican), 6) AS ecdf
          FROM preds WHERE prob_republican IS NOT NULL""",
    ),
)
def prob_ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.prob_ecdf(B.predictions(spark, sf_dir)), "ecdf")


HEAD_ORDER = ["year", "series", "issue", "paragraph_id", "model_name", "prob_republican"]


@query(
    "raw_predictions_head",
    with_ctes(B.PREDS, select=f"SELECT {PRED_COLUMNS} FROM preds ORDER BY {', '.join(HEAD_ORDER)} LIMIT 500"),
)
def raw_predictions_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.raw_head(B.predictions(spark, sf_dir), HEAD_ORDER)


@query(
    "unexpected_pred_labels",
    """SELECT floor(l_quantity / 10)::DOUBLE AS pred_label, count(*) AS rows FROM lineitem
       WHERE floor(l_quantity / 10) NOT IN (0, 1, 2, 3) GROUP BY ALL""",
)
def unexpected_pred_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = B.table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_quantity") / 10).cast("double").alias("pred_label")
    )
    return C.unexpected_labels(labelled).groupBy("pred_label").agg(F.count("*").alias("rows"))


@query("read_year_partition", with_ctes(B.PREDS, select=f"SELECT {PRED_COLUMNS} FROM preds WHERE year = 1996"))
def read_year_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "predictions")
    tables.write_year(B.predictions(spark, sf_dir), path, ts_col=None)
    return tables.read_year(spark, path, 1996)


@query(
    "load_predictions_all_years",
    with_ctes(
        B.PREDS,
        select=f"""SELECT {PRED_COLUMNS.replace('prob_democrat', 'CASE WHEN paragraph_id = 7 THEN NULL ELSE prob_democrat END AS prob_democrat')}
          FROM preds""",
    ),
)
def load_predictions_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-year exports without a year column, with text probabilities, some of them not numbers."""
    base = scratch.fresh_path(spark, "exports")
    text = F.when(F.col("paragraph_id") == 7, "n/a").otherwise(F.col("prob_democrat").cast("string"))
    tables.write_year(
        B.predictions(spark, sf_dir).withColumns(
            {"prob_democrat": text, "pred_label": F.col("pred_label").cast("string")}
        ),
        base,
        ts_col=None,
    )
    return tables.load_prediction_exports(spark, tables.year_folders(spark, base))


@query("write_predictions_roundtrip", with_ctes(B.PREDS, select=f"SELECT {PRED_COLUMNS} FROM preds"))
def write_predictions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "predictions")
    tables.write_year(B.predictions(spark, sf_dir), path, ts_col="prediction_ts")
    return tables.load_predictions(spark, path).drop("prediction_ts")


ARTICLE_ROWS = "SELECT series, issue, article_id, CAST(year(date) AS INTEGER) AS year FROM articles"


def _article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.articles(spark, sf_dir).select(
        "series", "issue", "article_id", F.year("date").alias("year")
    )


@query("write_partition_roundtrip", with_ctes(B.ARTICLES, select=ARTICLE_ROWS))
def write_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all years, then one year again: the table stays the same."""
    path = scratch.fresh_path(spark, "processed")
    rows = _article_rows(spark, sf_dir)
    tables.write_year(rows, path)
    tables.write_year(rows.filter(F.col("year") == 1870).drop("year"), path, year=1870)
    return spark.read.parquet(path).drop("ingestion_ts")


@query("append_partition_roundtrip", with_ctes(B.ARTICLES, select=ARTICLE_ROWS))
def append_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "appended")
    rows = _article_rows(spark, sf_dir)
    tables.append_rows(rows.filter(F.col("year") <= 1871), path, ["year"])
    tables.append_rows(rows.filter(F.col("year") > 1871), path, ["year"])
    return spark.read.parquet(path)


@query(
    "refresh_views",
    with_ctes(
        B.PREDS,
        select=f"""SELECT 'year_summary' AS view, count(*) AS rows FROM ({SUMMARY})
          UNION ALL SELECT 'confidence_heatmap', count(DISTINCT year) * 10 FROM preds
          UNION ALL SELECT 'prob_histogram', count(DISTINCT (model_name, year, least(floor(prob_republican * 30), 29)))
            FROM preds WHERE prob_republican BETWEEN 0 AND 1
          UNION ALL SELECT 'prob_ecdf', count(DISTINCT (year, prob_republican)) FROM preds
          UNION ALL SELECT 'drift_over_time', count(DISTINCT (model_name, year)) FROM preds WHERE year <> {REF}""",
    ),
)
def refresh_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every summary as a table below one folder and report their sizes."""
    counts = [
        view.agg(F.lit(name).alias("view"), F.count("*").alias("rows"))
        for name, view in _refreshed(spark, sf_dir).items()
    ]
    return C.union_reports(counts)


def _refreshed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The views as a dashboard reads them after a refresh."""
    predictions = B.predictions(spark, sf_dir)
    base = scratch.fresh_path(spark, "views")
    S.refresh_views(predictions, D.data_drift(predictions, REF), base)
    return {name: spark.read.parquet(path) for name, path in published.current_set(spark, base).items()}


HEAT_SQL = ORACLES["confidence_heatmap"]()
ECDF_SQL = ORACLES["prob_ecdf"]()
HISTOGRAM_SQL = ORACLES["prob_histogram"]()


@query(
    "published_views",
    with_ctes(
        B.PREDS,
        select=f"""SELECT 'year_summary' AS view, model_name, year, 'partisan_fraction' AS item, partisan_fraction AS value FROM ({SUMMARY})
          UNION ALL SELECT 'year_summary', model_name, year, 'ci_upper', ci_upper FROM ({SUMMARY})
          UNION ALL SELECT 'confidence_heatmap', NULL, year, bin, density FROM ({HEAT_SQL})
          UNION ALL SELECT 'prob_histogram', model_name, year, CAST(bin AS VARCHAR), count::DOUBLE FROM ({HISTOGRAM_SQL})
          UNION ALL SELECT 'prob_ecdf', NULL, year, CAST(CAST(round(p * 1000000) AS BIGINT) AS VARCHAR), ecdf FROM ({ECDF_SQL})""",
    ),
)
def published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the published views of the predictions hold, one row per value."""
    views = _refreshed(spark, sf_dir)
    none = F.lit(None).cast("string")

    def tall(view: str, item: Column, value: Column, model: Column = F.col("model_name")) -> DataFrame:
        return views[view].select(
            F.lit(view).alias("view"), model.alias("model_name"), "year", item.alias("item"), value.cast("double").alias("value")
        )

    return C.union_reports([
        tall("year_summary", F.lit("partisan_fraction"), F.col("partisan_fraction")),
        tall("year_summary", F.lit("ci_upper"), F.col("ci_upper")),
        tall("confidence_heatmap", F.col("bin"), F.round("density", 6), none),
        tall("prob_histogram", F.col("bin").cast("string"), F.col("count")),
        tall("prob_ecdf", F.round(F.col("p") * 1_000_000).cast("long").cast("string"), F.round("ecdf", 6), none),
    ])


@query(
    "prob_sketch_ecdf",
    with_ctes(
        B.PREDS,
        select="""SELECT p.year, g.i / 20.0::DOUBLE AS p, count(*) AS n,
            round(count_if(prob_republican <= g.i / 20.0::DOUBLE) / count(*), 6) AS exact_ecdf, true AS within_bound
          FROM preds p CROSS JOIN range(21) AS g(i) WHERE prob_republican IS NOT NULL GROUP BY ALL""",
    ),
)
def prob_sketch_ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares from sketches per model and year merged to years, held against exact ones.

    The bound allows three times the error that one of a hundred ranks exceeds.
    """
    predictions = B.predictions(spark, sf_dir)
    fine = scratch.materialize(S.prob_sketches(predictions, ["year", "model_name"]), "sketches")
    approximate = S.sketch_ecdf(S.merge_sketches(fine, ["year"]), ["year"], steps=20)
    at_or_below = [F.count_if(F.col("prob_republican") <= i / 20.0) / F.count("*") for i in range(21)]
    exact = predictions.filter(F.col("prob_republican").isNotNull()).groupBy("year").agg(
        F.count("*").alias("n"), F.array(*at_or_below).alias("shares")
    )
    step = F.round(F.col("p") * 20).cast("int")
    return approximate.join(exact, "year").select(
        "year", "p", "n", F.round(F.col("shares")[step], 6).alias("exact_ecdf"),
        (F.abs(F.col("ecdf") - F.col("shares")[step]) <= 3 * S.rank_error()).alias("within_bound"),
    )
