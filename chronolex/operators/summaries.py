"""Summary tables for a dashboard."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chronolex import schema
from chronolex.functions import stats
from chronolex.operators.running import running_sums
from chronolex.sources.published import publish
from chronolex.sources.scratch import materialize


def year_summary(predictions: DataFrame) -> DataFrame:
    """Share of label 1 per model and year with its Wilson interval, sorted by model and year."""
    counts = predictions.groupBy("year", "model_name").agg(
        F.count("*").alias("total_paragraphs"), F.count_if(F.col("pred_label") == 1.0).alias("partisan")
    )
    return _shares(counts)


def _shares(counts: DataFrame) -> DataFrame:
    low, high = stats.wilson_interval(F.col("partisan"), F.col("total_paragraphs"))
    return counts.select(
        "year",
        "model_name",
        F.round(F.col("partisan") / F.col("total_paragraphs"), 4).alias("partisan_fraction"),
        "total_paragraphs",
        F.round(low, 4).alias("ci_lower"),
        F.round(high, 4).alias("ci_upper"),
    ).orderBy("model_name", "year")


def filter_models_years(df: DataFrame, models: list[str], first_year: int, last_year: int) -> DataFrame:
    return df.filter(F.col("model_name").isin(models) & F.col("year").between(first_year, last_year))


def model_metrics_pivot(metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per model, one rounded mean per metric; given names save the pass that finds them."""
    return metrics.groupBy("model_name").pivot("metric_name", names).agg(F.round(F.avg("metric_value"), 4))


def confidence_heatmap(predictions: DataFrame, prob_col: str = "prob_republican") -> DataFrame:
    """Ten right-closed bins per year as shares of the year, empty bins 0."""
    p = F.col(prob_col)
    bins = predictions.filter(p.isNotNull()).groupBy("year").agg(
        stats.bin_counts(p, right_closed=True).alias("bins")
    )
    return _densities(bins)


def _densities(bins: DataFrame) -> DataFrame:
    total = F.aggregate("bins", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = bins.select("year", total.alias("total"), F.posexplode("bins").alias("i", "count"))
    return rows.select(
        "year",
        F.concat(F.lit("0."), F.col("i").cast("string")).alias("bin"),
        F.coalesce(F.try_divide("count", "total"), F.lit(0.0)).alias("density"),
    )


def drift_over_time(metrics: DataFrame, metric: str = "psi_prob_republican") -> DataFrame:
    """One metric by model and year beside its thresholds."""
    return (
        metrics.filter(F.col("metric_name") == metric)
        .select(
            "model_name",
            "year",
            "metric_value",
            F.lit(schema.PSI_WARNING).alias("warning_threshold"),
            F.lit(schema.PSI_CRITICAL).alias("critical_threshold"),
        )
        .orderBy("model_name", "year")
    )


def prob_histogram(predictions: DataFrame, prob_col: str = "prob_republican", bins: int = 30) -> DataFrame:
    """Rows per model, year and equal-width bin of [0, 1]."""
    p = F.col(prob_col)
    return (
        predictions.filter(p.between(0.0, 1.0))
        .groupBy("model_name", "year", _equal_bin(p, bins).alias("bin"))
        .agg(F.count("*").alias("count"))
    )


def _equal_bin(p: Column, bins: int) -> Column:
    return F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")


def prob_ecdf(
    predictions: DataFrame, prob_col: str = "prob_republican"
) -> DataFrame:
    """Share of a year's rows at or below each distinct probability. Runs actions."""
    p = F.col(prob_col)
    counts = predictions.filter(p.isNotNull()).groupBy("year", p.alias("p")).agg(F.count("*").alias("n"))
    return _ecdf(counts)


def _ecdf(counts: DataFrame) -> DataFrame:
    running = running_sums(counts, ["year"], [F.col("p")], ["n"])
    return running.select("year", "p", (F.col("cum_n") / F.col("total_n")).alias("ecdf"))


def raw_head(predictions: DataFrame, order_cols: list[str], n: int = 500) -> DataFrame:
    """First rows in a total order, for display."""
    return predictions.orderBy(*order_cols).limit(n)


# Which columns each view groups by.
VIEW_KEYS = {
    "year_summary": ["year", "model_name"],
    "confidence_heatmap": ["year", "heat_bin"],
    "prob_histogram": ["year", "model_name", "hist_bin"],
    "prob_ecdf": ["year", "p"],
}


def view_counts(predictions: DataFrame, prob_col: str = "prob_republican", bins: int = 30) -> DataFrame:
    """The counts that all views of the predictions are made of, from one scan and one shuffle.

    One row per view and group: rows, those of label 1, and those with a probability. Columns that a view does
    not group by are NULL. Every grouping set combines before the shuffle.
    """
    p = F.col(prob_col)
    rows = predictions.select(
        "year",
        "model_name",
        stats.right_closed_bin(p).alias("heat_bin"),
        F.when(p.between(0.0, 1.0), _equal_bin(p, bins)).alias("hist_bin"),
        p.alias("p"),
        F.coalesce(F.col("pred_label") == 1.0, F.lit(False)).alias("is_partisan"),
        p.isNotNull().alias("is_scored"),
    )
    keys = ["year", "model_name", "heat_bin", "hist_bin", "p"]
    grouped_by = lambda column: F.grouping(column) == 0
    view = (
        F.when(grouped_by("p"), "prob_ecdf")
        .when(grouped_by("heat_bin"), "confidence_heatmap")
        .when(grouped_by("hist_bin"), "prob_histogram")
        .otherwise("year_summary")
    )
    sets = [[F.col(c) for c in columns] for columns in VIEW_KEYS.values()]
    return rows.groupingSets(sets, *[F.col(c) for c in keys]).agg(
        view.alias("view"),
        F.count("*").alias("n"),
        F.count_if("is_partisan").alias("partisan"),
        F.count_if("is_scored").alias("scored"),
    )


def views_of_counts(counts: DataFrame) -> dict[str, DataFrame]:
    """The views of the predictions from stored `view_counts`. Runs actions."""
    of = lambda view: counts.filter(F.col("view") == view)
    in_bin = lambda i: F.sum(F.when(F.col("heat_bin") == i, F.col("n")).otherwise(0))
    heat = (
        of("confidence_heatmap")
        .filter(F.col("scored") > 0)
        .groupBy("year")
        .agg(F.array(*[in_bin(i) for i in range(stats.N_BINS)]).alias("bins"))
    )
    return {
        "year_summary": _shares(of("year_summary").withColumnRenamed("n", "total_paragraphs")),
        "confidence_heatmap": _densities(heat),
        "prob_histogram": of("prob_histogram")
        .filter(F.col("hist_bin").isNotNull())
        .select("model_name", "year", F.col("hist_bin").alias("bin"), F.col("n").alias("count")),
        "prob_ecdf": _ecdf(of("prob_ecdf").filter(F.col("p").isNotNull()).select("year", "p", "n")),
    }


def refresh_views(predictions: DataFrame, metrics: DataFrame, base_path: str) -> dict[str, str]:
    """Write every summary below `base_path` and publish them together; returns name -> path. Runs actions.

    Predictions are scanned once. Readers ask `published.current_set` for the newest whole set.
    """
    counts = materialize(view_counts(predictions), "view-counts")
    return publish({**views_of_counts(counts), "drift_over_time": drift_over_time(metrics)}, base_path)


# Size of a quantile sketch; `rank_error` has what it means.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """What a rank from a sketch of size `k` differs by at most, in 99 of 100 cases. Fixed values of KLL sketches."""
    return 2.296 / k**0.9723


def prob_sketches(
    predictions: DataFrame, keys: Sequence[str] = ("year",), prob_col: str = "prob_republican", k: int = SKETCH_K
) -> DataFrame:
    """One mergeable quantile sketch of the probabilities per group: keys, n, sketch.

    A sketch has a fixed size, whatever the number of rows, and combines before the shuffle; ordered running
    sums need a range partitioning of all distinct values. NULL and NaN count in no sketch, and a group that has nothing
    else has none. Ranks are approximate (`rank_error`) and depend on the partitioning; `prob_ecdf` is exact.
    """
    p = F.col(prob_col)
    scored = predictions.filter(p.isNotNull() & ~F.isnan(p))
    return scored.groupBy(*keys).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(p, k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups from stored ones, such as all years from single years, without the rows."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_ecdf(sketches: DataFrame, keys: list[str], steps: int = 100) -> DataFrame:
    """Approximate share of rows at or below each of `steps` + 1 equal steps of [0, 1]: keys, p, ecdf."""
    points = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    ranks = F.kll_sketch_get_rank_double("sketch", points)
    return sketches.select(*keys, F.inline(F.arrays_zip(points.alias("p"), ranks.alias("ecdf"))))


def sketch_quantiles(sketches: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """Approximate quantiles: keys, share, p."""
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    values = F.kll_sketch_get_quantile_double("sketch", wanted)
    return sketches.select(*keys, F.inline(F.arrays_zip(wanted.alias("share"), values.alias("p"))))
