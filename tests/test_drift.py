import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from chronolex import schema
from chronolex.functions import stats
from chronolex.operators import alerts as AL, drift as D, summaries as S
from chronolex.plans import bindings as B
from conftest import plan_of, rows_of

PRED = (
    "series string, issue string, paragraph_id long, year int, pred_label double, prob_democrat double, "
    "prob_republican double, model_name string, model_version string"
)


def preds(spark, probabilities, year=1870, label=None):
    rows = [
        ("s", "1", i, year, label if label is not None else float(p is not None and p >= 0.5), None if p is None else 1 - p, p, "m", "1")
        for i, p in enumerate(probabilities)
    ]
    return spark.createDataFrame(rows, PRED)


def counts(spark, values, right_closed=False):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    return df.agg(stats.bin_counts(F.col("p"), right_closed)).head()[0]


@pytest.mark.parametrize("p,i", [(0.0, 0), (0.1, 1), (0.3, 2), (0.6, 5), (0.7, 6), (1.0, 9)])
def test_left_closed_bins(spark, p, i):
    assert counts(spark, [p]).index(1) == i


@pytest.mark.parametrize("p,i", [(0.0, 0), (0.1, 0), (0.1000001, 1), (1.0, 9)])
def test_right_closed_bins(spark, p, i):
    assert counts(spark, [p], right_closed=True).index(1) == i


def test_values_outside_fall_in_no_bin(spark):
    assert sum(counts(spark, [-0.01, 1.01, None, float("nan")])) == 0


def test_edges_are_those_of_equal_bins():
    assert stats.BIN_EDGES == list(np.linspace(0, 1, 11))


def test_scores_against_numpy(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.random(400) ** 2, np.append(rng.random(300), [1.2, -0.1])
    df = preds(spark, map(float, ref), 1869).union(preds(spark, map(float, cur), 1870)).union(preds(spark, [None], 1870))
    row = D.drift_scores(df, 1869).head()
    r, c = np.histogram(ref, stats.BIN_EDGES)[0], np.histogram(cur, stats.BIN_EDGES)[0]
    rp, cp = (r + 1e-6) / (len(ref) + 1e-5), (c + 1e-6) / (len(cur) + 1e-5)
    assert row["psi"] == pytest.approx(((cp - rp) * np.log(cp / rp)).sum(), abs=1e-6)
    rk, ck = (r + 1e-10) / (r + 1e-10).sum(), (c + 1e-10) / (c + 1e-10).sum()
    assert row["kl"] == pytest.approx((rk * np.log(rk / ck)).sum(), abs=1e-6)


def test_same_distribution_has_no_drift_and_psi_is_not_negative(spark, sf):
    df = B.predictions(spark, sf)
    scores = D.drift_scores(df, 1995, include_reference=True).collect()
    assert all((r["psi"], r["kl"]) == (0.0, 0.0) for r in scores if r["year"] == 1995)
    assert all(r["psi"] >= 0 for r in scores)


def test_empty_side_gives_no_row(spark):
    only_current = preds(spark, [0.2], 1870)
    assert D.data_drift(only_current, 1869).count() == 0
    null_reference = preds(spark, [None], 1869).union(only_current)
    assert D.data_drift(null_reference, 1869).count() == 0
    assert D.data_drift(preds(spark, [0.2], 1869), 1869).count() == 0


@pytest.mark.parametrize("p,sure", [(0.7, 0.0), (0.71, 1.0), (0.3, 1.0), (0.31, 0.0)])
def test_high_confidence(spark, p, sure):
    rows = D.probability_summary(preds(spark, [p]), 1869).collect()
    values = {r["metric_name"]: r["metric_value"] for r in rows}
    assert values["high_confidence_fraction_republican"] == sure


def test_variance_is_of_the_population_and_each_metric_occurs_once(spark):
    rows = D.probability_summary(preds(spark, [0.0, 1.0]), 1869).collect()
    values = {r["metric_name"]: r["metric_value"] for r in rows}
    assert len(rows) == len(values) == 7
    assert values["var_prob_republican"] == 0.25 and values["mean_confidence"] == 1.0
    assert D.probability_summary(preds(spark, [None]), 1869).count() == 0


def test_class_fractions_sum_to_one(spark, sf):
    sums = D.class_balance(B.predictions(spark, sf), 1995).groupBy("year", *D.MODEL).agg(F.sum("metric_value").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums.collect())


def test_flip_rate_with_repeated_keys_counts_pairs(spark):
    ref = spark.createDataFrame([("a", "1", 1, 0.0), ("a", "1", 1, 1.0), ("a", "1", 2, None), ("b", "1", 1, 1.0)], "series string, issue string, paragraph_id long, pred_label double")
    cur = spark.createDataFrame([("a", "1", 1, 1.0), ("a", "1", 1, 1.0), ("a", "1", 2, 1.0)], "series string, issue string, paragraph_id long, pred_label double")
    pairs = ref.alias("r").join(cur.alias("c"), schema.PARAGRAPH_KEY)
    row = D.label_flip_rate(ref, cur).head()
    assert row["overlap"] == pairs.count() == 5
    assert row["flipped"] == pairs.filter("r.pred_label <> c.pred_label").count() == 2
    assert D.label_flip_rate(ref.filter("series = 'b'"), cur).count() == 0


def test_yearly_flip_rate(spark):
    df = preds(spark, [0.1, 0.9], 1869).union(preds(spark, [0.9, 0.9], 1870))
    assert rows_of(D.yearly_flip_rate(df, 1869), "year", "metric_value") == [(1870, 0.5)]


def test_grouping_by_other_columns(spark, sf):
    df = B.predictions(spark, sf)
    plain = D.drift_scores(df, 1995, group_cols=[])
    assert plain.count() == df.filter("year <> 1995").select("year").distinct().count()


@pytest.mark.parametrize("value,level", [(0.2, "CRITICAL"), (0.1, "WARNING"), (0.0999, None), (None, None), (float("nan"), None)])
def test_alert_levels(spark, value, level):
    metric = spark.createDataFrame([(1870, "m", "psi_prob_republican", value)], "year int, model_name string, metric_name string, metric_value double")
    found = [r["level"] for r in AL.drift_alerts(metric).collect()]
    assert found == ([level] if level else [])


def test_unregistered_metric_and_message(spark):
    rows = [(1870, "m", "other", 9.0), (1871, "m", "label_flip_rate", 0.25)]
    metric = spark.createDataFrame(rows, "year int, model_name string, metric_name string, metric_value double")
    alert = AL.drift_alerts(metric).collect()
    assert [a["message"] for a in alert] == [
        "Label flip rate=0.2500 for year=1871, model=m. 20+ pct of paragraphs changed predicted party vs 1869."
    ]
    assert tuple(AL.alert_summary(AL.drift_alerts(metric)).head()) == (1, 0, 1)
    assert "timestamp" in AL.stamped(AL.drift_alerts(metric)).columns


def test_own_thresholds(spark):
    metric = spark.createDataFrame([(1870, "m", "x", 5.0)], "year int, model_name string, metric_name string, metric_value double")
    registry = AL.threshold_table(spark, [("x", 4.0, "WARNING", "{value:.4f} {threshold}"), ("x", 1.0, "INFO", "low")])
    assert AL.drift_alerts(metric, registry).head()["message"] == "5.0000 4.0"


def test_severity_is_single(spark):
    df = spark.createDataFrame([(0.2,), (0.1,), (0.05,)], "psi double")
    assert [r["drift_severity"] for r in D.drift_severity(df).collect()] == ["critical", "moderate", "none"]


@pytest.mark.parametrize("hits,n,low,high", [(0, 0, 0, 0), (0, 10, 0, 0.2775), (10, 10, 0.7225, 1)])
def test_wilson(spark, hits, n, low, high):
    df = spark.createDataFrame([(hits, n)], "k long, n long")
    a, b = df.select(*stats.wilson_interval(F.col("k"), F.col("n"))).head()
    assert (round(a, 4), round(b, 4)) == (low, high)


def test_ecdf_equals_window(spark, sf):
    df = B.predictions(spark, sf)
    share = F.cume_dist().over(Window.partitionBy("year").orderBy("prob_republican"))
    plain = df.select("year", F.col("prob_republican").alias("p"), share.alias("ecdf")).distinct()
    assert rows_of(S.prob_ecdf(df)) == rows_of(plain)


def test_heatmap_rows_sum_to_one(spark, sf):
    sums = S.confidence_heatmap(B.predictions(spark, sf)).groupBy("year").agg(F.sum("density").alias("s"), F.count("*").alias("n"))
    assert all(abs(r["s"] - 1) < 1e-12 and r["n"] == 10 for r in sums.collect())


def test_drift_plan_has_one_scan_and_no_python(spark, sf):
    plan = plan_of(D.data_drift(B.predictions(spark, sf), 1995))
    assert "EvalPython" not in plan
    assert plan.count("\nReadSchema") == 1
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp" in plan


def under(spark, partitions, build):
    """Exact result rows with so many shuffle partitions and input partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return sorted((tuple(r) for r in build(partitions).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("report", [D.probability_summary, D.drift_report])
def test_sums_do_not_depend_on_partitions(spark, sf, report):
    rng = np.random.default_rng(2)
    df = preds(spark, map(float, rng.random(3000)), 1869).union(preds(spark, map(float, rng.random(3000) ** 3), 1870))
    results = [under(spark, k, lambda k: report(df.repartition(k, "paragraph_id"), 1869)) for k in (1, 8, 211)]
    assert results[0] == results[1] == results[2] and results[0]


def test_a_mean_between_two_roundings_is_exact(spark):
    rows = D.probability_summary(preds(spark, [0.200476, 0.200475]), 1869).collect()
    assert {r["metric_name"]: r["metric_value"] for r in rows}["mean_prob_republican"] == 0.2004755


def test_values_that_are_not_finite_count_as_null(spark):
    odd = preds(spark, [0.25, float("nan"), float("inf"), None], 1870, label=1.0)
    values = {r["metric_name"]: r["metric_value"] for r in D.probability_summary(odd, 1869).collect()}
    assert values["mean_prob_republican"] == 0.25 and values["var_prob_democrat"] == 0.0
    report = {r["metric_name"]: r["metric_value"] for r in D.drift_report(odd, 1869).collect()}
    assert report == {**values, "pred_class_1_fraction": 1.0}


def test_report_is_the_union_of_its_parts(spark, sf):
    flips = preds(spark, [0.1, 0.9, 0.5], 1995).union(preds(spark, [0.9, 0.9, 0.2, 0.3], 1996)).union(preds(spark, [0.9, 0.1], 1997))
    repeated = flips.union(flips.filter("year = 1996")).withColumn("model_name", F.lit("other"))
    unknown = preds(spark, [0.4], 1996).withColumns({"series": F.lit(None).cast("string"), "pred_label": F.lit(None).cast("double")})
    also = preds(spark, [0.4], 1995).withColumn("series", F.lit(None).cast("string"))
    for df in (B.predictions(spark, sf), flips.union(repeated).union(unknown).union(also)):
        parts = [D.data_drift, D.class_balance, D.probability_summary, D.yearly_flip_rate]
        names = ["year", *D.MODEL, "metric_name", "metric_value"]
        want = sorted((r for part in parts for r in rows_of(part(df, 1995), *names)), key=repr)
        assert rows_of(D.drift_report(df, 1995), *names) == want
        concept = sorted((r for part in parts[1:] for r in rows_of(part(df, 1995), *names)), key=repr)
        assert rows_of(D.concept_drift(df, 1995), *names) == concept


def test_yearly_flips_equal_a_join_of_rows(spark):
    rng = np.random.default_rng(3)
    rows = [("s", "1", int(i), int(y), None if x < 0.1 else float(x < 0.5), 0.5, 0.5, "m", "1") for i, y, x in zip(rng.integers(0, 20, 400), rng.integers(1869, 1873, 400), rng.random(400))]
    df = spark.createDataFrame(rows, PRED)
    pairs = df.filter("year = 1869").alias("r").join(df.filter("year <> 1869").alias("c"), schema.PARAGRAPH_KEY)
    share = F.avg(F.coalesce((F.col("r.pred_label") != F.col("c.pred_label")).cast("double"), F.lit(0.0)))
    want = rows_of(pairs.groupBy("c.year").agg(share.alias("rate")))
    assert rows_of(D.yearly_flip_rate(df, 1869), "year", "metric_value") == want


def test_report_reads_the_predictions_once_and_joins_nothing(spark, sf):
    for report in (D.drift_report, D.concept_drift):
        plan = plan_of(report(B.predictions(spark, sf), 1995))
        assert plan.count("\nReadSchema") == 1
        assert "Join" not in plan and "EvalPython" not in plan
    assert "Join" not in plan_of(D.yearly_flip_rate(B.predictions(spark, sf), 1995))
