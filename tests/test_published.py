"""The dashboard refresh: one scan, and sets of views that are published whole."""

import pytest
from pyspark.sql import functions as F

from chronolex.operators import summaries as S
from chronolex.sources import published, scratch
from conftest import plan_of, rows_of

COLUMNS = "year int, model_name string, pred_label double, prob_republican double"
ODD = [
    (1990, "a", 1.0, 0.0), (1990, "a", 0.0, 1.0), (1990, "b", None, 0.3), (1990, "b", 1.0, None), (1990, None, 1.0, 0.3),
    (1991, "a", 1.0, None), (1992, "a", 0.0, 1.5), (1993, "a", 0.0, float("nan")), (None, "a", 1.0, 0.2), (None, "a", 1.0, 0.2),
]


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame([("a", 1990, "psi_prob_republican", 0.1)], "model_name string, year int, metric_name string, metric_value double")


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd rows", "empty table"])
def test_views_of_counts_equal_the_views(spark, rows):
    predictions = spark.createDataFrame(rows, COLUMNS)
    ours = S.views_of_counts(scratch.materialize(S.view_counts(predictions), "counts"))
    for name, view in ours.items():
        expected = getattr(S, name)(predictions)
        assert sorted(view.columns) == sorted(expected.columns)
        assert repr(rows_of(view, *expected.columns)) == repr(rows_of(expected, *expected.columns)), name  # NaN, too


def test_one_scan(spark, tmp_path):
    path = str(tmp_path / "predictions")
    spark.createDataFrame(ODD, COLUMNS).write.parquet(path)
    plan = plan_of(S.view_counts(spark.read.parquet(path)))
    tree = plan[: plan.index("\n\n")]
    assert tree.count("Scan parquet") == 1
    assert tree.count("Exchange") == 1


def test_a_failed_refresh_leaves_the_former_set(spark, tmp_path, metrics):
    base = str(tmp_path / "views")
    predictions = spark.createDataFrame(ODD[:2], COLUMNS)
    with pytest.raises(FileNotFoundError):
        published.current_set(spark, base)
    first = S.refresh_views(predictions, metrics, base)
    assert published.current_set(spark, base) == first
    broken = metrics.withColumn("metric_value", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        S.refresh_views(spark.createDataFrame(ODD, COLUMNS), broken, base)
    assert published.current_set(spark, base) == first
    assert spark.read.parquet(first["year_summary"]).count() == 1
    second = S.refresh_views(spark.createDataFrame(ODD, COLUMNS), metrics, base)
    assert published.current_set(spark, base) == second != first
    assert spark.read.parquet(first["year_summary"]).count() == 1  # readers of the former set go on


def test_earlier_sets_can_be_dropped(spark, tmp_path):
    base = str(tmp_path / "views")
    for n in range(3):
        published.publish({"numbers": spark.range(n)}, base)
    assert len(published.drop_earlier_sets(spark, base, keep=1)) == 2
    assert len(published.published_sets(spark, base)) == 1
    assert spark.read.parquet(published.current_set(spark, base)["numbers"]).count() == 2
    with pytest.raises(ValueError):
        published.drop_earlier_sets(spark, base, keep=0)
