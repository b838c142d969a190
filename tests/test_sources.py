import datetime

import pytest
from pyspark.sql import functions as F

from chronolex.operators import features as FT
from chronolex.sources import articles as A, scratch, tables
from conftest import plan_of, rows_of


@pytest.fixture
def base(spark):
    return scratch.fresh_path(spark, "test")


def test_year_filter_bounds_and_pushdown(spark, base):
    dates = ["1868-12-31", "1869-01-01", "1869-12-31", "1870-01-01"]
    rows = [("s", "1", datetime.date.fromisoformat(d), "t", "x") for d in dates]
    spark.createDataFrame(rows, "series string, issue string, date date, text string, junk string").write.parquet(base)
    df = A.read_articles(spark, base, 1869)
    assert sorted(str(r["date"]) for r in df.collect()) == dates[1:3]
    plan = plan_of(df)
    assert "GreaterThanOrEqual(date,1869-01-01), LessThan(date,1870-01-01)" in plan
    assert "junk" not in plan


def test_article_ids_are_unique_and_stable(spark, base):
    spark.range(100).select(
        F.lit("s").alias("series"), F.lit("1").alias("issue"), F.lit(datetime.date(1869, 1, 1)).alias("date"),
        F.col("id").cast("string").alias("text"),
    ).repartition(5).write.parquet(base)
    first = rows_of(A.scan_articles(spark, base, with_article_id=True), "article_id", "text")
    assert len({r[0] for r in first}) == 100
    assert first == rows_of(A.scan_articles(spark, base, with_article_id=True), "article_id", "text")


def test_metadata_csv_by_name(spark, base):
    spark.createDataFrame(
        [("democratic; weekly", "x", "s1"), (None, "x", "s2"), ("republican", "x", None), ("democratic", "x", "xref")],
        "contents string, other string, series string",
    ).write.option("header", True).csv(base)
    assert rows_of(A.read_metadata(spark, base), "series", "metadata", "label") == [
        ("s1", "democratic; weekly", 0.0), ("s2", None, 3.0),
    ]


@pytest.mark.parametrize(
    "contents,label",
    [("republican; democratic", 0.0), ("democratic;weekly", 3.0), (None, 3.0), ("daily; independent", 2.0), ("republican", 1.0)],
)
def test_labels(spark, contents, label):
    df = spark.createDataFrame([("s", contents)], "series string, contents string")
    assert A.label_metadata(df).head()["label"] == label


def years(spark, path):
    return {r["year"]: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}


def test_rewriting_a_year_leaves_the_others(spark, base):
    both = spark.createDataFrame([(1, 1869), (2, 1870), (3, 1870)], "v int, year int")
    tables.write_year(both, base)
    tables.write_year(spark.createDataFrame([(9,)], "v int"), base, year=1870)
    tables.write_year(spark.createDataFrame([(9,)], "v int"), base, year=1870)
    assert years(spark, base) == {1869: 1, 1870: 1}
    assert "ingestion_ts" in spark.read.parquet(base).columns


def test_append_adds(spark, base):
    rows = spark.createDataFrame([(1, 1869)], "v int, year int")
    tables.append_rows(rows, base, ["year"])
    tables.append_rows(rows, base, ["year"])
    assert years(spark, base) == {1869: 2}


def test_read_year_prunes_and_keeps_year(spark, base):
    tables.write_year(spark.createDataFrame([(1, 1869), (2, 1870)], "v int, year int"), base)
    df = tables.read_year(spark, base, 1870)
    assert [(r["v"], r["year"]) for r in df.collect()] == [(2, 1870)]
    assert "PartitionFilters: [isnotnull(year" in plan_of(df)


def test_exports_fill_years_and_coerce(spark, base):
    spark.createDataFrame([("1.0", "0.25")], "pred_label string, prob_democrat string").write.parquet(f"{base}/a")
    spark.createDataFrame([(0.0, 0.5, 1870)], "pred_label double, prob_republican double, year int").write.parquet(f"{base}/b")
    spark.createDataFrame([("x", "bad")], "pred_label string, prob_democrat string").write.parquet(f"{base}/c")
    df = tables.load_prediction_exports(
        spark, {1869: f"{base}/a", 1870: f"{base}/b", 1871: f"{base}/c", 1872: f"{base}/missing"}
    )
    assert rows_of(df, "year", "pred_label", "prob_democrat", "prob_republican") == [
        (1869, 1.0, 0.25, None), (1870, 0.0, None, 0.5), (1871, None, None, None),
    ]
    with pytest.raises(FileNotFoundError):
        tables.load_prediction_exports(spark, {1872: f"{base}/missing"})
    with pytest.raises(FileNotFoundError):
        tables.load_predictions(spark, f"{base}/missing")


def test_metric_filter_ignores_case_and_null(spark, base):
    rows = [(1870, "PSI_x", "0.5"), (1870, None, "1"), (1871, "kl", "bad")]
    tables.write_drift_metrics(spark.createDataFrame(rows, "year int, metric_name string, metric_value string"), base)
    assert rows_of(tables.load_drift_metrics(spark, base, "psi"), "metric_name", "metric_value") == [("PSI_x", 0.5)]
    assert rows_of(tables.load_drift_metrics(spark, base, "kl"), "metric_value") == [(None,)]


def test_pad_label(spark):
    df = FT.pad_label(spark.range(1))
    assert df.schema["label"].dataType.simpleString() == "double" and df.head()["label"] is None


class FakeSession:
    """Only what the scratch folder asks of a session."""

    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: settings.get(key.replace(".", "_"), default)})()
        self.sparkContext = type("Context", (), {"applicationId": "app-1"})()


def test_scratch_folder_comes_from_the_session():
    assert scratch.shared_folder(FakeSession(spark_checkpoint_dir="/shared")) == "/shared"
    assert scratch.shared_folder(FakeSession(chronolex_scratch_dir="/own")) == "/own"
    named = FakeSession(spark_checkpoint_dir="/shared/", chronolex_scratch_dir="/own")
    assert scratch.fresh_path(named, "x").startswith("/shared/chronolex/app-1/x-")
    with pytest.raises(ValueError):
        scratch.shared_folder(FakeSession())
