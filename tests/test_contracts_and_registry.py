import datetime

import pytest
from pyspark.sql import functions as F, types as T

from chronolex import schema
from chronolex.operators import contracts as C, registry as R
from conftest import plan_of, rows_of

VERSIONS = "name string, version long, stage string, run_id string, accuracy double, f1 double"


def failed(report):
    return {r["check"] for r in report.filter(~F.col("passed")).collect()}


def test_unexpected_labels_skip_null(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (4.0,), (None,)], "pred_label double")
    assert [r[0] for r in C.unexpected_labels(df).collect()] == [4.0]


def test_raw_report(spark):
    date = datetime.date(1869, 1, 1)
    rows = [("s", "1", date, "short"), (None, "2", date, "long enough text")]
    df = spark.createDataFrame(rows, "series string, issue string, date date, text string")
    report = C.stage_report(df, "raw", 3)
    assert failed(report) == {"row_count", "null_series", "text_length_out_of_bounds"}
    assert not C.validate(report)
    with pytest.raises(ValueError, match="row_count"):
        C.validate(report, raise_on_error=True)
    assert "missing_columns" in failed(C.stage_report(df.drop("text"), "raw", 1))
    assert C.validate(C.stage_report(df, "raw", 2))


def test_report_scans_once(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumnsRenamed({"source": "series", "lang": "issue"})
    assert plan_of(C.stage_report(df, "raw")).count("\nReadSchema") == 1


def test_processed_report(spark):
    df = spark.createDataFrame([("s", "1", 1869, 1, "one"), ("s", "1", 1869, 2, "x" * 100_001)], "series string, issue string, year int, paragraph_id long, text string")
    assert failed(C.stage_report(df, "processed", 1)) == {"text_length_max", "short_paragraphs"}


def test_prediction_report(spark):
    df = spark.createDataFrame([("s", "1", 1869, 7.0, 1.5, -0.5)], "series string, issue string, year int, pred_label double, prob_democrat double, prob_republican double")
    assert failed(C.stage_report(df, "predictions", 1)) == {
        "unexpected_pred_label", "prob_democrat_out_of_range", "prob_republican_out_of_range",
    }


def test_training_year_needs_both_labels(spark):
    df = spark.createDataFrame([(1869, 0.0), (1869, 1.0), (1870, 0.0), (1871, None)], "year int, label double")
    assert C.validate_year(df, 1869, is_training=True)
    assert C.validate_year(df, 1870)
    for year in (1870, 1871):
        with pytest.raises(ValueError):
            C.validate_year(df, year, is_training=True)
    with pytest.raises(ValueError):
        C.validate_year(df.drop("label"), 1869, is_training=True)
    assert rows_of(C.train_label_presence(df), "year", "ok") == [(1869, True), (1870, False), (1871, False)]


def test_imbalance(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)] * 2 + [(None,)], "label double")
    row = C.label_imbalance(df).head()
    assert row["ratio"] == 4.5 and row["imbalanced"]
    assert [r["label"] for r in C.label_distribution(df).collect()] == [None, 0.0, 1.0]


def test_schema_conformance(spark):
    declared = T.StructType([T.StructField("a", T.StringType(), False), T.StructField("b", T.LongType()), T.StructField("c", T.LongType())])
    df = spark.createDataFrame([(None, 1)], "a string, b int")
    rows = {r["column"]: r for r in C.schema_conformance(df, declared, "x").collect()}
    assert not rows["a"]["passed"] and rows["a"]["null_rows"] == 1
    assert not rows["b"]["passed"] and rows["b"]["actual_type"] == "int"
    assert not rows["c"]["passed"] and rows["c"]["actual_type"] is None
    good = df.fillna("x", ["a"]).withColumns({"b": F.col("b").cast("long"), "c": F.lit(1).cast("long")})
    assert all(r["passed"] for r in C.schema_conformance(good, declared, "x").collect())


def versions(spark, rows):
    return spark.createDataFrame(rows, VERSIONS)


def test_promotion(spark):
    table = versions(spark, [
        ("m", 1, "Production", "a", 0.8, 0.80), ("m", 2, "Staging", "b", 0.9, 0.85), ("m", 3, "Staging", "c", 0.9, 0.82),
        ("n", 1, "Production", "d", 0.8, 0.80), ("n", 2, "Archived", "e", 0.8, 0.80),
    ])
    stages = {(r["name"], r["version"]): r["stage"] for r in R.promote(table).collect()}
    assert stages == {("m", 1): "Archived", ("m", 2): "Staging", ("m", 3): "Production", ("n", 1): "Production", ("n", 2): "Archived"}
    assert R.production_version(table, "m") == "1"
    assert R.production_version(table, "other") == "unknown"


def test_gate(spark):
    first = versions(spark, [("m", 1, "Staging", "a", 0.69, 0.9), ("m", 2, "Staging", "b", 0.7, 0.6)])
    assert [r["version"] for r in R.select_best(first).collect()] == [2]
    current = versions(spark, [("m", 1, "Production", "a", 0.9, 0.80), ("m", 2, "Staging", "b", 0.9, 0.805)])
    assert R.select_best(current).count() == 0
    better = current.union(versions(spark, [("m", 3, "Staging", "c", 0.9, 0.82)]))
    assert [r["version"] for r in R.select_best(better).collect()] == [3]


def test_declared_schemas_name_the_keys():
    assert [f.name for f in schema.PROCESSED_SCHEMA][:4] == ["series", "issue", "year", "paragraph_id"]
