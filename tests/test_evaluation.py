import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from chronolex.operators import evaluation as E
from conftest import rows_of


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(500):
        label = float(rng.random() < 0.4)
        score = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * label, 0.2))), 2)
        rows.append((label, float(score >= 0.5), score))
    return spark.createDataFrame(rows, "label double, prediction double, score double")


def test_weighted_metrics_equal_the_evaluator(scored):
    ours = E.classification_metrics(E.per_class_metrics(E.confusion_matrix(scored))).head()
    for name in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(scored)
        assert ours[name] == pytest.approx(theirs, abs=1e-12)


def test_areas_equal_the_evaluator(scored):
    score = F.col("score")
    counts = E.curve_counts(scored, {1.0: score, 0.0: -score})
    ours = {r["class"]: r for r in E.auc_metrics(counts).collect()}
    for name in ("areaUnderROC", "areaUnderPR"):
        evaluator = BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="score", metricName=name, numBins=0
        )
        assert ours[1.0][name] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    assert ours[0.0]["areaUnderROC"] == pytest.approx(ours[1.0]["areaUnderROC"], abs=1e-12)


def test_curve_ends_at_one(scored):
    counts = E.curve_counts(scored, {1.0: F.col("score")})
    last = E.roc_points(counts).orderBy("score").head()
    assert (last["tpr"], last["fpr"]) == (1.0, 1.0)
    assert E.pr_points(counts).orderBy("score").head()["recall"] == 1.0


def test_class_seen_only_in_predictions(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.0, 0.0)], "label double, prediction double")
    classes = E.per_class_metrics(E.confusion_matrix(df))
    assert rows_of(classes, "class", "support", "precision", "recall", "f1") == [
        (0.0, 2, 1.0, 0.5, pytest.approx(2 / 3)), (2.0, 0, 0.0, 0.0, 0.0),
    ]
    assert E.classification_metrics(classes).head()["macroF1"] == pytest.approx(1 / 3)


def test_one_sided_labels_have_no_rate(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.3)], "label double, prediction double, score double")
    point = E.roc_points(E.curve_counts(df, {1.0: F.col("score")})).head()
    assert point["tpr"] == 1.0 and point["fpr"] is None
