"""Evaluation as aggregates: confusion, per-class and weighted metrics, ROC and PR."""

from pyspark.sql import Column, DataFrame, functions as F

from chronolex.functions.vectors import vector_element
from chronolex.operators.running import running_sums


def margin(raw_prediction: str = "rawPrediction") -> Column:
    """Score of class 1 over class 0; ranks all three classifiers, Naive Bayes included."""
    return vector_element(F.col(raw_prediction), 1) - vector_element(F.col(raw_prediction), 0)


def confusion_matrix(
    df: DataFrame, group_cols: list[str] = (), label: str = "label", prediction: str = "prediction", n: str | None = None
) -> DataFrame:
    """Rows per (label, prediction); `n` names a column of counts for pre-aggregated input."""
    rows = F.sum(n) if n else F.count("*")
    return df.groupBy(*group_cols, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        rows.alias("n")
    )


def per_class_metrics(matrix: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 per class seen in the label or the prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    parts = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    classes = (
        matrix.select(*group_cols, F.explode(parts).alias("p"))
        .groupBy(*group_cols, F.col("p.class").alias("class"))
        .agg(*[F.sum(f"p.{c}").alias(c) for c in ("tp", "support", "predicted")])
    )
    precision = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    return classes.withColumns({"precision": precision, "recall": recall}).withColumn("f1", f1)


def classification_metrics(classes: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Accuracy, support-weighted precision, recall and F1, and macro F1 from the class table."""

    def weighted(metric: str) -> Column:
        return F.try_divide(F.sum(F.col(metric) * F.col("support")), F.sum("support"))

    return classes.groupBy(*group_cols).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weightedPrecision"),
        weighted("recall").alias("weightedRecall"),
        F.avg("f1").alias("macroF1"),
    )


def curve_counts(
    df: DataFrame,
    class_scores: dict[float, Column],
    group_cols: list[str] = (),
    label: str = "label",
    n: str | None = None,
) -> DataFrame:
    """True and false positives at every distinct score, one class against the rest.

    Rows shrink to distinct scores before the running sums. Runs actions.
    """
    weight = F.col(n) if n else F.lit(1)
    options = F.array(
        *[F.struct(F.lit(float(c)).alias("class"), s.alias("score")) for c, s in class_scores.items()]
    )
    scores = df.select(*group_cols, F.col(label).alias("_label"), weight.cast("long").alias("_n"), F.explode(options).alias("o"))
    hit = F.col("_label") == F.col("o.class")
    counts = scores.groupBy(*group_cols, F.col("o.class").alias("class"), F.col("o.score").alias("score")).agg(
        F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("pos"),
        F.sum(F.when(hit, 0).otherwise(F.col("_n"))).alias("neg"),
    )
    running = running_sums(
        counts, [*group_cols, "class"], [F.col("score").desc()], ["pos", "neg"]
    )
    return running.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def roc_points(counts: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    return counts.select(
        *group_cols,
        "class",
        "score",
        "tp",
        "fp",
        F.try_divide("tp", "total_pos").alias("tpr"),
        F.try_divide("fp", "total_neg").alias("fpr"),
    )


def pr_points(counts: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    return counts.select(
        *group_cols,
        "class",
        "score",
        "tp",
        "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "total_pos").alias("recall"),
    )


def auc_metrics(counts: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Trapezoid areas. Each row knows the point before it (its sums minus its own counts)."""
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    roc = F.try_divide(neg * (2 * tp - pos) / 2.0, F.col("total_pos") * F.col("total_neg").cast("double"))
    precision = tp / (tp + fp)
    before = (tp - pos) / F.nullif((tp - pos) + (fp - neg), F.lit(0))
    pr = F.try_divide(pos * (precision + F.coalesce(before, precision)) / 2.0, F.col("total_pos"))
    return counts.groupBy(*group_cols, "class").agg(
        F.sum(roc).alias("areaUnderROC"), F.sum(pr).alias("areaUnderPR")
    )
