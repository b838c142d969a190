"""The three classifiers: training, tuning, scoring."""

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolex.functions.vectors import vector_element
from chronolex.operators import evaluation as E, registry
from chronolex.operators.split import group_fraction
from chronolex.sources.scratch import materialize

# Model parameters and tuning grids.
PARAMS = {
    "logistic_regression": dict(
        family="multinomial", maxIter=100, regParam=0.01, elasticNetParam=0.0, tol=1e-6, fitIntercept=True
    ),
    "naive_bayes": dict(modelType="multinomial", smoothing=1.0),
    "linear_svc": dict(maxIter=100, regParam=0.01, tol=1e-6, fitIntercept=True),
}
GRIDS = {
    "logistic_regression": dict(regParam=[0.001, 0.01, 0.1], elasticNetParam=[0.0, 0.5, 1.0], maxIter=[50, 100]),
    "naive_bayes": dict(smoothing=[0.5, 1.0, 2.0]),
    "linear_svc": dict(regParam=[0.001, 0.01, 0.1], maxIter=[50, 100]),
}
CLASSES = {"logistic_regression": LogisticRegression, "naive_bayes": NaiveBayes, "linear_svc": LinearSVC}


def build_model(name: str, **overrides) -> Estimator:
    """An unfitted classifier on `features` and `label`."""
    return CLASSES[name](
        featuresCol="features", labelCol="label", predictionCol="prediction", **{**PARAMS[name], **overrides}
    )


def training_rows(df: DataFrame, labels: list[float] | None = None) -> DataFrame:
    """Rows with a training label; the linear SVC takes 0 and 1 only."""
    return df.filter(F.col("label").isin([0.0, 1.0] if labels is None else labels))


def has_probability(predictions: DataFrame) -> bool:
    return "probability" in predictions.columns


def score_counts(predictions: DataFrame) -> DataFrame:
    """Rows per label, prediction and margin: the one aggregate all evaluation starts from."""
    return predictions.select("label", "prediction", E.margin().alias("score")).groupBy(
        "label", "prediction", "score"
    ).agg(F.count("*").alias("n"))


def evaluate(predictions: DataFrame) -> DataFrame:
    """Tall metrics of one model on test predictions; areas only with probabilities. Runs actions."""
    counts = materialize(score_counts(predictions), "scores")
    classes = E.per_class_metrics(E.confusion_matrix(counts, n="n"))
    overall = E.classification_metrics(classes)

    def tall(df: DataFrame, names: list[str]) -> DataFrame:
        entries = [F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value")) for n in names]
        return df.select(F.explode(F.array(*entries)).alias("m")).select("m.*")

    metrics = tall(overall, ["accuracy", "f1", "weightedPrecision", "weightedRecall", "macroF1"])
    if has_probability(predictions):
        curve = E.curve_counts(counts, {1.0: F.col("score")}, n="n")
        metrics = metrics.unionByName(tall(E.auc_metrics(curve), ["areaUnderROC", "areaUnderPR"]))
    return metrics


def train_all(
    train: DataFrame,
    test: DataFrame,
    names: list[str] | None = None,
    params: dict[str, dict] | None = None,
    feature_version: str = "v1",
    data_version: str = "v1",
) -> tuple[dict[str, tuple[Model, str]], DataFrame, DataFrame]:
    """Fit every enabled model. Returns {name: (model, run id)}, metrics and the run log.

    The versions name the state of features and data in the run log. The training features are kept
    while the models iterate over them and released afterwards. Runs actions.
    """
    spark = train.sparkSession
    chosen = list(PARAMS) if names is None else names
    fitted, metrics, runs = {}, [], []
    kept = training_rows(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name in chosen:
            extra = (params or {}).get(name, {})
            model = build_model(name, **extra).fit(kept)
            run = registry.run_row(
                name, {**PARAMS[name], **extra}, feature_version=feature_version, data_version=data_version
            )
            fitted[name] = (model, run[0])
            runs.append(run)
            rows = evaluate(model.transform(training_rows(test)))
            metrics.append(
                rows.select(F.lit(run[0]).alias("run_id"), F.lit(name).alias("model_name"), "metric_name", "metric_value")
            )
    finally:
        kept.unpersist()
    return fitted, reduce(DataFrame.unionByName, metrics), registry.run_log(spark, runs)


def candidate_versions(
    metrics: DataFrame, name: str, after_version: int = 0, stage: str = registry.STAGING
) -> DataFrame:
    """The runs of one training as versions of the registered model `name`, numbered on."""
    wide = (
        metrics.groupBy("run_id", "model_name")
        .pivot("metric_name", ["accuracy", "f1"])
        .agg(F.first("metric_value"))
        .withColumn("name", F.lit(name))
    )
    # One row per trained model, so this window holds a handful of rows.
    number = F.row_number().over(Window.partitionBy("name").orderBy("f1", "run_id"))
    return wide.select(
        "name", (number + after_version).alias("version"), F.lit(stage).alias("stage"),
        "run_id", "model_name", "accuracy", "f1",
    )


def _fold(folds: int, seed: int) -> Column:
    """Fold of a row, the same for each (series, issue)."""
    # A hash of its own: the split's hash would leave the last fold short of training groups.
    return F.least(F.floor(group_fraction(f"fold-{seed}") * folds), F.lit(folds - 1)).cast("int")


def tune(
    name: str,
    train: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = 3,
    seed: int = 0,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Grid search with folds that keep each (series, issue) together. Runs actions."""
    estimator = build_model(name)
    builder = ParamGridBuilder()
    for param, values in (grid or GRIDS[name]).items():
        builder = builder.addGrid(estimator.getParam(param), values)
    fold = _fold(folds, seed)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="f1"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return search.fit(training_rows(train).withColumn("fold", fold))


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid's values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _fit_limits(name: str, point: dict, limits: list[int], rows: DataFrame) -> dict[int, tuple[Model, bool]]:
    """Models of one grid point by iteration limit, and whether each took a fit of its own.

    A fit that ended by itself within a smaller limit is the model of that limit, too.
    """
    found, last, iterations = {}, None, math.inf
    for limit in sorted(limits, reverse=True):
        own = iterations > limit
        if own:
            last = build_model(name, **point, maxIter=limit).fit(rows)
            summary = last.summary() if callable(last.summary) else last.summary
            iterations = summary.totalIterations
        found[limit] = (last, own)
    return found


def tune_linear(
    name: str,
    train: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = 3,
    seed: int = 0,
    parallelism: int = 3,
) -> DataFrame:
    """Grid search of an iterative linear model: parameters, mean F1 over folds, and fits it took.

    The same folds and figures as `tune`. Points that differ in the iteration limit only share a fit wherever
    the longer one ended within the shorter limit, which is most of them. Rows of a fold are held in memory or on local
    disk while its points are fitted, `parallelism` at a time, and released; a lost executor's part is read again.
    A fold without rows, on either side, leaves its points without a figure there. Runs actions.
    """
    chosen = grid or GRIDS[name]
    limits = chosen.get("maxIter", [PARAMS[name]["maxIter"]])
    points = grid_points({k: v for k, v in chosen.items() if k != "maxIter"})
    rows = training_rows(train).withColumn("fold", _fold(folds, seed))
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    figures = []
    for k in range(folds):
        fitting = rows.filter(F.col("fold") != k).persist(StorageLevel.MEMORY_AND_DISK)
        held = rows.filter(F.col("fold") == k).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not (fitting.head(1) and held.head(1)):
                continue

            def judged(point: dict) -> list[tuple]:
                models = _fit_limits(name, point, limits, fitting)
                f1 = {id(m): judge.evaluate(m.transform(held)) for m, own in models.values() if own}
                return [(*point.values(), limit, f1[id(m)], int(own)) for limit, (m, own) in models.items()]

            with ThreadPoolExecutor(parallelism) as pool:
                figures += [row for some in pool.map(inheritable_thread_target(train.sparkSession)(judged), points) for row in some]
        finally:
            fitting.unpersist()
            held.unpersist()
    keys = [*points[0], "maxIter"]
    schema = ", ".join(f"{c} {'int' if c == 'maxIter' else 'double'}" for c in keys) + ", f1 double, own int"
    table = train.sparkSession.createDataFrame(figures, schema)
    return table.groupBy(*keys).agg(F.avg("f1").alias("f1"), F.sum("own").alias("fits"))


def best_point(figures: DataFrame) -> dict:
    """The parameters with the highest mean F1; of equal ones the more regular, then the one with fewer iterations."""
    keys = [c for c in figures.columns if c not in ("f1", "fits")]
    order = [F.col(c) if c == "maxIter" else F.col(c).desc() for c in keys]
    best = figures.orderBy(F.round("f1", 9).desc(), *order).select(*keys).head()
    return best.asDict() if best else {}


def score(model: Model, features: DataFrame, model_name: str, model_version: str, year: int | None = None) -> DataFrame:
    """Batch predictions in the fixed output layout, lazily; NULL probabilities if the model has none."""
    scored = model.transform(features).withColumnRenamed("prediction", "pred_label")
    if year is not None:
        scored = scored.withColumn("year", F.lit(year).cast("int"))
    for i, column in enumerate(("prob_democrat", "prob_republican")):
        value = vector_element(F.col("probability"), i) if has_probability(scored) else F.lit(None).cast("double")
        scored = scored.withColumn(column, value)
    label = ["label"] if "label" in features.columns else []
    return scored.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "prediction_ts": F.current_timestamp(),
        }
    ).select(
        "series", "issue", "paragraph_id", "year", *label, "pred_label", "prob_democrat", "prob_republican",
        "model_name", "model_version", "prediction_ts",
    )
