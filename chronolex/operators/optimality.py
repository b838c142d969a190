"""Checks of fitted linear models: the gradient of their loss as a distributed aggregate.

A regularised linear model is right if no coefficient can be moved to lower its loss. Coefficients are a
table, features are in long form, and every entry of the gradient comes from one join and one sum, without
the optimizer that found the coefficients.
"""

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronolex.operators.skew import join_lookup
from chronolex.sources.scratch import materialize

KEY = ["series", "issue", "year", "paragraph_id"]
INTERCEPT = -1
# Rows this near the hinge may count as inside or outside of it.
KINK = 1e-3
COEFFICIENTS = "class double, index long, weight double"


def coefficient_rows(spark: SparkSession, model: Model) -> DataFrame:
    """(class, index, weight) of a logistic regression or linear SVC; the intercept has index -1.

    Coefficients of zero have no row. A model with one set of coefficients has them for class 1.
    """
    if hasattr(model, "coefficientMatrix"):
        weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    else:
        weights, intercepts = model.coefficients.toArray()[None, :], np.array([model.intercept])
    first = 1 if len(weights) == 1 else 0
    classes, indexes = np.nonzero(weights)
    table = pd.DataFrame(
        {
            "class": np.concatenate([classes + first, np.arange(len(weights)) + first]).astype(float),
            "index": np.concatenate([indexes, np.full(len(weights), INTERCEPT)]).astype(np.int64),
            "weight": np.concatenate([weights[classes, indexes], intercepts]),
        }
    )
    return spark.createDataFrame(table, COEFFICIENTS)


def entries(vector: Column) -> Column:
    """The stored entries of a vector as an array of (index, value), without those that are zero."""
    raw = F.unwrap_udt(vector)
    values = raw.getField("values")
    # A dense vector stores no indexes.
    indexes = F.coalesce(raw.getField("indices"), F.sequence(F.lit(0), F.size(values) - 1))
    zipped = F.zip_with(indexes, values, lambda i, x: F.struct(i.cast("long").alias("index"), x.alias("value")))
    return F.filter(zipped, lambda e: e["value"] != 0.0)


def long_features(df: DataFrame, keys: list[str] = KEY, features_col: str = "features") -> DataFrame:
    """One row per stored entry: the keys, label, index, value."""
    return df.select(*keys, "label", F.inline(entries(F.col(features_col))))


def feature_scales(long: DataFrame, n: int) -> DataFrame:
    """(index, variance) of the features over `n` rows, absent entries being zero, divisor n - 1."""
    square = F.col("value") * F.col("value")
    sums = long.groupBy("index").agg(F.sum("value").alias("s"), F.sum(square).alias("q"))
    variance = F.greatest((F.col("q") - F.col("s") * F.col("s") / n) / max(n - 1, 1), F.lit(0.0))
    return sums.select("index", variance.alias("variance"))


def margins(df: DataFrame, coefficients: DataFrame, keys: list[str] = KEY, features_col: str = "features") -> DataFrame:
    """keys, class, margin of every row and class, from the stored coefficients. Runs actions.

    `keys` identify a row. A row without features has its intercept for a margin.
    """
    weights = coefficients.filter(F.col("index") != INTERCEPT)
    intercepts = coefficients.filter(F.col("index") == INTERCEPT).select("class", F.col("weight").alias("intercept"))
    joined = join_lookup(long_features(df, keys, features_col), weights, ["index"], "inner")
    scores = joined.groupBy(*keys, "class").agg(F.sum(F.col("weight") * F.col("value")).alias("score"))
    # One intercept per class.
    everywhere = df.select(*keys).join(F.broadcast(intercepts))
    found = everywhere.join(scores, [*keys, "class"], "left")
    return found.select(*keys, "class", (F.coalesce("score", F.lit(0.0)) + F.col("intercept")).alias("margin"))


def _logistic(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Derivative of the loss by each margin: probability less indicator. One interval, low = high."""
    together = rows.groupBy(*keys, "label").agg(F.collect_list(F.struct("class", "margin")).alias("m"))
    top = F.array_max(F.transform("m", lambda m: m["margin"]))
    weight = lambda m: F.exp(m["margin"] - top)
    total = F.aggregate(F.transform("m", weight), F.lit(0.0), lambda acc, w: acc + w)
    shares = F.transform(
        "m", lambda m: F.struct(m["class"].alias("class"), (weight(m) / total - (m["class"] == F.col("label")).cast("double")).alias("low"))
    )
    return together.select(*keys, F.inline(shares)).withColumn("high", F.col("low"))


def _hinge(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Subgradient of the hinge by the margin: an interval for rows at its kink."""
    sign = 2 * F.col("label") - 1
    slack = 1 - sign * F.col("margin")
    inside, at_kink = F.when(slack > KINK, -sign).otherwise(F.lit(0.0)), F.abs(slack) <= KINK
    low = F.when(at_kink, F.least(-sign, F.lit(0.0))).otherwise(inside)
    high = F.when(at_kink, F.greatest(-sign, F.lit(0.0))).otherwise(inside)
    return rows.select(*keys, "class", low.alias("low"), high.alias("high"))


LOSSES = {"logistic_regression": _logistic, "linear_svc": _hinge}


def gradient(
    df: DataFrame,
    coefficients: DataFrame,
    loss: str,
    reg: float,
    keys: list[str] = KEY,
    features_col: str = "features",
) -> DataFrame:
    """class, index, low, high: the (sub)gradient of mean loss plus L2 penalty by each coefficient.

    Entries are by coefficients of features scaled to unit variance, which is what the penalty is on; the
    intercept (index -1) has no penalty. The loss is smooth, and low = high, for the logistic regression; rows
    at the kink of the hinge make an interval. Features that do not vary have no entry. `keys` identify a
    row of `df`, a stored table with `label`; `coefficients` is one, too. No rows, no entries. Runs actions.
    """
    n = max(df.count(), 1)
    found = margins(df, coefficients, keys, features_col)
    labelled = df.select(*keys, "label").join(found, keys)
    slopes = materialize(LOSSES[loss](labelled, keys), "slopes")
    values = df.select(*keys, entries(F.col(features_col)).alias("e"))
    pushed = values.join(slopes, keys).select("class", "low", "high", F.inline("e"))
    # With a negative value, the ends of an interval trade places.
    ends = [F.col("low") * F.col("value"), F.col("high") * F.col("value")]
    by_feature = pushed.groupBy("class", "index").agg(
        (F.sum(F.least(*ends)) / n).alias("low"), (F.sum(F.greatest(*ends)) / n).alias("high")
    )
    scales = feature_scales(long_features(df, keys, features_col), n)
    weights = coefficients.filter(F.col("index") != INTERCEPT)
    scale = F.sqrt("variance")
    penalty = F.lit(reg) * F.coalesce("weight", F.lit(0.0)) * scale
    entry = lambda end: (F.col(end) / scale + penalty).alias(end)
    inner = (
        by_feature.join(scales, "index")
        .filter(F.col("variance") > 1e-15)
        .join(weights, ["class", "index"], "left")
        .select("class", "index", entry("low"), entry("high"))
    )
    intercepts = slopes.groupBy("class").agg((F.sum("low") / n).alias("low"), (F.sum("high") / n).alias("high"))
    return inner.unionByName(intercepts.select("class", F.lit(INTERCEPT).cast("long").alias("index"), "low", "high"))


def largest_entry(gradients: DataFrame) -> DataFrame:
    """entries, largest: how far from zero the interval of the worst coefficient is."""
    distance = F.greatest(F.col("low"), -F.col("high"), F.lit(0.0))
    return gradients.agg(F.count("*").alias("entries"), F.max(distance).alias("largest"))


def recomputed_scores(df: DataFrame, coefficients: DataFrame, keys: list[str] = KEY, features_col: str = "features") -> DataFrame:
    """keys, pred_label: the class with the largest margin, or the sign of a single margin. Runs actions."""
    found = margins(df, coefficients, keys, features_col)
    single = (F.count("*") == 1) & (F.max("class") == 1.0)
    # Of equal margins the smaller class, and no positive margin means class 0.
    best = F.max_by("class", F.struct("margin", -F.col("class")))
    label = F.when(single, (F.max("margin") > 0).cast("double")).otherwise(best)
    return found.groupBy(*keys).agg(label.alias("pred_label"))
