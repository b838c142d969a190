"""Gradients of fitted linear models against numpy, and against SQL that starts from stored coefficients."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chronolex.operators import models as MD, optimality as O, registry as R
from chronolex.plans import model_queries as M
from chronolex.sources import scratch
from compare import duck

COLUMNS = "series string, issue string, year int, paragraph_id long, label double"
REG = 0.01


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(11)
    x = np.where(draw.random((150, 9)) < 0.5, 0.0, draw.normal(1, 2, (150, 9)))
    x[:, 8] = 1.0  # does not vary
    x[0, :8] = 0.0
    y = (x[:, 0] - x[:, 1] + draw.normal(0, 1.5, 150) > 0).astype(float)
    data = [("s", "1", 1869, i, float(l), Vectors.dense(v) if i % 3 == 0 else Vectors.sparse(9, {j: float(c) for j, c in enumerate(v) if c})) for i, (v, l) in enumerate(zip(x, y))]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    schema = StructType([*_parse_datatype_string(COLUMNS).fields, StructField("features", VectorUDT())])
    return scratch.materialize(spark.createDataFrame(data, schema), "rows"), x, y


def stored(spark, model):
    return scratch.materialize(O.coefficient_rows(spark, model), "coefficients")


def numpy_gradient(x, y, weights, intercepts, kind, reg=REG):
    scale, n = x.std(axis=0, ddof=1), len(x)
    m = x @ weights.T + intercepts
    if kind == "logistic_regression":
        p = np.exp(m - m.max(axis=1, keepdims=True))
        slope = p / p.sum(axis=1, keepdims=True) - (y[:, None] == np.arange(m.shape[1]))
    else:
        sign = (2 * y - 1)[:, None]
        slope = np.where(1 - sign * m > 0, -sign, 0)
    inner = slope.T @ x / n
    with np.errstate(divide="ignore"):
        return np.where(scale > 1e-7, inner / scale, np.nan) + reg * weights * scale, slope.mean(axis=0)


def table(gradients):
    return {(r["class"], r["index"]): (r["low"], r["high"]) for r in gradients.collect()}


@pytest.mark.parametrize("kind,iterations", [("logistic_regression", 3), ("logistic_regression", 100), ("linear_svc", 2)])
def test_gradient_equals_numpy(spark, rows, kind, iterations):
    df, x, y = rows
    model = MD.build_model(kind, maxIter=iterations).fit(df)
    lr = kind == "logistic_regression"
    weights = model.coefficientMatrix.toArray() if lr else model.coefficients.toArray()[None, :]
    intercepts = model.interceptVector.toArray() if lr else np.array([model.intercept])
    got = table(O.gradient(df, stored(spark, model), kind, REG))
    inner, outer = numpy_gradient(x, y, weights, intercepts, kind)
    first = 0 if lr else 1
    assert len(got) == len(weights) * 9  # eight features that vary, and the intercept
    for k in range(len(weights)):
        for j in range(8):
            low, high = got[(float(k + first), j)]
            assert low - 1e-9 <= inner[k, j] <= high + 1e-9
            assert not lr or abs(low - high) < 1e-12
        low, high = got[(float(k + first), O.INTERCEPT)]
        assert low - 1e-9 <= outer[k] <= high + 1e-9


def test_only_a_fitted_model_is_stationary(spark, rows):
    df = rows[0]
    largest = {}
    for name in ("logistic_regression", "linear_svc"):
        for iterations in (1, 100):
            model = MD.build_model(name, maxIter=iterations).fit(df)
            found = O.gradient(df, stored(spark, model), name, REG)
            largest[name, iterations] = O.largest_entry(found).head()["largest"]
        assert largest[name, 100] <= M.LARGEST_ENTRY[name] < largest[name, 1]
        fitted = stored(spark, model)
        moved = scratch.materialize(fitted.withColumn("weight", F.col("weight") + F.when(F.col("index") == 0, 1.0).otherwise(0.0)), "moved")
        assert O.largest_entry(O.gradient(df, moved, name, REG)).head()["largest"] > M.LARGEST_ENTRY[name]
        weaker = O.gradient(df, fitted, name, 10 * REG)  # not the optimum of another penalty
        assert O.largest_entry(weaker).head()["largest"] > M.LARGEST_ENTRY[name] / 2


def paths(spark, df, coefficients):
    long, coefs, rows = (scratch.fresh_path(spark, n) for n in ("long", "coefs", "rows"))
    O.long_features(df).write.parquet(long)
    coefficients.write.parquet(coefs)
    df.drop("features").write.parquet(rows)
    return {name: f"'{path}/*.parquet'" for name, path in (("long", long), ("coefs", coefs), ("docs", rows))}


SQL = """WITH m AS (
  SELECT d.paragraph_id, d.label, i.class, i.weight + coalesce(sum(c.weight * l.value), 0) AS margin
  FROM {docs} d CROSS JOIN (SELECT * FROM {coefs} WHERE index = -1) i
  LEFT JOIN {long} l ON l.paragraph_id = d.paragraph_id LEFT JOIN {coefs} c ON c.index = l.index AND c.class = i.class
  GROUP BY d.paragraph_id, d.label, i.class, i.weight)"""


def test_logistic_gradient_equals_sql_from_coefficients(spark, rows, sf):
    df = rows[0]
    coefficients = stored(spark, MD.build_model("logistic_regression", maxIter=4).fit(df))
    sql = SQL + """, p AS (SELECT *, exp(margin) / sum(exp(margin)) OVER (PARTITION BY paragraph_id) - (class = label)::INT AS slope FROM m),
    s AS (SELECT index, sqrt((sum(value * value) - sum(value) * sum(value) / n) / (n - 1)) AS scale FROM {long}, (SELECT count(*) AS n FROM {docs}) GROUP BY index, n),
    g AS (SELECT p.class, l.index, sum(slope * value) / (SELECT count(*) FROM {docs}) AS g FROM p JOIN {long} l USING (paragraph_id) GROUP BY ALL)
    SELECT g.class, g.index, g.g / scale + 0.01 * coalesce(c.weight, 0) * scale FROM g JOIN s USING (index) LEFT JOIN {coefs} c USING (class, index)
    UNION ALL SELECT class, -1, avg(slope) FROM p GROUP BY class"""
    want = {(c, i): v for c, i, v in duck(sf).execute(sql.format(**paths(spark, df, coefficients))).fetchall() if i != 8}
    got = table(O.gradient(df, coefficients, "logistic_regression", REG))
    assert set(got) == set(want) and all(got[k][0] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svc"])
def test_scores_equal_sql_from_coefficients(spark, rows, sf, kind):
    df = rows[0]
    model = MD.build_model(kind).fit(df)
    coefficients = stored(spark, model)
    pick = "arg_max(class, margin)" if kind == "logistic_regression" else "CASE WHEN max(margin) > 0 THEN 1.0 ELSE 0.0 END"
    sql = SQL + f"SELECT paragraph_id, CAST({pick} AS DOUBLE) FROM m GROUP BY paragraph_id"
    want = sorted(duck(sf).execute(sql.format(**paths(spark, df, coefficients))).fetchall())
    scored = MD.score(model, df, kind, "1")
    assert sorted(tuple(r) for r in scored.select("paragraph_id", "pred_label").collect()) == want
    again = O.recomputed_scores(df, coefficients).select("paragraph_id", "pred_label")
    assert sorted(tuple(r) for r in again.collect()) == want
    if kind == "linear_svc":
        assert scored.filter("prob_democrat IS NOT NULL OR prob_republican IS NOT NULL").count() == 0


def test_batch_scores_follow_from_the_saved_model(spark, sf):
    """The registered batch query end to end: its labels are those of the coefficients it was saved with."""
    store = M.hashed_features(spark, sf)
    train, _ = M.split_training(spark, store)
    model = MD.build_model("linear_svc", maxIter=10).fit(MD.training_rows(train))
    path = scratch.fresh_path(spark, "model")
    R.save_model(model, path)
    features = spark.read.parquet(store)
    scored = MD.score(R.load_model(spark, path), features, "linear_svc", "1").select(*O.KEY, "pred_label")
    again = O.recomputed_scores(features, stored(spark, model)).select(*O.KEY, "pred_label")
    assert scored.count() == again.count() and scored.exceptAll(again).count() == 0


def test_empty_table(spark, rows):
    df = rows[0]
    coefficients = stored(spark, MD.build_model("logistic_regression", maxIter=2).fit(df))
    none = scratch.materialize(df.limit(0), "none")
    assert O.gradient(none, coefficients, "logistic_regression", REG).count() == 0
    assert O.recomputed_scores(none, coefficients).count() == 0
