"""Grid search of the linear models: the figures of the plain search, with fewer fits."""

import random

import pytest

from chronolex.operators import features as FT, models as MD
from chronolex.sources import scratch


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(5)
    rows = []
    for i in range(180):
        label = float(rng.random() < 0.4)
        words = [rng.choice(["harvest", "senate"] if rng.random() < (0.75 if label else 0.3) else ["theatre", "opera"]) for _ in range(4)]
        rows.append((f"s{i % 12}", str(i % 36), 1869, i, " ".join(words + [f"filler{rng.randrange(6)}"]), label))
    columns = "series string, issue string, year int, paragraph_id long, cleaned_paragraph string, label double"
    processed = spark.createDataFrame(rows, columns).coalesce(1)
    return scratch.materialize(FT.apply_features(FT.fit_features(processed, num_features=256), processed), "noisy")


@pytest.mark.parametrize(
    "name, grid",
    [
        ("logistic_regression", dict(regParam=[0.01, 0.3], elasticNetParam=[0.0, 0.5], maxIter=[2, 50])),
        ("linear_svc", dict(regParam=[0.01, 1.0], maxIter=[2, 50])),
    ],
)
def test_figures_and_winner_of_the_plain_search(noisy, name, grid):
    plain = MD.tune(name, noisy, grid)
    expected = {}
    for params, f1 in zip(plain.getEstimatorParamMaps(), plain.avgMetrics):
        values = {p.name: v for p, v in params.items()}
        expected[tuple(values[k] for k in grid)] = f1
    figures = MD.tune_linear(name, noisy, grid)
    found = {tuple(r[k] for k in grid): r for r in figures.collect()}
    assert set(found) == set(expected)
    for point, row in found.items():
        assert row["f1"] == pytest.approx(expected[point], abs=1e-9)
    assert MD.best_point(figures) in [dict(zip(grid, p)) for p, f1 in expected.items() if f1 == pytest.approx(max(expected.values()), abs=1e-9)]
    # Every longest fit is its own; two iterations are too few for most points.
    assert {r["fits"] for p, r in found.items() if p[-1] == 50} == {3}


def test_points_share_a_fit_that_ended_by_itself(noisy):
    grid = dict(regParam=[0.3], elasticNetParam=[0.0], maxIter=[60, 90])
    rows = {r["maxIter"]: r for r in MD.tune_linear("logistic_regression", noisy, grid).collect()}
    assert (rows[90]["fits"], rows[60]["fits"]) == (3, 0)
    assert rows[90]["f1"] == rows[60]["f1"]


def test_empty_table_has_no_figures(noisy):
    figures = MD.tune_linear("linear_svc", noisy.limit(0))
    assert figures.count() == 0 and MD.best_point(figures) == {}
