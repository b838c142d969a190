"""Approximate quantiles: their bound, their merge, and odd input."""

import pytest
from pyspark.sql import functions as F

from chronolex.operators import summaries as S

COLUMNS = "year int, prob_republican double"


@pytest.mark.parametrize("k", [100, S.SKETCH_K])
def test_ranks_are_within_the_stated_error(spark, k):
    n = 200_000
    rows = spark.range(n).select((F.col("id") % 4).cast("int").alias("year"), ((F.col("id") * 7919 % n + 1) / n).alias("prob_republican"))
    merged = S.merge_sketches(S.prob_sketches(rows, k=k), [], k)
    found = S.sketch_ecdf(merged, [], steps=50).collect()
    assert len(found) == 51 and merged.head()["n"] == n
    errors = [abs(r["ecdf"] - r["p"]) for r in found]
    assert max(errors) <= 3 * S.rank_error(k)
    assert sum(e > S.rank_error(k) for e in errors) <= 2
    for row in S.sketch_quantiles(merged, [], [0.01, 0.5, 0.99]).collect():
        assert row["p"] == pytest.approx(row["share"], abs=3 * S.rank_error(k))


def test_sketches_do_not_grow_with_rows(spark):
    size = lambda n: S.prob_sketches(spark.range(n).select(F.lit(1).alias("year"), (F.col("id") / n).alias("prob_republican"))).select(F.length("sketch")).head()[0]
    assert size(1_000_000) < 1.3 * size(100_000) < 60_000


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, float("nan")), (3, 0.5), (3, None), (3, 0.5), (None, 0.25)], COLUMNS)
    sketches = S.prob_sketches(rows)
    assert {r["year"]: r["n"] for r in sketches.collect()} == {3: 2, None: 1}
    ecdf = {(r["year"], r["p"]): r["ecdf"] for r in S.sketch_ecdf(sketches, ["year"], steps=4).collect()}
    assert (ecdf[3, 0.25], ecdf[3, 0.5], ecdf[None, 0.25]) == (0.0, 1.0, 1.0)
    assert S.sketch_ecdf(S.prob_sketches(rows.limit(0)), ["year"]).count() == 0
