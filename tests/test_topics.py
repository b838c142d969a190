"""Topics: repeatable under any partitioning, defined for odd rows, and able to find what was put in."""

import pytest
from pyspark.sql import functions as F

from chronolex.operators import topics as TP
from conftest import plan_of, rows_of


@pytest.fixture(scope="module")
def words(spark):
    """Two kinds of rows, ships in 1900 and crops in 1901, with a shared word, repeated rows and rows without words."""
    ships, crops = ["ship", "harbour", "sail", "cargo"], ["wheat", "barley", "plough", "harvest"]
    rows = [(1900 + i % 2, (ships if i % 2 == 0 else crops)[i % 3 :] * 2 + ["year"]) for i in range(60)]
    rows += [(1900, []), (1901, None), (None, ["ship"] * 6), (1901, ["rare"])]
    return spark.createDataFrame(rows, "year int, filtered_words array<string>")


def test_finds_the_two_kinds_and_keeps_every_row(words):
    shares, weights = TP.fit_topics(words, ["year"], topics=2, iterations=15)
    assert shares.count() == words.count()
    assert weights.count() == 9  # `rare` is in too few rows
    for row in shares.collect():
        assert sum(row["share"]) == pytest.approx(1.0)
    means = {(r["year"], r["topic"]): r["share"] for r in TP.share_by_year(shares).collect()}
    crops = max((0, 1), key=lambda z: means[1901, z])
    assert means[1901, crops] > 0.85 and means[1900, 1 - crops] > 0.85
    assert {r["term"] for r in TP.top_terms(weights, crops, 4).collect()} <= {"wheat", "barley", "plough", "harvest", "year"}


def test_same_under_any_partitioning(words):
    results = []
    for n in (1, 7):
        shares, weights = TP.fit_topics(words.repartition(n), ["year"], topics=3, iterations=3)
        results.append((rows_of(TP.share_by_year(shares)), rows_of(weights)))
    assert results[0] == results[1]


def test_the_table_of_weights_is_part_of_no_row(spark, tmp_path):
    rows, weights = str(tmp_path / "rows"), str(tmp_path / "weights")
    spark.sql("SELECT 1 AS year, array(0) AS ids, array(2.0D) AS ns, array(0.5D, 0.5D) AS share").write.parquet(rows)
    spark.sql("SELECT 0 AS id, array(0.1D, 0.3D) AS weight").write.parquet(weights)
    found = TP.expected_counts(spark.read.parquet(rows), spark.read.parquet(weights), ["year"])
    assert found.head()["expected"] == [pytest.approx([0.5, 1.5])]
    tree = plan_of(found).split("\n\n")[0].split("=====")[0]
    assert tree.count("Project") == 1


def test_rows_without_terms_and_empty_tables(words):
    shares, _ = TP.fit_topics(words, ["year"], topics=4, iterations=1)
    even = [r for r in shares.collect() if r["share"] == [0.25] * 4]
    assert len(even) == 3  # no words, NULL, and a word outside the vocabulary
    shares, weights = TP.fit_topics(words.limit(0), ["year"], topics=2, iterations=1)
    assert shares.count() == weights.count() == 0


def test_a_round_in_batches_sums_what_the_expressions_expect(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    rows = [(1, [0, 2], [2.0, 1.0], [0.25, 0.75]), (2, [], [], [0.5, 0.5]), (3, [1, 2], [1.0, 3.0], [0.9, 0.1])]
    table = np.array([[0.2, 0.1], [0.3, 0.6], [0.5, 0.3]])
    docs = spark.createDataFrame(rows, "year int, ids array<int>, ns array<double>, share array<double>")
    weights = spark.createDataFrame([(i, list(map(float, w))) for i, w in enumerate(table)], "id int, weight array<double>")
    looked = {r["year"]: np.array(r["expected"]) for r in TP.expected_counts(docs, weights, ["year"]).collect()}
    # A task that hands on its sums after every batch gives the same totals.
    monkeypatch.setattr(TP, "OCCURRENCES", 1)
    batches = [b for n in range(3) for b in docs.filter(f"year = {n + 1}").toArrow().to_batches()]
    out = [r for b in TP._reweighed(table, last=True)(iter(batches)) for r in pa.Table.from_batches([b]).to_pylist()]
    sums = np.zeros((3, 2))
    for r in out:
        if r["_id"] is not None:
            sums[r["_id"]] += np.array(r["_sums"]) / TP.UNIT
    wanted = np.zeros((3, 2))
    for year, ids, _, _ in rows:
        for i, e in zip(ids, looked[year]):
            wanted[i] += e
    assert sums == pytest.approx(wanted, abs=1e-8)
    shares = {r["year"]: r["share"] for r in out if r["_id"] is None}
    assert shares[2] == [0.5, 0.5] and shares[1] == pytest.approx(looked[1].sum(axis=0) / 3)
    assert "ids" not in out[0]
