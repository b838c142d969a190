"""Hashed vectors in long form and the terms behind their buckets."""

import pytest
from pyspark.sql import functions as F

from chronolex.operators import features as FT, terms as TM
from conftest import rows_of


@pytest.fixture(scope="module")
def rows(spark):
    texts = [(1, "alpha beta beta gamma ünïcode 漢字"), (2, "alpha delta epsilon"), (3, ""), (4, "alpha gamma zeta"), (4, "alpha gamma zeta")]
    return spark.createDataFrame(texts, "id int, cleaned_paragraph string")


@pytest.mark.parametrize("width", [4, FT.NUM_FEATURES])
def test_dictionary_names_every_entry(rows, width):
    dictionary = FT.bucket_dictionary(TM.tokenize(rows), width)
    assert dictionary.count() == dictionary.select("term").distinct().count() == 8
    counts = rows_of(dictionary, "term", "tf", "df")
    assert ("alpha", 4, 4) in counts and ("beta", 2, 1) in counts
    features = FT.apply_features(FT.fit_features(rows, num_features=width, min_doc_freq=1), rows, drop_intermediate=False)
    used = FT.vector_entries(features, ["id"], "rawFeatures")
    long = features.select("id", F.explode("filtered_words").alias("term")).join(dictionary, "term")
    # Two equal rows have entries of their own.
    assert rows_of(used.groupBy("id", "bucket").agg(F.sum("weight").cast("long"))) == rows_of(long.groupBy("id", "bucket").count())


def test_collisions(rows):
    narrow, wide = (FT.bucket_collisions(FT.bucket_dictionary(TM.tokenize(rows), n)).collect() for n in (1, FT.NUM_FEATURES))
    assert [(r["terms"], r["main_term"], r["main_share"], r["tf"]) for r in narrow] == [(8, "alpha", 4 / 15, 15)]
    assert wide == []


def test_empty_table(rows):
    empty = TM.tokenize(rows.limit(0))
    assert FT.bucket_dictionary(empty).count() == FT.bucket_collisions(FT.bucket_dictionary(empty)).count() == 0
