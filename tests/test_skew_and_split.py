import pytest
from pyspark.sql import functions as F

from chronolex.operators import skew, split as SP, terms as TM
from chronolex.plans import bindings as B
from conftest import plan_of, rows_of


@pytest.fixture(scope="module")
def sides(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(0, 60, 2).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("w"))
    return facts, lookup.union(spark.createDataFrame([("hot", -1)], "k string, w long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(sides, how):
    facts, lookup = sides
    plain = facts.join(lookup, "k", how)
    assert rows_of(skew.join_even(facts, lookup, ["k"], how).select(*plain.columns)) == rows_of(plain)
    assert rows_of(skew.join_lookup(facts, lookup, ["k"], how, broadcast_bytes=0).select(*plain.columns)) == rows_of(plain)


def test_hot_key_is_spread_over_salts(sides):
    facts, _ = sides
    hot = skew.hot_keys(facts.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n")
    salts = {r["k"]: r["_salts"] for r in hot.collect()}
    assert salts["hot"] == pytest.approx(skew.HOT_SHARE / 3, abs=1)
    assert sum(salts.values()) <= 2 * skew.HOT_SHARE


def test_lookup_is_broadcast_only_below_the_limit(sides):
    facts, lookup = sides
    assert "BroadcastHashJoin" in plan_of(skew.join_lookup(facts, lookup, ["k"], "inner"))
    measured = skew.measured_bytes(lookup)
    assert measured > 31 * 32
    assert "_salt" in plan_of(skew.join_lookup(facts, lookup, ["k"], "inner", broadcast_bytes=measured - 1))


def test_groups_stay_together_and_ratio_holds(spark, sf):
    marked = SP.with_split(B.articles(spark, sf))
    assert marked.groupBy("series", "issue").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    many = spark.range(5000).select(F.col("id").cast("string").alias("series"), F.lit("1").alias("issue"))
    train, test = SP.group_split(many)
    assert train.count() + test.count() == 5000 and abs(train.count() / 5000 - 0.8) < 0.03
    assert SP.group_split(many, seed=1)[0].exceptAll(train).count() > 0


def test_dedup_both_ways_of_joining(spark, sf):
    train, test = SP.group_split(B.articles(spark, sf))
    kept = SP.drop_shared_text(test, train)
    texts = {r["text"] for r in train.collect()}
    expected = sorted(r["article_id"] for r in test.collect() if r["text"] not in texts)
    assert sorted(r["article_id"] for r in kept.collect()) == expected


def docs(spark, rows):
    return spark.createDataFrame(rows, "id long, year int, label double, filtered_words array<string>")


def test_terms_against_counting_by_hand(spark):
    rows = [(i, 1869 + i % 2, float(i % 2), ["x"] * (i % 3) + ["y", f"t{i % 4}"]) for i in range(24)]
    df = docs(spark, rows)
    import collections
    import math

    tf = {r[0]: collections.Counter(r[3]) for r in rows}
    freq = collections.Counter(t for c in tf.values() for t in c)
    expected = sorted(
        (i, t, n, freq[t], round(n * math.log(25 / (freq[t] + 1)) if freq[t] >= 7 else 0.0, 9))
        for i, c in tf.items() for t, n in c.items()
    )
    got = TM.tfidf_terms(df, "id", min_doc_freq=7).withColumn("tfidf", F.round("tfidf", 9))
    assert rows_of(got, "id", "term", "tf", "df", "tfidf") == sorted(expected, key=repr)
    assert {r["term"]: (r["tf"], r["df"]) for r in TM.vocabulary(df, min_doc_freq=1).collect()} == {
        t: (sum(c[t] for c in tf.values()), freq[t]) for t in freq
    }


def test_feature_drift_equals_mean_of_tfidf(spark):
    rows = [(i, 1869 + i % 2, 0.0, ["x"] * (i % 3) + ["y"] * (i % 2)) for i in range(24)]
    df = docs(spark, rows)
    import math

    drift = {r["term"]: r for r in TM.feature_drift(df, 1869, [1870], min_doc_freq=1).collect()}
    ref = [r for r in rows if r[1] == 1869]
    idf = math.log((len(ref) + 1) / (sum("x" in r[3] for r in ref) + 1))
    for year, side in ((1869, "ref_mean"), (1870, "cur_mean")):
        group = [r for r in rows if r[1] == year]
        assert drift["x"][side] == pytest.approx(idf * sum(r[3].count("x") for r in group) / len(group))


def test_vocabulary_drift_statuses(spark):
    rows = [(1, 1869, 0.0, ["old"] * 6 + ["both"] * 5 + ["rare"] * 4), (2, 1870, 0.0, ["new"] * 5 + ["both"] * 2)]
    drift = TM.vocabulary_drift(docs(spark, rows), 1869, [1870])
    assert rows_of(drift, "term", "ref_tf", "cur_tf", "status") == [
        ("both", 5, 2, "kept"), ("new", 0, 5, "new"), ("old", 6, 0, "gone"), ("rare", 4, 0, "gone"),
    ]
    summary = TM.vocabulary_drift_summary(drift).head()
    assert (summary["new_terms"], summary["gone_terms"], summary["kept_terms"]) == (1, 2, 1)
    assert summary["jaccard"] == pytest.approx(1 / 4)
