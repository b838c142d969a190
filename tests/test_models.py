import pytest
from pyspark.sql import functions as F

from chronolex.functions.vectors import nonzero_count
from chronolex.operators import features as FT, models as MD, registry as R, split as SP
from chronolex.sources import scratch
from conftest import plan_of


@pytest.fixture(scope="module")
def processed(spark):
    rows = []
    for i in range(240):
        label = float(i % 2)
        words = ["harvest", "railway", "senate"] if label else ["marché", "liberté", "théâtre"]
        rows.append((f"s{i % 12}", str(i % 40), 1869, i, " ".join(words + [f"filler{i % 5}"]), label))
    columns = "series string, issue string, year int, paragraph_id long, cleaned_paragraph string, label double"
    return spark.createDataFrame(rows, columns).coalesce(1)


@pytest.fixture(scope="module")
def features(processed):
    return scratch.materialize(FT.apply_features(FT.fit_features(processed, num_features=1024), processed), "features")


def test_unicode_words_stay_whole(processed):
    model = FT.fit_features(processed, vectorizer="count_idf")
    assert "liberté" in model.stages[2].vocabulary
    assert "words" not in FT.apply_features(model, processed).columns
    assert "filtered_words" in FT.apply_features(model, processed, drop_intermediate=False).columns


def test_vocabulary_cut_is_decided_by_the_term(spark):
    """Ten equally frequent terms, room for four: always the first four."""
    rows = [(" ".join(f"term{i}" for i in range(10)),)] * 6
    for partitions in (1, 6):
        df = spark.createDataFrame(rows, "cleaned_paragraph string").repartition(partitions)
        model = FT.fit_features(df, vectorizer="count_idf", vocabulary_size=4)
        assert model.stages[2].vocabulary == ["term0", "term1", "term2", "term3"]


def test_nonzero_count_reads_sparse_vectors(features):
    assert {r[0] for r in features.select(nonzero_count(F.col("features"))).collect()} == {4}


def test_store_and_reload_features(spark, processed):
    store, stages = scratch.fresh_path(spark, "f"), scratch.fresh_path(spark, "s")
    FT.store_training_features(processed, store, stages, num_features=1024)
    later = processed.drop("label").withColumn("year", F.lit(1870))
    FT.store_inference_features(later, store, stages)
    stored = spark.read.parquet(store)
    assert {(r["year"], r["n"], r["labels"]) for r in stored.groupBy("year").agg(F.count("*").alias("n"), F.count("label").alias("labels")).collect()} == {(1869, 240, 240), (1870, 240, 0)}
    assert "feature_ts" in stored.columns


def test_three_models_learn_and_score(spark, features):
    train, test = SP.group_split(features)
    fitted, metrics, runs = MD.train_all(train, test)
    accuracy = {r["model_name"]: r["metric_value"] for r in metrics.filter("metric_name = 'accuracy'").collect()}
    assert set(accuracy) == set(MD.PARAMS) and min(accuracy.values()) > 0.95
    areas = {r["model_name"] for r in metrics.filter("metric_name = 'areaUnderROC'").collect()}
    assert areas == {"logistic_regression", "naive_bayes"}
    assert runs.count() == 3 and runs.filter("params['smoothing'] = '1.0'").count() == 1

    lr = MD.score(fitted["logistic_regression"][0], features, "logistic_regression", "1")
    assert lr.columns[:5] == ["series", "issue", "paragraph_id", "year", "label"]
    assert lr.filter("abs(prob_democrat + prob_republican - 1) > 1e-9").count() == 0
    assert "EvalPython" not in plan_of(lr)
    svc = MD.score(fitted["linear_svc"][0], features.drop("label"), "linear_svc", "1", year=1870)
    assert "label" not in svc.columns
    assert svc.filter("prob_democrat IS NULL AND prob_republican IS NULL AND year = 1870").count() == 240

    base = scratch.fresh_path(spark, "models")
    for model, run_id in fitted.values():
        R.save_model(model, f"{base}/{run_id}")
    promoted = R.promote(MD.candidate_versions(metrics, "classifier", after_version=4))
    model, version = R.load_production_model(spark, promoted, "classifier", base)
    assert version == "7"
    assert MD.score(model, features, "classifier", version).count() == 240
    with pytest.raises(LookupError):
        R.load_production_model(spark, promoted, "other", base)


def test_svc_rejects_a_third_label(features):
    three = features.withColumn("label", F.when(F.col("paragraph_id") == 0, 2.0).otherwise(F.col("label")))
    with pytest.raises(Exception):
        MD.build_model("linear_svc").fit(three)
    assert MD.training_rows(three).count() == 239


def test_tuning_uses_all_folds(features):
    search = MD.tune("naive_bayes", features, {"smoothing": [0.5, 1.0]})
    assert len(search.avgMetrics) == 2


def test_grids_name_real_parameters():
    for name, grid in MD.GRIDS.items():
        assert all(MD.build_model(name).hasParam(p) for p in grid)


def test_topics_sum_to_one(processed):
    shares = FT.topic_share_by_year(processed, k=2, max_iter=2).groupBy("year").agg(F.sum("share").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-6 for r in shares.collect())


def test_fingerprints_follow_content_only(spark):
    df = spark.createDataFrame([(i % 7, None if i % 3 == 0 else f"t{i}", i / 4) for i in range(200)], "a int, b string, c double")
    known = R.table_fingerprint(df)
    assert {R.table_fingerprint(df.repartition(k, "b")) for k in (1, 5, 40)} == {known}
    assert R.table_fingerprint(df.select("c", "b", "a")) == known and known.startswith("200-")
    changed = df.withColumn("b", F.when(F.col("c") == 10.25, "other").otherwise(F.col("b")))
    emptied = df.withColumn("b", F.when(F.col("c") == 10.25, "").otherwise(F.col("b")))
    others = {R.table_fingerprint(x) for x in (changed, emptied, df.union(df.limit(1)), df.filter("c > 0"))}
    assert len(others) == 4 and known not in others
    assert R.table_fingerprint(df.limit(0)) == "0-0"
    # Disjoint parts add up.
    halves = [int(R.table_fingerprint(df.filter(c), ["a", "b", "c"]).split("-")[1]) for c in ("c < 20", "c >= 20")]
    assert sum(halves) == int(known.split("-")[1])


def test_feature_frequencies_of_both_vectorizers(spark, processed):
    for options in ({"vectorizer": "count_idf"}, {"num_features": 1024}):
        model = FT.fit_features(processed, **options)
        found = FT.feature_frequencies(spark, model)
        assert found.filter("df > 0").count() >= 11 and found.agg(F.max("df")).head()[0] == 120
        again = FT.fit_features(processed.repartition(5), **options)
        assert R.table_fingerprint(found) == R.table_fingerprint(FT.feature_frequencies(spark, again))


def test_tables_of_the_training_path_hold_what_is_read_again(spark, sf):
    from chronolex.plans import model_queries as M

    processed = spark.read.parquet(M.stored_processed(spark, sf))
    assert set(processed.columns) == {*M.DATA_COLUMNS, "ingestion_ts"}
    store = spark.read.parquet(M.hashed_features(spark, sf))
    assert not {"text", "cleaned_paragraph"} & set(store.columns) and {*M.KEY.split(", "), "label", "features"} < set(store.columns)
    assert store.count() == processed.count()


def test_term_profile_counts_without_a_struct_per_word(spark):
    from chronolex.operators.terms import term_profile

    words = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["a"]), (2, []), (2, None)], "k int, w array<string>")
    profile = term_profile(words, ["k"], "w")
    assert {tuple(r) for r in profile.collect()} == {(1, "a", 3, 2), (1, "b", 1, 1)}
    assert "lambda" not in plan_of(profile)


def test_topic_shares_are_stored_and_nothing_stays_in_memory(spark):
    rows = [(1869 + i % 2, "ship harbour sail" if i % 2 else "wheat barley plough") for i in range(40)]
    shares = FT.topic_share_by_year(spark.createDataFrame(rows, "year int, cleaned_paragraph string"), k=2, max_iter=2)
    assert "Scan parquet" in plan_of(shares) and shares.count() == 4
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
