"""The shared step of the training path: processed table, fitting, applying."""

import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from chronolex.operators import features as FT, paragraphs as P
from chronolex.plans import model_queries as M
from chronolex.sources import scratch, tables
from conftest import plan_of, rows_of


def test_a_year_of_one_file_is_read_in_parts(spark, sf, monkeypatch):
    """The training year is one file or two at a time; as one row group each, it kept one core or two busy."""
    monkeypatch.setattr(M, "PROCESSED_ROW_GROUP", 16 * 1024)
    files = spark.read.parquet(M.stored_processed(spark, sf)).inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in files]
    assert min(groups) > 1


def test_row_groups_change_no_rows(spark):
    df = spark.range(5000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit(1869).alias("year"))
    whole, parts = scratch.fresh_path(spark, "whole"), scratch.fresh_path(spark, "parts")
    tables.write_year(df, whole, ts_col=None)
    tables.write_year(df, parts, ts_col=None, row_group_bytes=32 * 1024)
    assert rows_of(spark.read.parquet(whole)) == rows_of(spark.read.parquet(parts))


ROWS = [(i, 1869, " ".join(["alpha", f"word{i % 9}", "bravo,charlie"] * (1 + i % 4))) for i in range(80)] + [(80, 1869, "")]


@pytest.mark.parametrize("options", [{}, {"vectorizer": "count_idf"}, {"min_doc_freq": 1, "num_features": 64}])
def test_features_of_the_fitted_rows_tokenise_once(spark, options):
    df = spark.createDataFrame(ROWS, "id long, year int, cleaned_paragraph string")
    model, features = FT.fit_and_apply(df, **options)
    again = FT.apply_features(FT.fit_features(df, **options), df)
    assert features.columns == again.columns

    def by_term(rows, stages):
        names = getattr(stages.stages[2], "vocabulary", range(options.get("num_features", FT.NUM_FEATURES)))
        return sorted((r["id"], sorted((names[i], x) for i, x in zip(r["features"].indices.tolist(), r["features"].values.tolist()))) for r in rows)

    assert by_term(features.collect(), model) == by_term(FT.apply_features(model, df).collect(), model)
    assert by_term(features.collect(), model) == by_term(again.collect(), FT.fit_features(df, **options))
    assert "cleaned_paragraph" not in FT.fit_and_apply(df, ("cleaned_paragraph",), **options)[1].columns
    # Only the weights are still to be applied: one expression over stored counts, no tokenizer.
    assert plan_of(features).count("UDF(") == 1 and plan_of(again).count("UDF(") > 1


def test_a_vocabulary_reaches_the_jvm_in_one_call(spark, monkeypatch):
    terms = ["é中", "9²", "_"] + [f"t{i}" for i in range(500)]
    plain = CountVectorizerModel.from_vocabulary(terms, inputCol="w", outputCol="v")
    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", lambda *a: pytest.fail("a call per term"))
    model = FT._vocabulary_model(spark, terms, inputCol="w", outputCol="v")
    assert model.vocabulary == terms and model.getVocabSize() == plain.getVocabSize()
    df = spark.createDataFrame([(["_", "t7", "é中", "t7", "none"],), ([],)], "w array<string>")
    assert model.transform(df).collect() == plain.transform(df).collect()


@pytest.mark.parametrize("least", [0, 1, 3])
def test_paragraphs_are_counted_by_their_tokens(spark, least):
    texts = ["alpha bravo charlie delta\n\n\n\nto the\n\nalpha, bravo", "", "alpha about bravo,of charlie"]
    rows = [("s", "1", 1869, None, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "series string, issue string, year int, date date, article_id long, text string")
    want = P.clean_paragraphs(P.split_into_paragraphs(df), min_para_words=least)
    got = P.transform(df, min_para_words=least)
    columns = ["article_id", "paragraph_id", "text", "cleaned_paragraph"]
    assert rows_of(got, *columns) == rows_of(want, *columns)
    assert r"\s+" not in plan_of(got)  # the survivors are told by the size of the token array
