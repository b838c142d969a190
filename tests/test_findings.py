"""Vocabulary cut, contract rules, article ids and year folders."""

import json

import pytest

from chronolex import schema
from chronolex.operators import contracts as C, terms as TM
from chronolex.plans import bindings as B, term_queries as TQ
from chronolex.sources import articles as A, scratch, tables
from conftest import plan_of, rows_of


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_vocabulary_cut_is_by_count_then_term(spark, size):
    words = [f"w{i:03d}" for i in range(60) for _ in range(1 + i % 4)]
    df = spark.createDataFrame([(words[k::3],) for k in range(3)], "filtered_words array<string>")
    counts = {w: words.count(w) for w in words}
    want = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    vocabulary = TM.vocabulary(df, min_doc_freq=1, size=size)
    assert sorted(r["term"] for r in vocabulary.collect()) == sorted(want)
    assert "TakeOrderedAndProject" not in plan_of(vocabulary)


def test_drift_keeps_rare_and_new_terms(spark):
    rows = [(1869, ["old", "both"]), (1870, ["new", "both"])]
    df = spark.createDataFrame(rows, "year int, filtered_words array<string>")
    drift = TM.vocabulary_drift(df, 1869, [1870])
    assert rows_of(drift, "term", "status") == [("both", "kept"), ("new", "new"), ("old", "gone")]
    shift = TM.feature_drift(df, 1869, [1870])
    assert rows_of(shift, "term", "ref_mean", "cur_mean") == [("both", 0.0, 0.0), ("new", 0.0, 0.0), ("old", 0.0, 0.0)]


def missing(report) -> float:
    return report.filter("check = 'missing_columns'").head()["observed"]


def test_declared_columns_are_required(spark):
    raw = spark.createDataFrame([("a", "b", "c")], "series string, issue string, text string")
    assert missing(C.stage_report(raw, "raw")) == 1  # date
    predictions = spark.createDataFrame([("a", "b", 1, 0.0)], "series string, issue string, year int, pred_label double")
    assert missing(C.stage_report(predictions, "predictions")) == 2  # both probabilities


def test_rules_may_be_given(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"raw": {"required": ["series"], "min_rows": 1}}))
    raw = spark.createDataFrame([("a", "b", "c")], "series string, issue string, text string")
    report = C.stage_report(raw, "raw", rules=C.load_rules(spark, str(path)))
    assert missing(report) == 0 and report.filter("check = 'row_count'").head()["passed"]


def test_article_ids_follow_the_content(spark):
    path, moved = scratch.fresh_path(spark, "articles"), scratch.fresh_path(spark, "articles")
    rows = [("s", "1", None, "text"), ("s", "1", None, "text"), ("s", "2", None, "other")]
    df = spark.createDataFrame(rows, schema.ARTICLE_SCHEMA)
    df.write.parquet(path)
    df.repartition(3).write.parquet(moved)
    ids = [rows_of(A.distinct_article_ids(A.scan_articles(spark, p, with_article_id=True)), "article_id", "text") for p in (path, moved)]
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 3


def test_metadata_must_have_the_declared_columns(spark, tmp_path):
    (tmp_path / "m.csv").write_text("contents,more,series\nx; y,1,s\n")
    assert rows_of(A.scan_metadata(spark, str(tmp_path / "m.csv")), "series", "contents") == [("s", "x; y")]
    (tmp_path / "bad.csv").write_text("contents\nx\n")
    with pytest.raises(ValueError):
        A.scan_metadata(spark, str(tmp_path / "bad.csv"))


def test_year_folders_are_found(spark):
    path = scratch.fresh_path(spark, "years")
    tables.write_year(spark.createDataFrame([(1999, 1), (2031, 2)], "year int, v int"), path, ts_col=None)
    assert sorted(tables.year_folders(spark, path)) == [1999, 2031]
    read = tables.load_prediction_exports(spark, tables.year_folders(spark, path))
    assert rows_of(read, "year", "v") == [(1999, 1), (2031, 2)]


def test_articles_are_scanned_with_pushed_dates(spark, sf):
    path = scratch.fresh_path(spark, "articles")
    B.articles(spark, sf).select("series", "issue", "date", "text").write.parquet(path)
    plan = plan_of(A.read_articles(spark, path, 1869))
    assert "GreaterThanOrEqual(date,1869-01-01)" in plan and "LessThan(date,1870-01-01)" in plan


def test_vocabulary_of_documents_has_no_single_task_sort(spark, sf):
    assert "TakeOrderedAndProject" not in plan_of(TM.vocabulary(TQ.documents(spark, sf)))
