from pyspark.sql import Window, functions as F

from chronolex import schema
from chronolex.operators import paragraphs as P
from chronolex.operators.running import running_sums
from chronolex.plans import bindings as B
from chronolex.sources import articles as A
from conftest import plan_of, rows_of


def test_paragraph_ids_have_no_gaps(spark, sf):
    numbered = P.split_into_paragraphs(P.with_year(B.articles(spark, sf)), "\n")
    bad = (
        numbered.groupBy("series", "issue", "year")
        .agg(F.min("paragraph_id").alias("low"), F.max("paragraph_id").alias("high"), F.count_distinct("paragraph_id").alias("d"), F.count("*").alias("n"))
        .filter("low <> 1 OR high <> n OR d <> n")
    )
    assert bad.count() == 0


def test_one_hot_issue_numbers_the_same_in_chunks(spark, sf):
    """All articles in one issue: the chunked numbering equals that of one window."""
    articles = P.with_year(B.articles(spark, sf)).withColumns(
        {"series": F.lit("hot"), "issue": F.lit("1"), "year": F.lit(1869)}
    )
    chunked = P.split_into_paragraphs(articles, "\n")
    order = Window.orderBy("date", "article_id", "pos")
    whole = P.explode_paragraphs(articles, "\n").withColumn("paragraph_id", F.row_number().over(order).cast("long"))
    columns = ["article_id", "paragraph_id", "text"]
    assert rows_of(whole, *columns) == rows_of(chunked, *columns)


def test_transform_equals_split_then_clean(spark, sf):
    articles = P.with_year(B.articles(spark, sf))
    stepwise = P.clean_paragraphs(P.split_into_paragraphs(articles, "\n"), min_para_words=5)
    direct = P.transform(articles, "\n", min_para_words=5)
    columns = ["article_id", "paragraph_id", "text", "cleaned_paragraph"]
    assert rows_of(stepwise, *columns) == rows_of(direct, *columns)


def test_same_result_with_one_shuffle_partition(spark, sf):
    articles = P.with_year(B.articles(spark, sf))
    many = rows_of(P.transform(articles, "\n", min_para_words=5), "article_id", "paragraph_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows_of(P.transform(articles, "\n", min_para_words=5), "article_id", "paragraph_id") == many
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_transform_cleans_once_and_without_python(spark, sf):
    plan = plan_of(P.transform(P.with_year(B.articles(spark, sf)), "\n"))
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    generate = [line for line in plan.splitlines() if "regexp_replace" in line and "Condition" in line]
    assert generate == []  # the filter looks at the cleaned column instead of cleaning again


def test_running_sums_chunks_equal_window(spark):
    rows = [(g, i, (i * 7 + 3) % 11) for g in ("a", "b", None) for i in range(200 if g == "a" else 5)]
    df = spark.createDataFrame(rows, "g string, i int, v long")
    whole = Window.partitionBy("g")
    plain = df.withColumns(
        {"cum_v": F.sum("v").over(whole.orderBy(F.col("i").desc())), "total_v": F.sum("v").over(whole)}
    )
    for rows_per_chunk in (7, 10**6):
        chunked = running_sums(df, ["g"], [F.col("i").desc()], ["v"], chunk_rows=rows_per_chunk)
        assert rows_of(plain) == rows_of(chunked.select(*plain.columns))
    assert chunked.filter("g = 'a' AND i = 0").head()["cum_v"] == sum(v for g, _, v in rows if g == "a")


def test_ingest_keeps_training_labels_only_on_request(spark, sf):
    metadata = B.metadata(spark, sf)
    articles = B.articles(spark, sf)
    assert {r[0] for r in P.ingest(articles, metadata).select("label").distinct().collect()} == {0.0, 1.0, 2.0, 3.0}
    train = P.ingest(articles, metadata, train_labels=schema.TRAIN_LABELS)
    assert {r[0] for r in train.select("label").distinct().collect()} == {0.0, 1.0}
    one_year = P.ingest(articles, metadata, train_labels=schema.TRAIN_LABELS, train_year=1869)
    labels = {(r[0] == 1869, r[1]) for r in one_year.select("year", "label").distinct().collect()}
    assert labels == {(True, 0.0), (True, 1.0), *((False, float(v)) for v in range(4))}


def test_metadata_join_is_broadcast_or_salted_with_the_same_result(spark, sf):
    """A third of the articles in one series; small metadata is broadcast, large metadata is not."""
    hot = F.when(F.col("article_id") % 3 == 0, "src4").otherwise(F.col("series"))
    articles = B.articles(spark, sf).withColumn("series", hot)
    labels = A.label_metadata(B.metadata(spark, sf))
    small = P.label_articles(articles, labels)
    large = P.label_articles(articles, labels, broadcast_bytes=0)
    assert "BroadcastHashJoin Inner" in plan_of(small)
    assert "_salt" in plan_of(large) and "_salt" not in plan_of(small)
    assert rows_of(small, "article_id", "series", "label") == rows_of(large, "article_id", "series", "label")
    assert small.count() == articles.count()
