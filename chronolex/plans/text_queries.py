"""Ingest, paragraphs and cleaning."""

import functools
import glob
import os
import zipfile

import pyspark
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex import schema
from chronolex.functions import text as T
from chronolex.operators import features, paragraphs as P
from chronolex.plans import bindings as B
from chronolex.plans.catalog import query, with_ctes
from chronolex.sources import articles as A, scratch


@functools.cache
def english_stopwords() -> tuple[str, ...]:
    """Spark's English list, read from its jar so that the SQL text needs no running session."""
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    for jar in glob.glob(f"{home}/jars/spark-mllib_*.jar"):
        with zipfile.ZipFile(jar) as archive:
            words = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
            return tuple(w for w in words.split("\n") if w)
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def clean_stopwords_sql() -> str:
    return sql_list(schema.STOPWORDS)


def cleaned_sql(source: str, columns: str, output: str = "cleaned") -> str:
    """CTE body: `source.text` cleaned word by word, by lists instead of the engine's regexes."""
    return f"""
  SELECT {columns}, array_to_string(list_transform(list_filter(string_split(w, ' '),
      lambda t: t <> '' AND NOT list_contains({clean_stopwords_sql()}, lower(t))), lambda t: lower(t)), ' ') AS {output}
  FROM (SELECT *, array_to_string(list_transform(
      string_split(replace(replace(s, ',', chr(1) || ',' || chr(1)), ' ', chr(1) || ' ' || chr(1)), chr(1)),
      lambda t: CASE WHEN t <> ',' AND t <> ' ' AND length(t) BETWEEN 1 AND 4 THEN '' ELSE t END), '') AS w
    FROM (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
      '[^\\p{{L}}\\p{{N}}_,\\s]', ' ', 'g'), '\\s*,\\s*', ',', 'g'), '\\s+', ' ', 'g')) AS s FROM {source}))"""


LINES = """lines AS (
  SELECT series, issue, date, article_id, CAST(year(date) AS INTEGER) AS year, CAST(i AS INTEGER) AS pos, l[i + 1] AS text
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM articles), unnest(range(len(l))) AS r(i))"""

NUMBERED = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series, issue, year ORDER BY date, article_id, pos) AS paragraph_id
  FROM lines)"""

INGESTED = """ingested AS (
  SELECT a.*, l.metadata, l.label, CAST(year(a.date) AS INTEGER) AS year
  FROM articles a JOIN series_labels l USING (series)
  WHERE year(a.date) <> 1869 OR l.label IN (0.0, 1.0))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.explode_paragraphs(P.with_year(B.articles(spark, sf_dir)), B.SEPARATOR)


def stored_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as a stored table, whose file size tells Spark whether to broadcast it."""
    return scratch.materialize(B.metadata(spark, sf_dir), "metadata")


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training year has only training labels; later years keep all."""
    return P.ingest(
        B.articles(spark, sf_dir),
        stored_metadata(spark, sf_dir),
        train_labels=schema.TRAIN_LABELS,
        train_year=schema.REFERENCE_YEAR,
    )


@query(
    "scan_articles_year",
    with_ctes(
        B.ARTICLES,
        select="SELECT series, issue, date, text FROM articles WHERE date >= DATE '1869-01-01' AND date < DATE '1870-01-01'",
    ),
)
def scan_articles_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles stored as a table, and one year read from it."""
    path = scratch.fresh_path(spark, "articles")
    B.articles(spark, sf_dir).select("series", "issue", "date", "text").write.parquet(path)
    return A.read_articles(spark, path, 1869)


@query("scan_metadata_csv", with_ctes(B.METADATA, select="SELECT series, contents FROM metadata"))
def scan_metadata_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "metadata-csv")
    B.metadata(spark, sf_dir).write.option("header", True).csv(path)
    return A.scan_metadata(spark, path)


@query("metadata_labels", with_ctes(B.LABELLED_METADATA, select="SELECT series, metadata, label FROM series_labels"))
def metadata_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.label_metadata(B.metadata(spark, sf_dir))


@query(
    "ingest_labelled",
    with_ctes(
        B.ARTICLES,
        B.LABELLED_METADATA,
        INGESTED,
        select="SELECT series, issue, date, article_id, metadata, label, year, length(text)::BIGINT AS n_chars FROM ingested",
    ),
)
def ingest_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).select(
        "series", "issue", "date", "article_id", "metadata", "label", "year",
        F.length("text").cast("long").alias("n_chars"),
    )


@query(
    "split_paragraphs",
    with_ctes(B.ARTICLES, LINES, NUMBERED, select="SELECT series, issue, year, paragraph_id, article_id, text FROM numbered"),
)
def split_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = P.split_into_paragraphs(P.with_year(B.articles(spark, sf_dir)), B.SEPARATOR)
    return numbered.select("series", "issue", "year", "paragraph_id", "article_id", "text")


@query(
    "clean_text",
    lambda: with_ctes(
        B.ARTICLES, LINES, f"c AS ({cleaned_sql('lines', 'article_id, pos')})",
        select="SELECT article_id, pos, cleaned FROM c",
    ),
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("article_id", "pos", T.clean_text(F.col("text")).alias("cleaned"))


@query(
    "clean_paragraphs",
    lambda: with_ctes(
        B.ARTICLES, LINES, f"c AS ({cleaned_sql('lines', 'article_id, pos')})",
        select=f"""SELECT article_id, pos, cleaned AS cleaned_paragraph, len(string_split(cleaned, ' '))::INTEGER AS words
          FROM c WHERE len(string_split(cleaned, ' ')) > {B.MIN_WORDS}""",
    ),
)
def clean_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = P.clean_paragraphs(lines(spark, sf_dir), min_para_words=B.MIN_WORDS)
    return cleaned.select(
        "article_id", "pos", "cleaned_paragraph", T.word_count(F.col("cleaned_paragraph")).alias("words")
    )


@query(
    "cap_paragraph_tokens",
    with_ctes(
        B.ARTICLES, LINES,
        select="""SELECT article_id, pos,
          array_to_string(list_slice(regexp_split_to_array(text, '\\s+'), 1, 5), ' ') AS text FROM lines""",
    ),
)
def cap_paragraph_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cap_paragraphs(lines(spark, sf_dir), max_tokens=5).select("article_id", "pos", "text")


@query(
    "transform_year",
    lambda: with_ctes(
        B.ARTICLES, B.LABELLED_METADATA, INGESTED,
        LINES.replace("FROM articles", "FROM ingested").replace("article_id, CAST", "article_id, label, CAST"),
        NUMBERED,
        f"c AS ({cleaned_sql('numbered', 'series, issue, year, label, paragraph_id')})",
        select=f"""SELECT year, label, count(*) AS paragraphs, sum(len(string_split(cleaned, ' ')))::BIGINT AS words,
            count(DISTINCT series || '/' || issue) AS issues, sum(paragraph_id)::BIGINT AS paragraph_id_sum
          FROM c WHERE len(string_split(cleaned, ' ')) > {B.MIN_WORDS} GROUP BY year, label""",
    ),
)
def transform_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = P.transform(ingested(spark, sf_dir), B.SEPARATOR, min_para_words=B.MIN_WORDS)
    return processed.groupBy("year", "label").agg(
        F.count("*").alias("paragraphs"),
        F.sum(T.word_count(F.col("cleaned_paragraph"))).alias("words"),
        F.count_distinct("series", "issue").alias("issues"),
        F.sum("paragraph_id").alias("paragraph_id_sum"),
    )


@query(
    "pad_unlabelled",
    with_ctes(B.ARTICLES, select="SELECT article_id, series, CAST(year(date) AS INTEGER) AS year, NULL::DOUBLE AS label FROM articles"),
)
def pad_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = P.with_year(B.articles(spark, sf_dir)).select("article_id", "series", "year")
    return features.pad_label(plain)
