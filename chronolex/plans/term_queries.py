"""Tokens, vocabulary, TF-IDF and split queries over whole documents."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex.functions import text as T
from chronolex.operators import split as SP, terms as TM
from chronolex.plans import bindings as B
from chronolex.plans.catalog import query, rounded, with_ctes
from chronolex.plans.text_queries import cleaned_sql, english_stopwords, sql_list
from chronolex.schema import INFERENCE_YEARS, REFERENCE_YEAR
from chronolex.sources import scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with their cleaned words, stored once; label 1 marks English."""
    cleaned = T.clean_text(F.col("text")).alias("cleaned_paragraph")
    articles = B.english_articles(spark, sf_dir).select("article_id", "series", "issue", "year", "label", cleaned)
    return scratch.materialize(TM.tokenize(articles).drop("cleaned_paragraph", "words"), "documents")


def words_cte() -> str:
    return f"""cleaned AS ({cleaned_sql('(SELECT a.*, d.lang FROM articles a JOIN documents d ON d.doc_id = a.article_id)', 'article_id, series, issue, CAST(year(date) AS INTEGER) AS year, lang')}),
docs AS (
  SELECT article_id, series, issue, year, CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
    list_filter(regexp_split_to_array(lower(cleaned), '[^\\p{{L}}\\p{{N}}_]'),
      lambda t: t <> '' AND NOT list_contains({sql_list(english_stopwords())}, t)) AS words FROM cleaned),
tf AS MATERIALIZED (SELECT article_id, year, label, term, count(*) AS tf FROM (SELECT *, unnest(words) AS term FROM docs) GROUP BY ALL)"""


def sides_cte() -> str:
    """Terms of each later year beside the reference year."""
    years = ", ".join(f"({y}::INTEGER)" for y in INFERENCE_YEARS)
    return f"""by_year AS (SELECT year, term, sum(tf)::BIGINT AS tf, count(*) AS df FROM tf GROUP BY ALL),
sizes AS (SELECT year, count(*) AS n, sum(len(words))::BIGINT AS total FROM docs GROUP BY year),
ref AS (SELECT y.year, b.term, b.tf, b.df FROM by_year b, (VALUES {years}) AS y(year) WHERE b.year = {REFERENCE_YEAR}),
cur AS (SELECT year, term, tf, df FROM by_year WHERE year IN (SELECT year FROM (VALUES {years}) AS y(year))),
sides AS MATERIALIZED (
  SELECT year, term, coalesce(r.tf, 0) AS ref_tf, coalesce(c.tf, 0) AS cur_tf, coalesce(r.df, 0) AS ref_df
  FROM ref r FULL OUTER JOIN cur c USING (year, term)),
ref_size AS (SELECT n AS ref_n, total AS ref_total FROM sizes WHERE year = {REFERENCE_YEAR}),
vocab AS (
  SELECT s.year, term, ref_tf, cur_tf, ref_tf / ref_total AS ref_share, cur_tf / total AS cur_share,
    CASE WHEN ref_tf = 0 THEN 'new' WHEN cur_tf = 0 THEN 'gone' ELSE 'kept' END AS status
  FROM sides s JOIN sizes USING (year), ref_size),
shift AS (
  SELECT s.year, term, w * ref_tf / ref_n AS ref_mean, w * cur_tf / n AS cur_mean
  FROM (SELECT *, CASE WHEN ref_df >= 5 THEN ln((ref_n + 1) / (ref_df + 1)) ELSE 0 END AS w FROM sides, ref_size) s
    JOIN sizes USING (year))"""


@query(
    "tokenize",
    lambda: with_ctes(
        B.ARTICLES, words_cte(),
        select="SELECT article_id, len(words)::INTEGER AS n_words, md5(array_to_string(words, ' ')) AS digest FROM docs",
    ),
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.col("filtered_words")
    return documents(spark, sf_dir).select(
        "article_id", F.size(words).alias("n_words"), F.md5(F.array_join(words, " ")).alias("digest")
    )


@query(
    "count_vector_vocab",
    lambda: with_ctes(
        B.ARTICLES, words_cte(),
        select=f"""SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 5
          ORDER BY tf DESC, term LIMIT {TM.VOCABULARY_SIZE}""",
    ),
)
def count_vector_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TM.vocabulary(documents(spark, sf_dir))


@query(
    "tfidf_terms",
    lambda: with_ctes(
        B.ARTICLES, words_cte(),
        select="""SELECT article_id, term, tf, df, round(CASE WHEN df >= 5 THEN tf * ln((n + 1) / (df + 1)) ELSE 0 END, 6) AS tfidf
          FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) USING (term), (SELECT count(*) AS n FROM docs)""",
    ),
)
def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(TM.tfidf_terms(documents(spark, sf_dir), "article_id"), "tfidf")


@query(
    "vocab_drift",
    lambda: with_ctes(
        B.ARTICLES, words_cte(), sides_cte(),
        select="""SELECT year, term, ref_tf, cur_tf, round(ref_share, 9) AS ref_share, round(cur_share, 9) AS cur_share, status
          FROM vocab""",
    ),
)
def vocab_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = TM.vocabulary_drift(documents(spark, sf_dir), REFERENCE_YEAR, INFERENCE_YEARS)
    return rounded(drift, "ref_share", "cur_share", digits=9)


@query(
    "vocab_drift_summary",
    lambda: with_ctes(
        B.ARTICLES, words_cte(), sides_cte(),
        select="""SELECT year, count_if(status = 'new')::BIGINT AS new_terms, count_if(status = 'gone')::BIGINT AS gone_terms,
          count_if(status = 'kept')::BIGINT AS kept_terms, round(count_if(status = 'kept') / count(*), 6) AS jaccard
          FROM vocab GROUP BY year""",
    ),
)
def vocab_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = TM.vocabulary_drift(documents(spark, sf_dir), REFERENCE_YEAR, INFERENCE_YEARS)
    return rounded(TM.vocabulary_drift_summary(drift), "jaccard")


@query(
    "feature_drift",
    lambda: with_ctes(
        B.ARTICLES, words_cte(), sides_cte(),
        select="""SELECT year, term, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean,
          round(cur_mean - ref_mean, 6) AS difference FROM shift""",
    ),
)
def feature_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = TM.feature_drift(documents(spark, sf_dir), REFERENCE_YEAR, INFERENCE_YEARS)
    return rounded(drift, "ref_mean", "cur_mean", "difference")


@query(
    "feature_drift_l1",
    lambda: with_ctes(
        B.ARTICLES, words_cte(), sides_cte(),
        select="SELECT year, round(sum(abs(cur_mean - ref_mean)), 6) AS l1, count(*) AS terms FROM shift GROUP BY year",
    ),
)
def feature_drift_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = TM.feature_drift(documents(spark, sf_dir), REFERENCE_YEAR, INFERENCE_YEARS)
    return rounded(TM.feature_drift_l1(drift), "l1")


@query(
    "top_terms_by_class",
    lambda: with_ctes(
        B.ARTICLES, words_cte(),
        """counts AS (SELECT term, coalesce(sum(tf) FILTER (label = 1), 0)::BIGINT AS a,
            coalesce(sum(tf) FILTER (label = 0), 0)::BIGINT AS b FROM tf GROUP BY term),
        odds AS (SELECT term, a, b, ln((a + 1) / (sa + v)) - ln((b + 1) / (sb + v)) AS log_odds
          FROM counts, (SELECT sum(a) AS sa, sum(b) AS sb, count(*) AS v FROM counts))""",
        select="""SELECT label, term, a, b, round(log_odds, 6) AS log_odds FROM (
            (SELECT 1.0::DOUBLE AS label, * FROM odds ORDER BY log_odds DESC, term LIMIT 20) UNION ALL
            (SELECT 0.0::DOUBLE AS label, * FROM odds ORDER BY log_odds, term LIMIT 20))""",
    ),
)
def top_terms_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(TM.top_terms_by_class(documents(spark, sf_dir)), "log_odds")


SPLIT = """marked AS (
  SELECT *, CASE WHEN ('0x' || substr(md5('0/' || series || '/' || issue), 1, 8))::UBIGINT / 4294967296.0 < 0.8
    THEN 'train' ELSE 'test' END AS split FROM articles)"""


@query("group_split", with_ctes(B.ARTICLES, SPLIT, select="SELECT series, issue, article_id, split FROM marked"))
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.with_split(B.articles(spark, sf_dir)).select("series", "issue", "article_id", "split")


@query(
    "split_by_membership",
    with_ctes(
        B.ARTICLES,
        """known AS (SELECT DISTINCT series, issue FROM articles WHERE date < DATE '1870-01-01')""",
        select="""SELECT a.series, a.issue, article_id, CASE WHEN k.issue IS NULL THEN 'test' ELSE 'train' END AS split
          FROM articles a LEFT JOIN known k USING (series, issue)""",
    ),
)
def split_by_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues that have an article in the first year train, all others test."""
    articles = B.articles(spark, sf_dir).select("series", "issue", "article_id", "date")
    known = articles.filter(F.year("date") < 1870)
    train, test = SP.split_by_membership(articles, known)
    marked = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return marked.drop("date")


@query(
    "dedup_across_split",
    with_ctes(
        B.ARTICLES, SPLIT,
        select="""SELECT series, issue, article_id FROM marked WHERE split = 'test'
          AND text NOT IN (SELECT text FROM marked WHERE split = 'train')""",
    ),
)
def dedup_across_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = SP.group_split(B.articles(spark, sf_dir))
    return SP.drop_shared_text(test, train).select("series", "issue", "article_id")
