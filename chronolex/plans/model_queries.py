"""Evaluation, registry, features, training and scoring."""


from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex import schema
from chronolex.functions.vectors import nonzero_count, stored_values
from chronolex.operators import (
    evaluation as E, features as FT, models as MD, optimality as O, paragraphs as P, registry as R, split as SP,
    terms as TM, topics as TP,
)
from chronolex.operators.skew import join_lookup
from chronolex.plans import bindings as B
from chronolex.plans.catalog import query, rounded, with_ctes
from chronolex.plans.text_queries import LINES, NUMBERED, cleaned_sql, english_stopwords, sql_list
from chronolex.sources import scratch, tables

# --- evaluation tables over scores that need no trained model -----------------------------------

MATRIX = "matrix AS (SELECT label, prediction, count(*) AS n FROM eval_scores GROUP BY ALL)"
CLASSES = """classes AS (
  SELECT class, tp, support, predicted, coalesce(tp / nullif(predicted, 0), 0)::DOUBLE AS precision,
    coalesce(tp / nullif(support, 0), 0)::DOUBLE AS recall
  FROM (SELECT c.class, coalesce(sum(n) FILTER (label = c.class AND prediction = c.class), 0)::BIGINT AS tp,
      coalesce(sum(n) FILTER (label = c.class), 0)::BIGINT AS support,
      coalesce(sum(n) FILTER (prediction = c.class), 0)::BIGINT AS predicted
    FROM (SELECT label AS class FROM matrix UNION SELECT prediction FROM matrix) c, matrix GROUP BY c.class)),
scored AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0::DOUBLE
  ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM classes)"""
CURVE = """sides AS (
  SELECT 1.0::DOUBLE AS class, score, label = 1 AS hit FROM eval_scores
  UNION ALL SELECT 0.0::DOUBLE, 1 - score, label = 0 FROM eval_scores),
steps AS (SELECT class, score, count_if(hit) AS pos, count_if(NOT hit) AS neg FROM sides GROUP BY ALL),
curve AS (
  SELECT class, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER (PARTITION BY class) AS all_pos, sum(neg) OVER (PARTITION BY class) AS all_neg
  FROM steps WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""

POINTS = """points AS (
  SELECT *, tp / all_pos AS tpr, fp / all_neg AS fpr, tp / (tp + fp) AS prec,
    lag(tp / all_pos, 1, 0) OVER w AS tpr0, lag(fp / all_neg, 1, 0) OVER w AS fpr0,
    coalesce(lag(tp / (tp + fp)) OVER w, tp / (tp + fp)) AS prec0
  FROM curve WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""
AREAS = """areas AS (
  SELECT class, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS "areaUnderROC", sum((tpr - tpr0) * (prec + prec0) / 2) AS "areaUnderPR"
  FROM points GROUP BY class)"""


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion_matrix(B.eval_scores(spark, sf_dir))


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("score")
    return E.curve_counts(B.eval_scores(spark, sf_dir), {1.0: score, 0.0: 1 - score})


@query("confusion_matrix", with_ctes(B.EVAL_SCORES, MATRIX, select="SELECT * FROM matrix"))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir)


@query(
    "per_class_metrics",
    with_ctes(
        B.EVAL_SCORES, MATRIX, CLASSES,
        select="""SELECT class, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1 FROM scored""",
    ),
)
def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.per_class_metrics(_matrix(spark, sf_dir)), "precision", "recall", "f1")


@query(
    "classification_metrics",
    with_ctes(
        B.EVAL_SCORES, MATRIX, CLASSES,
        select="""SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1,
          round(sum(precision * support) / sum(support), 6) AS "weightedPrecision",
          round(sum(recall * support) / sum(support), 6) AS "weightedRecall", round(avg(f1), 6) AS "macroF1" FROM scored""",
    ),
)
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    overall = E.classification_metrics(E.per_class_metrics(_matrix(spark, sf_dir)))
    return rounded(overall, *overall.columns)


@query(
    "roc_points",
    with_ctes(
        B.EVAL_SCORES, CURVE,
        select="""SELECT class, round(score, 9) AS score, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / all_pos, 6) AS tpr,
          round(fp / all_neg, 6) AS fpr FROM curve""",
    ),
)
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(E.roc_points(_curve(spark, sf_dir)), "tpr", "fpr"), "score", digits=9)


@query(
    "pr_points",
    with_ctes(
        B.EVAL_SCORES, CURVE,
        select="""SELECT class, round(score, 9) AS score, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / (tp + fp), 6) AS precision,
          round(tp / all_pos, 6) AS recall FROM curve""",
    ),
)
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(E.pr_points(_curve(spark, sf_dir)), "precision", "recall"), "score", digits=9)


@query(
    "auc_metrics",
    with_ctes(
        B.EVAL_SCORES, CURVE,
        POINTS, AREAS,
        select="""SELECT class, round("areaUnderROC", 6) AS "areaUnderROC", round("areaUnderPR", 6) AS "areaUnderPR" FROM areas""",
    ),
)
def auc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.auc_metrics(_curve(spark, sf_dir)), "areaUnderROC", "areaUnderPR")


# --- model versions ------------------------------------------------------------------------------


@query(
    "latest_production_version",
    with_ctes(
        B.VERSIONS,
        select="""SELECT name, version, stage, run_id, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1 FROM versions
          WHERE stage = 'Production' QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
    ),
)
def latest_production_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.latest_version(B.model_versions(spark, sf_dir)), "accuracy", "f1", digits=9)


@query(
    "promote_model",
    with_ctes(
        B.VERSIONS,
        "newest AS (SELECT name, max(version) AS new FROM versions WHERE stage = 'Staging' GROUP BY name)",
        select="""SELECT v.name, version, run_id, CASE WHEN stage = 'Staging' AND version = new THEN 'Production'
            WHEN new IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage
          FROM versions v LEFT JOIN newest n ON n.name = v.name""",
    ),
)
def promote_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.promote(B.model_versions(spark, sf_dir)).select("name", "version", "run_id", "stage")


@query(
    "select_best_model",
    with_ctes(
        B.VERSIONS,
        select="""SELECT name, version, run_id, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1 FROM versions
          WHERE stage = 'Staging' AND accuracy >= 0.7::DOUBLE AND f1 >= 0.01::DOUBLE +
            (SELECT f1 FROM versions WHERE stage = 'Production' ORDER BY version DESC LIMIT 1)
          ORDER BY f1 DESC, name, version LIMIT 1""",
    ),
)
def select_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = R.select_best(B.model_versions(spark, sf_dir)).select("name", "version", "run_id", "accuracy", "f1")
    return rounded(best, "accuracy", "f1", digits=9)


# --- features, training, scoring -----------------------------------------------------------------
# Vocabulary features and Naive Bayes are plain sums, so SQL can follow them from text to score.

KEY = "series, issue, year, paragraph_id"


def feature_ctes(fit_years: str) -> tuple[str, ...]:
    """Processed paragraphs and their TF-IDF in long form, fitted on the rows where `fit_years`."""
    columns = f"{KEY}, lang"
    lines = LINES.replace("FROM articles", "FROM texts").replace("article_id, CAST", "article_id, lang, CAST")
    stop = sql_list(english_stopwords())
    return (
        B.ARTICLES,
        "texts AS (SELECT a.*, d.lang FROM articles a JOIN documents d ON d.doc_id = a.article_id)",
        lines,
        NUMBERED,
        f"cleaned AS ({cleaned_sql('numbered', columns)})",
        f"""docs AS (SELECT {KEY}, CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
            CASE WHEN ('0x' || substr(md5('0/' || series || '/' || issue), 1, 8))::UBIGINT / 4294967296.0 < 0.8
              THEN 'train' ELSE 'test' END AS split,
            list_filter(regexp_split_to_array(cleaned, '[^\\p{{L}}\\p{{N}}_]'),
              lambda t: t <> '' AND NOT list_contains({stop}, t)) AS words
          FROM cleaned WHERE len(string_split(cleaned, ' ')) > {B.MIN_WORDS})""",
        f"""long AS (SELECT {KEY}, label, split, term, count(*) AS tf
          FROM (SELECT *, unnest(words) AS term FROM docs) GROUP BY ALL)""",
        f"""vocab AS (SELECT term, count(*) AS df FROM long WHERE {fit_years} GROUP BY term HAVING count(*) >= 5
          ORDER BY sum(tf) DESC, term LIMIT 50000)""",
        f"fitted AS (SELECT count(*) AS n FROM docs WHERE {fit_years})",
        "vec AS (SELECT l.*, tf * ln((n + 1) / (df + 1)) AS x FROM long l JOIN vocab USING (term), fitted)",
        f"""sums AS (SELECT {KEY}, label, split, count(x) FILTER (x <> 0) AS nonzero, coalesce(sum(x), 0) AS weight
          FROM docs LEFT JOIN vec USING ({KEY}, label, split) GROUP BY ALL)""",
    )


TRAIN_YEAR = f"year = {schema.REFERENCE_YEAR}"
BAYES = (
    f"train AS (SELECT * FROM docs WHERE {TRAIN_YEAR} AND split = 'train')",
    "pi AS (SELECT label AS class, ln(count(*) + 1) - ln((SELECT count(*) FROM train) + 2) AS pi FROM train GROUP BY label)",
    f"""totals AS (SELECT p.class, v.term, coalesce(sum(x), 0) AS s FROM pi p CROSS JOIN vocab v
      LEFT JOIN vec ON vec.term = v.term AND vec.label = p.class AND {TRAIN_YEAR} AND split = 'train' GROUP BY ALL)""",
    """theta AS (SELECT class, term, ln(s + 1) - ln(sum(s) OVER (PARTITION BY class) + count(*) OVER (PARTITION BY class)) AS theta
      FROM totals)""",
    f"""raw AS (SELECT d.series, d.issue, d.year, d.paragraph_id, d.label, d.split, p.class,
        any_value(p.pi) + coalesce(sum(x * theta), 0) AS raw
      FROM docs d CROSS JOIN pi p LEFT JOIN vec v ON v.series = d.series AND v.issue = d.issue AND v.year = d.year
        AND v.paragraph_id = d.paragraph_id LEFT JOIN theta t ON t.class = p.class AND t.term = v.term GROUP BY ALL)""",
    f"""bayes AS (SELECT {KEY}, label, split, round(max(raw) FILTER (class = 1) - max(raw) FILTER (class = 0), 9) AS score
      FROM raw GROUP BY ALL)""",
    f"""scored_rows AS (SELECT {KEY}, label, split, CASE WHEN score > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred_label,
        round(1 / (1 + exp(least(score, 700))), 6) AS prob_democrat, round(1 / (1 + exp(least(-score, 700))), 6) AS prob_republican
      FROM bayes)""",
)
PREDICTED = f"SELECT {KEY}, label, pred_label, prob_democrat, prob_republican FROM scored_rows"


def bayes_metrics(select: str, *more: str) -> str:
    """Metrics of Naive Bayes on the test rows, from the same SQL as the evaluation queries."""
    tests = f"""eval_scores AS (SELECT label, score, CASE WHEN score > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
      FROM bayes WHERE {TRAIN_YEAR} AND split = 'test')"""
    overall = """overall AS (SELECT sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1,
      sum(precision * support) / sum(support) AS "weightedPrecision", sum(recall * support) / sum(support) AS "weightedRecall",
      avg(f1) AS "macroF1" FROM scored)"""
    tall = f"""tall AS (
      SELECT metric_name, metric_value FROM (UNPIVOT overall ON accuracy, f1, "weightedPrecision", "weightedRecall", "macroF1"
        INTO NAME metric_name VALUE metric_value)
      UNION ALL SELECT metric_name, metric_value FROM (UNPIVOT areas ON "areaUnderROC", "areaUnderPR"
        INTO NAME metric_name VALUE metric_value) WHERE class = 1)"""
    return with_ctes(
        *feature_ctes(TRAIN_YEAR), *BAYES, tests, MATRIX, CLASSES, CURVE, POINTS, AREAS, overall, tall, *more, select=select
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed paragraphs of all years; label 1 marks English (learnable, unlike a series label)."""
    rows = P.transform(B.english_articles(spark, sf_dir), B.SEPARATOR, min_para_words=B.MIN_WORDS)
    return rows.select("series", "issue", "year", "paragraph_id", "text", "cleaned_paragraph", "label")


PROCESSED_ROW_GROUP = 8 * 1024 * 1024


def stored_processed(spark: SparkSession, sf_dir: str) -> str:
    """The processed table without the raw text, which nothing behind it reads.

    Its paragraphs cost far more to count than to read, so its row groups are small: the training year is a sixth of it.
    """
    path = scratch.fresh_path(spark, "processed")
    tables.write_year(processed(spark, sf_dir).drop("text"), path, row_group_bytes=PROCESSED_ROW_GROUP)
    return path


def stored_features(spark: SparkSession, sf_dir: str, **options) -> str:
    """Feature store of all years, with stages fitted on the training year, saved and loaded again.

    It holds keys, label and vector; the paragraphs stay in the processed table, whose files are read year by year.
    """
    options |= dict(without=("cleaned_paragraph",), rebalance=False)
    store, stages = scratch.fresh_path(spark, "features"), scratch.fresh_path(spark, "stages")
    path = stored_processed(spark, sf_dir)
    train = tables.read_year(spark, path, schema.REFERENCE_YEAR)
    FT.store_training_features(train, store, stages, **options)
    later = spark.read.parquet(path).filter(F.col("year") != schema.REFERENCE_YEAR)
    FT.store_inference_features(later, store, stages, without=options["without"], rebalance=False)
    return store


def vocabulary_features(spark: SparkSession, sf_dir: str) -> str:
    return stored_features(spark, sf_dir, vectorizer="count_idf")


def hashed_features(spark: SparkSession, sf_dir: str) -> str:
    return stored_features(spark, sf_dir)


def readable(features: DataFrame) -> DataFrame:
    """Feature rows with counts and sums in place of the vector."""
    values = stored_values(F.col("features"))
    return features.select(
        "series", "issue", "year", "paragraph_id", "label",
        nonzero_count(F.col("features")).cast("long").alias("nonzero"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("weight"),
    )


READABLE = f"SELECT {KEY}, label, nonzero, round(weight, 6) AS weight FROM sums"


@query("feature_store_train", lambda: with_ctes(*feature_ctes(TRAIN_YEAR), select=f"{READABLE} WHERE {TRAIN_YEAR}"))
def feature_store_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch.fresh_path(spark, "features")
    train = tables.read_year(spark, stored_processed(spark, sf_dir), schema.REFERENCE_YEAR)
    FT.store_training_features(train, store, vectorizer="count_idf")
    return readable(tables.read_year(spark, store, schema.REFERENCE_YEAR))


@query("feature_store_infer", lambda: with_ctes(*feature_ctes(TRAIN_YEAR), select=f"{READABLE} WHERE NOT {TRAIN_YEAR}"))
def feature_store_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = spark.read.parquet(vocabulary_features(spark, sf_dir))
    return readable(features.filter(F.col("year") != schema.REFERENCE_YEAR))


@query("feature_model_roundtrip", lambda: with_ctes(*feature_ctes("true"), select=READABLE))
def feature_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages fitted on all years, saved, loaded and applied."""
    rows = spark.read.parquet(stored_processed(spark, sf_dir))
    path = scratch.fresh_path(spark, "stages")
    tables.save_feature_model(FT.fit_features(rows, vectorizer="count_idf"), path)
    return readable(FT.apply_features(tables.load_feature_model(path), rows))


def _bucket_ctes() -> tuple[str, ...]:
    """Hashed TF-IDF from the raw text on. The bucket is MurmurHash3 (32 bits, seed 42) of the term's UTF-8 bytes."""
    word = lambda x: f"(({x}) & 4294967295)"
    turn = lambda x, by: word(f"(({x}) << {by}) | (({x}) >> {32 - by})")
    times = lambda x, y: word(f"({x}) * {y}::UBIGINT")
    mixed = lambda k: times(turn(times(k, 3432918353), 15), 461845907)
    byte = lambda at: f"('0x' || substr(h, {at}, 2))::UBIGINT"
    # A block is four bytes, the lowest first; what is left at the end is mixed in without a turn.
    block = f"{byte('8 * i + 1')} | ({byte('8 * i + 3')} << 8) | ({byte('8 * i + 5')} << 16) | ({byte('8 * i + 7')} << 24)"
    left = " | ".join(
        f"CASE WHEN n % 4 > {j} THEN {byte(f'8 * (n // 4) + {2 * j + 1}')} << {8 * j} ELSE 0::UBIGINT END" for j in range(3)
    )
    step = word(f"{times(turn('xor(a, b)', 13), 5)} + 3864292196")
    half = lambda x, by: f"xor({x}, {x} >> {by})"
    return (
        "bytes AS (SELECT term, hex(encode(term)) AS h, strlen(term) AS n FROM (SELECT DISTINCT term FROM long))",
        f"""blocks AS (SELECT term, n, {left} AS rest, list_prepend(42::UBIGINT,
            list_transform(range(n // 4), lambda i: {mixed(block)})) AS ks FROM bytes)""",
        f"mixed AS (SELECT term, n, xor(xor(list_reduce(ks, lambda a, b: {step}), {mixed('rest')}), n::UBIGINT) AS h0 FROM blocks)",
        f"mixed1 AS (SELECT term, {times(half('h0', 16), 2246822507)} AS h1 FROM mixed)",
        f"mixed2 AS (SELECT term, {times(half('h1', 13), 3266489909)} AS h2 FROM mixed1)",
        f"dictionary AS (SELECT term, ({half('h2', 16)} % 262144)::INTEGER AS bucket FROM mixed2)",
        f"bucketed AS (SELECT {KEY}, bucket, sum(tf) AS tf FROM long JOIN dictionary USING (term) GROUP BY ALL)",
        "frequent AS (SELECT bucket, count(*) AS df FROM bucketed GROUP BY bucket HAVING count(*) >= 5)",
        """weighed AS (SELECT b.*, tf * ln(((SELECT count(*) FROM docs) + 1) / (df + 1)) AS x
          FROM bucketed b JOIN frequent USING (bucket))""",
    )


HASHED_SQL = f"""SELECT {KEY}, label, count(x) FILTER (x <> 0) AS nonzero, round(coalesce(sum(x), 0), 6) AS weight
  FROM docs LEFT JOIN weighed USING ({KEY}) GROUP BY ALL"""


@query("tfidf_features", lambda: with_ctes(*feature_ctes("true"), *_bucket_ctes(), select=HASHED_SQL))
def tfidf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default, hashed vectors."""
    rows = spark.read.parquet(stored_processed(spark, sf_dir))
    return readable(FT.fit_and_apply(rows, ("cleaned_paragraph",))[1])


@query(
    "bucket_dictionary",
    lambda: with_ctes(
        *feature_ctes("true"), *_bucket_ctes(),
        select="SELECT term, bucket, sum(tf)::BIGINT AS tf, count(*) AS df FROM long JOIN dictionary USING (term) GROUP BY ALL",
    ),
)
def bucket_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FT.bucket_dictionary(TM.tokenize(spark.read.parquet(stored_processed(spark, sf_dir))))


@query(
    "hashed_entries",
    lambda: with_ctes(
        *feature_ctes("true"), *_bucket_ctes(),
        "names AS (SELECT bucket, count(*) AS terms FROM dictionary GROUP BY bucket)",
        select=f"""SELECT {KEY}, w.bucket, round(x, 6) AS weight, terms FROM weighed w JOIN names USING (bucket) WHERE x <> 0""",
    ),
)
def hashed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed vectors in long form, each entry beside the number of terms that share its bucket."""
    rows = spark.read.parquet(stored_processed(spark, sf_dir))
    names = FT.bucket_dictionary(TM.tokenize(rows)).groupBy("bucket").agg(F.count("*").alias("terms"))
    entries = FT.vector_entries(FT.fit_and_apply(rows, ("cleaned_paragraph",))[1], KEY.split(", "))
    # One row per used bucket of a fixed number of buckets; measured before it is broadcast.
    return rounded(join_lookup(entries, scratch.materialize(names, "bucket-terms"), ["bucket"], "inner"), "weight")


def split_training(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    return SP.group_split(tables.read_year(spark, store, schema.REFERENCE_YEAR))


def _train(spark: SparkSession, store: str, names: list[str] | None = None) -> DataFrame:
    metrics = MD.train_all(*split_training(spark, store), names)[1]
    return rounded(metrics.drop("run_id"), "metric_value")


@query(
    "train_nb",
    lambda: bayes_metrics(
        "SELECT 'naive_bayes' AS model_name, metric_name, round(metric_value, 6) AS metric_value FROM tall"
    ),
)
def train_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, vocabulary_features(spark, sf_dir), ["naive_bayes"])


@query("train_lr")
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, hashed_features(spark, sf_dir), ["logistic_regression"])


@query("train_svc")
def train_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, hashed_features(spark, sf_dir), ["linear_svc"])


# The largest entry of the gradient that a fitted model may have: the logistic loss is smooth and met to many
# digits, the hinge is not, and its optimizer stops where progress does.
LARGEST_ENTRY = {"logistic_regression": 1e-5, "linear_svc": 0.05}


def gradient_sql(name: str, classes: int) -> str:
    """What an optimal model fulfils: no coefficient can move, and probabilities have the mean of the labels."""
    mean = "round(avg(label), 3)" if name == "logistic_regression" else "NULL::DOUBLE"
    return with_ctes(
        *feature_ctes(TRAIN_YEAR),
        f"train AS (SELECT * FROM docs WHERE {TRAIN_YEAR} AND split = 'train')",
        f"""used AS (SELECT term FROM vec WHERE {TRAIN_YEAR} AND split = 'train' AND x <> 0 GROUP BY term
          HAVING count(*) < (SELECT count(*) FROM train) OR var_samp(x) > 0)""",
        select=f"""SELECT '{name}' AS model_name, count(*) AS rows, {classes} * (1 + (SELECT count(*) FROM used)) AS entries,
          {mean} AS mean_probability, true AS stationary FROM train""",
    )


def _gradient(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    train, _ = split_training(spark, vocabulary_features(spark, sf_dir))
    kept = scratch.materialize(MD.training_rows(train), "training-rows")
    model = MD.build_model(name).fit(kept)
    coefficients = scratch.materialize(O.coefficient_rows(spark, model), "coefficients")
    worst = O.largest_entry(O.gradient(kept, coefficients, name, MD.PARAMS[name]["regParam"]))
    scored = MD.score(model, kept, name, "1")
    means = scored.agg(F.count("*").alias("rows"), F.round(F.avg("prob_republican"), 3).alias("mean_probability"))
    return means.join(worst).select(  # one row each
        F.lit(name).alias("model_name"), "rows", "entries", "mean_probability",
        (F.col("largest") <= LARGEST_ENTRY[name]).alias("stationary"),
    )


@query("lr_gradient", lambda: gradient_sql("logistic_regression", 2))
def lr_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gradient(spark, sf_dir, "logistic_regression")


@query("svc_gradient", lambda: gradient_sql("linear_svc", 1))
def svc_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gradient(spark, sf_dir, "linear_svc")


@query("train_all_models")
def train_all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, hashed_features(spark, sf_dir))


DATA_COLUMNS = [*KEY.split(", "), "cleaned_paragraph", "label"]


def _versions_sql() -> tuple[str, str]:
    """Fingerprints of the processed training year, and of the vocabulary fitted on it, from the raw text."""

    def fingerprint(name: str, columns: list[str], rows: str) -> str:
        texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns)
        digest = f"('0x' || substr(md5(concat_ws(chr(31), {texts})), 1, 15))::UBIGINT::HUGEINT"
        return f"{name} AS (SELECT count(*) || '-' || coalesce(sum({digest}), 0) AS {name} FROM ({rows}))"

    processed_rows = f"""SELECT {KEY}, cleaned AS cleaned_paragraph, CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
      FROM cleaned WHERE {TRAIN_YEAR} AND len(string_split(cleaned, ' ')) > {B.MIN_WORDS}"""
    return fingerprint("data_version", DATA_COLUMNS, processed_rows), fingerprint("feature_version", ["term", "df"], "SELECT term, df FROM vocab")


def _run_log_sql() -> str:
    select = """SELECT 'naive_bayes' AS model_name, 'features' AS feature_table, feature_version, data_version,
        '1.0' AS smoothing, metric_name, round(metric_value, 6) AS metric_value FROM tall, feature_version, data_version"""
    return bayes_metrics(select, *_versions_sql())


@query("run_log", _run_log_sql)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows beside their metrics, without the random run id; versions are fingerprints of what was trained on."""
    store = scratch.fresh_path(spark, "features")
    processed_year = tables.read_year(spark, stored_processed(spark, sf_dir), schema.REFERENCE_YEAR)
    stages = FT.store_training_features(processed_year, store, vectorizer="count_idf")
    _, metrics, runs = MD.train_all(
        *split_training(spark, store), ["naive_bayes"],
        feature_version=R.table_fingerprint(FT.feature_frequencies(spark, stages), ["term", "df"]),
        data_version=R.table_fingerprint(processed_year, DATA_COLUMNS),
    )
    joined = runs.join(metrics.drop("model_name"), "run_id")
    return rounded(joined, "metric_value").select(
        "model_name", "feature_table", "feature_version", "data_version",
        F.col("params")["smoothing"].alias("smoothing"), "metric_name", "metric_value",
    )


def tuning_sql() -> str:
    """Naive Bayes per smoothing and fold: trained on the other folds, weighted F1 on the fold."""
    ctes = (
        f"""folded AS (SELECT {KEY}, label, least(floor(('0x' || substr(md5('fold-0/' || series || '/' || issue), 1, 8))::UBIGINT
            / 4294967296.0 * 3), 2)::INTEGER AS fold FROM docs WHERE {TRAIN_YEAR} AND split = 'train')""",
        "grid AS (SELECT lam, CAST(i AS INTEGER) AS k FROM (VALUES (0.5::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) AS l(lam), range(3) AS f(i))",
        f"weights AS (SELECT f.*, v.term, v.x FROM folded f JOIN vec v USING ({KEY}))",
        """class_sums AS (SELECT r.k, c.class, v.term, coalesce(sum(w.x), 0) AS s
          FROM (SELECT DISTINCT k FROM grid) r CROSS JOIN (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) AS c(class) CROSS JOIN vocab v
          LEFT JOIN weights w ON w.term = v.term AND w.label = c.class AND w.fold <> r.k GROUP BY ALL)""",
        """logs AS (SELECT lam, k, class, term, ln(s + lam) - ln(sum(s) OVER w + lam * count(*) OVER w) AS theta
          FROM class_sums JOIN grid USING (k) WINDOW w AS (PARTITION BY lam, k, class))""",
        """ratios AS (SELECT lam, k, term, sum(CASE class WHEN 1 THEN theta ELSE -theta END) AS ratio FROM logs GROUP BY ALL)""",
        """priors AS (SELECT lam, k, ln(count(*) FILTER (label = 1) + lam) - ln(count(*) FILTER (label = 0) + lam) AS prior
          FROM grid JOIN folded ON fold <> k GROUP BY lam, k)""",
        f"""margins AS (SELECT p.lam, p.k, {', '.join('f.' + c for c in KEY.split(', '))}, f.label,
            any_value(prior) + coalesce(sum(w.x * r.ratio), 0) AS margin
          FROM priors p JOIN folded f ON f.fold = p.k
          LEFT JOIN weights w ON w.series = f.series AND w.issue = f.issue AND w.year = f.year AND w.paragraph_id = f.paragraph_id
          LEFT JOIN ratios r ON r.lam = p.lam AND r.k = p.k AND r.term = w.term GROUP BY ALL)""",
        "guesses AS (SELECT lam, k, label, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS guess FROM margins)",
        """by_class AS (SELECT g.lam, g.k, c.class, count(*) FILTER (label = c.class) AS support,
            coalesce(2 * count(*) FILTER (label = c.class AND guess = c.class)
              / nullif(count(*) FILTER (label = c.class) + count(*) FILTER (guess = c.class), 0), 0) AS f1
          FROM guesses g CROSS JOIN (VALUES (0), (1)) AS c(class) GROUP BY g.lam, g.k, c.class)""",
        "by_fold AS (SELECT lam, k, sum(f1 * support) / sum(support) AS f1 FROM by_class GROUP BY ALL)",
    )
    return with_ctes(
        *feature_ctes(TRAIN_YEAR), *ctes, select="SELECT lam AS smoothing, round(avg(f1), 6) AS f1 FROM by_fold GROUP BY lam"
    )


@query("tune_nb", tuning_sql)
def tune_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated F1 of every grid point, from folds that keep issues together."""
    train, _ = split_training(spark, vocabulary_features(spark, sf_dir))
    search = MD.tune("naive_bayes", train)
    points = [
        (float(list(params.values())[0]), float(f1))
        for params, f1 in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]
    return rounded(spark.createDataFrame(points, "smoothing double, f1 double"), "f1")


def _scored(spark: SparkSession, store: str, name: str) -> DataFrame:
    """Train on the training year, register and promote, then score every year with Production."""
    fitted, metrics, _ = MD.train_all(*split_training(spark, store), [name])
    models = scratch.fresh_path(spark, "models")
    for model, run_id in fitted.values():
        R.save_model(model, f"{models}/{run_id}")
    versions = R.promote(MD.candidate_versions(metrics, "classifier"))
    model, version = R.load_production_model(spark, versions, "classifier", models)
    scored = MD.score(model, spark.read.parquet(store), name, version)
    return rounded(scored, "prob_democrat", "prob_republican").drop("prediction_ts")


@query(
    "score_batch",
    lambda: with_ctes(
        *feature_ctes(TRAIN_YEAR), *BAYES,
        select=PREDICTED.replace(" FROM", ", 'naive_bayes' AS model_name, '1' AS model_version FROM"),
    ),
)
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, vocabulary_features(spark, sf_dir), "naive_bayes")


@query("score_batch_svc")
def score_batch_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, hashed_features(spark, sf_dir), "linear_svc")


@query(
    "eval_predictions",
    lambda: with_ctes(
        *feature_ctes(TRAIN_YEAR), *BAYES,
        select=PREDICTED.replace(" FROM", ", 'naive_bayes' AS model_name FROM") + f" WHERE {TRAIN_YEAR} AND split = 'test'",
    ),
)
def eval_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the test rows, saved and read back."""
    train, test = split_training(spark, vocabulary_features(spark, sf_dir))
    fitted, _, _ = MD.train_all(train, test, ["naive_bayes"])
    path = scratch.fresh_path(spark, "eval-predictions")
    model, run_id = fitted["naive_bayes"]
    tables.write_year(MD.score(model, test, "naive_bayes", run_id), path, ts_col="prediction_ts")
    stored = tables.load_predictions(spark, path).drop("prediction_ts", "model_version")
    return rounded(stored, "prob_democrat", "prob_republican")


@query("topic_share_by_year")
def topic_share_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(stored_processed(spark, sf_dir))
    return FT.topic_share_by_year(rows)


TOPICS, ROUNDS = 4, 2


def topic_sql() -> str:
    """Rounds of expectation and maximisation over (paragraph, term, topic)."""
    start = f"""1 + ('0x' || substr(md5('0/' || z || '/' || term), 1, 8))::UBIGINT / 4294967296.0"""
    ctes = [
        "numbered_docs AS (SELECT row_number() OVER () AS d, year, words FROM docs)",
        f"topic AS (SELECT CAST(z AS INTEGER) AS z FROM range({TOPICS}) AS r(z))",
        """counts AS MATERIALIZED (SELECT d, term, count(*) AS n FROM (SELECT d, unnest(words) AS term FROM numbered_docs)
          JOIN vocab USING (term) GROUP BY ALL)""",
        f"w0 AS (SELECT term, z, w / sum(w) OVER (PARTITION BY z) AS w FROM (SELECT term, z, {start} AS w FROM vocab, topic))",
        f"s0 AS (SELECT d, z, 1.0::DOUBLE / {TOPICS} AS s FROM numbered_docs, topic)",
    ]
    for i in range(ROUNDS):
        ctes += [
            f"""e{i} AS MATERIALIZED (SELECT d, term, z, n * w * s / sum(w * s) OVER (PARTITION BY d, term) AS e
              FROM counts JOIN w{i} USING (term) JOIN s{i} USING (d, z))""",
            f"w{i + 1} AS MATERIALIZED (SELECT term, z, sum(e) / sum(sum(e)) OVER (PARTITION BY z) AS w FROM e{i} GROUP BY term, z)",
            f"""s{i + 1} AS MATERIALIZED (SELECT d, z, coalesce(m.s, o.s) AS s FROM s{i} o LEFT JOIN
              (SELECT d, z, sum(e) / sum(sum(e)) OVER (PARTITION BY d) AS s FROM e{i} GROUP BY d, z) m USING (d, z))""",
        ]
    return with_ctes(
        *feature_ctes("true"), *ctes,
        select=f"SELECT year, z AS topic, round(avg(s), 6) AS share FROM s{ROUNDS} JOIN numbered_docs USING (d) GROUP BY ALL",
    )


@query("topic_shares_em", topic_sql)
def topic_shares_em(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic shares by year after two rounds, which SQL can follow; the operator's default is more rounds."""
    words = TM.tokenize(spark.read.parquet(stored_processed(spark, sf_dir)))
    shares, _ = TP.fit_topics(words, ["year"], topics=TOPICS, iterations=ROUNDS)
    return rounded(TP.share_by_year(shares), "share")
