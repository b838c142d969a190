"""TF-IDF vectors with Spark ML and the feature store."""

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex.functions.vectors import stored_indices, stored_values
from chronolex.operators.terms import MIN_DOC_FREQ, VOCABULARY_SIZE, stopword_remover, term_profile, tokenizer, vocabulary
from chronolex.sources.scratch import materialize
from chronolex.sources.tables import load_feature_model, save_feature_model, write_year

NUM_FEATURES = 262_144
INTERMEDIATE = ["words", "filtered_words", "rawFeatures"]


def feature_stages(
    vectorizer: str = "hashing_tf_idf",
    text_col: str = "cleaned_paragraph",
    output_col: str = "features",
    min_doc_freq: int = MIN_DOC_FREQ,
    num_features: int = NUM_FEATURES,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> Pipeline:
    """Tokenise, drop stop words, count (hashed, or by vocabulary for 'count_idf'), weigh by IDF."""
    if vectorizer == "count_idf":
        counts = CountVectorizer(
            inputCol="filtered_words",
            outputCol="rawFeatures",
            vocabSize=vocabulary_size,
            minDF=float(min_doc_freq),
        )
    else:
        counts = HashingTF(inputCol="filtered_words", outputCol="rawFeatures", numFeatures=num_features)
    idf = IDF(inputCol="rawFeatures", outputCol=output_col, minDocFreq=min_doc_freq)
    return Pipeline(stages=[tokenizer(text_col), stopword_remover(), counts, idf])


def _with_vocabulary(stages: Pipeline, train: DataFrame) -> Pipeline:
    """The same stages with the vocabulary already found.

    The vectorizer's own fit leaves equally frequent terms at the cut to chance. Here the term
    decides, so the features do not depend on the partitioning. At most `vocabSize` terms reach the
    driver, as they do in the vectorizer.
    """
    tokenize, remove, counts, *later = stages.getStages()
    terms = vocabulary(
        remove.transform(tokenize.transform(train)), min_doc_freq=int(counts.getMinDF()), size=counts.getVocabSize()
    )
    fixed = _vocabulary_model(
        train.sparkSession, [r["term"] for r in terms.collect()], inputCol=counts.getInputCol(), outputCol=counts.getOutputCol()
    )
    return Pipeline(stages=[tokenize, remove, fixed, *later])


def _vocabulary_model(spark: SparkSession, terms: list[str], **columns) -> CountVectorizerModel:
    """`CountVectorizerModel.from_vocabulary`, whose terms reach the JVM as one text instead of by a call each."""
    if not terms:
        return CountVectorizerModel.from_vocabulary(terms, **columns)
    jvm = spark.sparkContext._jvm
    array = jvm.org.apache.commons.lang3.StringUtils.splitByWholeSeparatorPreserveAllTokens("\0".join(terms), "\0")
    java_model = jvm.org.apache.spark.ml.feature.CountVectorizerModel(array)
    return CountVectorizerModel(java_model)._set(vocabSize=len(terms), **columns)


def _unfitted(train: DataFrame, **options) -> Pipeline:
    """The stages with all but the IDF being transformers."""
    stages = feature_stages(**options)
    return _with_vocabulary(stages, train) if options.get("vectorizer") == "count_idf" else stages


def fit_features(train: DataFrame, **options) -> PipelineModel:
    """Fit the stages; one pass for hashing, two for a vocabulary. Runs actions."""
    return _unfitted(train, **options).fit(train)


def fit_and_apply(
    train: DataFrame, without: tuple[str, ...] = (), **options
) -> tuple[PipelineModel, DataFrame]:
    """Fitted stages, and the features of the rows they were fitted on, without columns `without`.

    The counts are written once; the IDF is fitted on them and applied to them, so no text is tokenised again
    for that. Same stages and rows as `fit_features` and `apply_features`. Runs actions.
    """
    *front, idf = _unfitted(train, **options).getStages()
    counted = PipelineModel(front).transform(train).drop("words", "filtered_words", *without)
    kept = materialize(counted, "term-vectors")
    weights = idf.fit(kept)
    return PipelineModel([*front, weights]), apply_features(weights, kept)


def apply_features(model: PipelineModel, df: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    features = model.transform(df)
    return features.drop(*INTERMEDIATE) if drop_intermediate else features


def feature_frequencies(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """What fitted stages made of their data: (term, df), the term of a hashed feature being its bucket.

    Terms that are below the least document frequency count, those in no row of a hashed table do not.
    """
    vectorizer, idf = next(s for s in model.stages if hasattr(s, "vocabulary") or isinstance(s, HashingTF)), model.stages[-1]
    frequencies = np.asarray(idf.docFreq, dtype=np.int64)
    if hasattr(vectorizer, "vocabulary"):
        table = pd.DataFrame({"term": vectorizer.vocabulary, "df": frequencies})
    else:
        used = np.flatnonzero(frequencies)
        table = pd.DataFrame({"term": used.astype(str), "df": frequencies[used]})
    return spark.createDataFrame(table, "term string, df long")


def pad_label(df: DataFrame) -> DataFrame:
    """A typed NULL label where there is none."""
    return df if "label" in df.columns else df.withColumn("label", F.lit(None).cast("double"))


def store_training_features(
    processed: DataFrame, base_path: str, model_path: str | None = None, year: int | None = None,
    without: tuple[str, ...] = (), rebalance: bool = True, **options,
) -> PipelineModel:
    """Fit on the training year, store its features, and save the fitted stages.

    Columns `without` are not stored. `rebalance` as in `write_year`.
    """
    model, features = fit_and_apply(processed, without, **options)
    write_year(features, base_path, year, "feature_ts", rebalance=rebalance)
    if model_path:
        save_feature_model(model, model_path)
    return model


def store_inference_features(
    processed: DataFrame, base_path: str, model: PipelineModel | str, year: int | None = None,
    without: tuple[str, ...] = (), rebalance: bool = True,
) -> None:
    """Apply fitted stages (or those saved at a path) to other years and store the result."""
    fitted = load_feature_model(model) if isinstance(model, str) else model
    features = apply_features(fitted, pad_label(processed)).drop(*without)
    write_year(features, base_path, year, "feature_ts", rebalance=rebalance)


def topic_share_by_year(
    df: DataFrame,
    text_col: str = "cleaned_paragraph",
    k: int = 10,
    max_iter: int = 20,
    seed: int = 0,
    min_doc_freq: int = MIN_DOC_FREQ,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """Mean LDA topic weight per year. Runs actions (fit)."""
    counts = CountVectorizer(
        inputCol="filtered_words", outputCol="rawFeatures", vocabSize=vocabulary_size, minDF=float(min_doc_freq)
    )
    stages = Pipeline(stages=[tokenizer(text_col), stopword_remover(), counts])
    lda = LDA(featuresCol="rawFeatures", k=k, maxIter=max_iter, seed=seed)
    counted = _with_vocabulary(stages, df).fit(df).transform(df).select("year", "rawFeatures")
    # Each iteration draws its rows from all of them; without this it would read and count all texts anew.
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        topics = lda.fit(counted).transform(counted)
        weights = topics.select("year", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "weight"))
        return materialize(weights.groupBy("year", "topic").agg(F.avg("weight").alias("share")), "topic-shares")
    finally:
        counted.unpersist()


def bucket_dictionary(words: DataFrame, num_features: int = NUM_FEATURES, words_col: str = "filtered_words") -> DataFrame:
    """The bucket of every term: (term, bucket, tf, df), one row per distinct term, written once.

    Hashed vectors forget their terms; this table names them, and shows which terms share a bucket. Each
    distinct term is hashed once, by the vectorizer itself. An empty table has no terms. Runs an action.
    """
    profile = term_profile(words, [], words_col).withColumn("_word", F.array("term"))
    hashed = HashingTF(inputCol="_word", outputCol="_vector", numFeatures=num_features).transform(profile)
    return materialize(hashed.select("term", stored_indices(F.col("_vector"))[0].alias("bucket"), "tf", "df"), "buckets")


def bucket_collisions(dictionary: DataFrame) -> DataFrame:
    """Buckets that several terms share: how many, the most frequent one, and its share of the occurrences.

    Ties go to the smaller term. A bucket holds few of the distinct terms, so no list of them is built.
    """
    first = F.min_by("term", F.struct((-F.col("tf")).alias("tf"), "term"))
    grouped = dictionary.groupBy("bucket").agg(
        F.count("*").alias("terms"), first.alias("main_term"), F.max("tf").alias("main_tf"), F.sum("tf").alias("tf")
    )
    return grouped.filter(F.col("terms") > 1).select(
        "bucket", "terms", "main_term", (F.col("main_tf") / F.col("tf")).alias("main_share"), "tf"
    )


def vector_entries(features: DataFrame, keys: list[str], vector_col: str = "features") -> DataFrame:
    """Sparse vectors in long form: keys, bucket, weight, without the zeros. A NULL vector has no entries."""
    vector = F.col(vector_col)
    pairs = F.arrays_zip(stored_indices(vector).alias("bucket"), stored_values(vector).alias("weight"))
    return features.select(*keys, F.inline(pairs)).filter(F.col("weight") != 0.0)
