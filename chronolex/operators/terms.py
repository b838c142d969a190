"""Term statistics in long form: vocabulary, TF-IDF, vocabulary and feature drift."""

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolex.functions.text import WORD_CLASS
from chronolex.operators.skew import join_lookup
from chronolex.sources.scratch import materialize

MIN_DOC_FREQ = 5
VOCABULARY_SIZE = 50_000


def tokenizer(input_col: str, output_col: str = "words") -> RegexTokenizer:
    return RegexTokenizer(
        inputCol=input_col, outputCol=output_col, minTokenLength=1, pattern=f"[^{WORD_CLASS}]"
    )


def stopword_remover(input_col: str = "words", output_col: str = "filtered_words") -> StopWordsRemover:
    return StopWordsRemover(inputCol=input_col, outputCol=output_col)


def tokenize(df: DataFrame, input_col: str = "cleaned_paragraph") -> DataFrame:
    """Add `words` and `filtered_words`."""
    return stopword_remover().transform(tokenizer(input_col).transform(df))


def _idf(n: Column, df: Column, min_doc_freq: int) -> Column:
    return F.when(df >= min_doc_freq, F.log((n + 1) / (df + 1))).otherwise(F.lit(0.0))


def term_counts(df: DataFrame, keys: list[str], words_col: str = "filtered_words") -> DataFrame:
    """`tf` per key and term; counts combine before the shuffle."""
    exploded = df.select(*keys, F.explode(words_col).alias("term"))
    return exploded.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def term_profile(df: DataFrame, keys: list[str], words_col: str) -> DataFrame:
    """`tf` and `df` (rows holding the term) per key and term in one shuffle.

    Each row emits its words, then its distinct words, so no (row, term) table is shuffled; the place
    tells one from the other.
    """
    sized = df.select(*keys, F.col(words_col).alias("_words"), F.size(words_col).alias("_size"))
    both = F.posexplode(F.concat("_words", F.array_distinct("_words"))).alias("_place", "term")
    marked = sized.select(*keys, "_size", both)
    occurs = F.col("_place") < F.col("_size")
    return marked.groupBy(*keys, "term").agg(F.count_if(occurs).alias("tf"), F.count_if(~occurs).alias("df"))


def vocabulary(
    df: DataFrame,
    words_col: str = "filtered_words",
    min_doc_freq: int = MIN_DOC_FREQ,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """The `size` most frequent terms that occur in at least `min_doc_freq` rows, ties in term order.

    No task sorts all terms: terms are counted per frequency, a table as short as there are distinct
    frequencies; the frequency at which the vocabulary is full is read off it, more frequent terms are
    kept in place, and only terms of that very frequency are ranked. Runs actions.
    """
    profile = materialize(
        term_profile(df, [], words_col).filter(F.col("df") >= min_doc_freq), "term-profile"
    )
    by_frequency = profile.groupBy("tf").agg(F.count("*").alias("n"))
    more = Window.orderBy(F.col("tf").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        by_frequency.withColumn("before", F.coalesce(F.sum("n").over(more), F.lit(0)))
        .filter((F.col("before") < size) & (F.col("before") + F.col("n") >= size))
        .select("tf", "before")
        .head()
    )
    if cut is None:
        return profile
    above = profile.filter(F.col("tf") > cut["tf"])
    # Terms at the cut are ranked in range partitions, each of which knows how many come before it.
    at_cut = materialize(
        profile.filter(F.col("tf") == cut["tf"]).repartitionByRange("term").withColumn("_part", F.spark_partition_id()),
        "terms-at-cut",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = at_cut.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy("term")) + F.col("_offset")
    ranked = at_cut.join(F.broadcast(offsets), "_part").withColumn("_place", place)
    return above.unionByName(ranked.filter(F.col("_place") <= size - cut["before"]).select(*profile.columns))


def row_counts(words: Column) -> Column:
    """Array of (term, tf) of the words of one row, in term order, counted inside the row.

    Sorted words come in runs; a run is as long as the next one's start is away. NULL has no terms.
    """

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        places = F.filter(F.sequence(F.lit(0), n), lambda i: i < n)  # none in an empty row
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        ends = lambda first: F.concat(F.slice(first, 2, n), F.array(n))
        run = lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).cast("long").alias("tf"))
        counted = lambda first: F.zip_with(first, ends(first), run)
        return F.when(n > 0, let(starts, counted)).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))

    return let(F.sort_array(F.coalesce(words, F.array().cast("array<string>"))), runs)


def tfidf_terms(
    df: DataFrame, key: str, words_col: str = "filtered_words", min_doc_freq: int = MIN_DOC_FREQ
) -> DataFrame:
    """TF-IDF of every (document, term); `key` identifies a document, which is one row.

    Terms are counted inside the row, so no (document, term) table is shuffled to count it. Document
    frequencies are written once and broadcast if their measured size allows; beyond that, frequent terms
    are salted in the join, so a term that occurs in a third of all documents does not fill one task.
    Runs actions.
    """
    present = df.select(F.explode(F.array_distinct(words_col)).alias("term"))
    frequencies = materialize(present.groupBy("term").agg(F.count("*").alias("df")), "document-frequencies")
    n = df.select(F.count("*")).scalar()
    tf = df.select(key, F.inline(row_counts(F.col(words_col))))
    joined = join_lookup(tf, frequencies, ["term"], "inner").select(key, "term", "tf", "df")
    return joined.withColumn("tfidf", F.col("tf") * _idf(n, F.col("df"), min_doc_freq))


def _year_map(totals: DataFrame, value: str) -> Column:
    """One map year -> value from a table of few years, as a scalar subquery."""
    return totals.select(F.map_from_entries(F.collect_list(F.struct("year", value)))).scalar()


def _beside_reference(profile: DataFrame, ref_year: int, years: list[int], values: list[str]) -> DataFrame:
    """Full outer comparison of each year with the reference: `ref_*` and `cur_*`, 0 where a term is absent.

    Each term's years meet in one row as a map year -> counts, and are compared after the shuffle: what is
    shuffled are the (year, term) pairs that occur, not reference terms times years.
    """
    counts = F.collect_list(F.struct("year", F.struct(*values)))
    vectors = profile.groupBy("term").agg(F.map_from_entries(counts).alias("by_year"))
    of = lambda year: F.try_element_at(F.col("by_year"), year)
    reference = of(F.lit(ref_year))
    compared = F.filter(F.array(*[F.lit(y).cast("int") for y in years]), lambda y: reference.isNotNull() | of(y).isNotNull())
    zero = F.lit(0).cast("long")
    return vectors.select("term", reference.alias("ref"), "by_year", F.explode(compared).alias("year")).select(
        "year",
        "term",
        *[
            column
            for v in values
            for column in (
                F.coalesce(F.col(f"ref.{v}"), zero).alias(f"ref_{v}"),
                F.coalesce(of(F.col("year")).getField(v), zero).alias(f"cur_{v}"),
            )
        ],
    )


def vocabulary_drift(
    df: DataFrame,
    ref_year: int,
    years: list[int],
    words_col: str = "filtered_words",
    min_count: int = 1,
) -> DataFrame:
    """Term counts and shares of each year beside the reference year.

    All terms are compared; a larger `min_count` leaves out terms with fewer occurrences on both sides.
    """
    others = [y for y in years if y != ref_year]
    scope = df.filter(F.col("year").isin([ref_year, *others]))
    totals = _year_map(scope.groupBy("year").agg(F.sum(F.size(words_col)).alias("total")), "total")
    sides = _beside_reference(term_counts(scope, ["year"], words_col), ref_year, others, ["tf"])
    status = (
        F.when(F.col("ref_tf") == 0, "new").when(F.col("cur_tf") == 0, "gone").otherwise("kept")
    )
    return sides.filter(F.greatest("ref_tf", "cur_tf") >= min_count).select(
        "year",
        "term",
        "ref_tf",
        "cur_tf",
        (F.col("ref_tf") / totals[F.lit(ref_year)]).alias("ref_share"),
        (F.col("cur_tf") / totals[F.col("year")]).alias("cur_share"),
        status.alias("status"),
    )


def vocabulary_drift_summary(drift: DataFrame) -> DataFrame:
    """New, gone and kept terms per year, and their Jaccard similarity."""

    def terms(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return drift.groupBy("year").agg(
        terms("new").alias("new_terms"),
        terms("gone").alias("gone_terms"),
        terms("kept").alias("kept_terms"),
        (terms("kept") / F.count("*")).alias("jaccard"),
    )


def feature_drift(
    df: DataFrame,
    ref_year: int,
    years: list[int],
    words_col: str = "filtered_words",
    min_doc_freq: int = MIN_DOC_FREQ,
) -> DataFrame:
    """Mean TF-IDF per term and year (absent = 0) against the reference year, whose idf is used.

    The mean over a year is idf * (occurrences / rows), so no per-document table is needed. Terms
    under `min_doc_freq` in the reference year, new ones among them, have weight 0.
    """
    others = [y for y in years if y != ref_year]
    scope = df.filter(F.col("year").isin([ref_year, *others]))
    rows = _year_map(scope.groupBy("year").agg(F.count("*").alias("n")), "n")
    sides = _beside_reference(term_profile(scope, ["year"], words_col), ref_year, others, ["tf", "df"])
    n_ref = rows[F.lit(ref_year)]
    idf = _idf(n_ref, F.col("ref_df"), min_doc_freq)
    means = sides.select(
        "year",
        "term",
        (idf * F.col("ref_tf") / n_ref).alias("ref_mean"),
        (idf * F.col("cur_tf") / rows[F.col("year")]).alias("cur_mean"),
    )
    return means.withColumn("difference", F.col("cur_mean") - F.col("ref_mean"))


def feature_drift_l1(drift: DataFrame) -> DataFrame:
    return drift.groupBy("year").agg(F.sum(F.abs("difference")).alias("l1"), F.count("*").alias("terms"))


def top_terms_by_class(
    df: DataFrame,
    label_col: str = "label",
    words_col: str = "filtered_words",
    positive: float = 1.0,
    negative: float = 0.0,
    top: int = 20,
) -> DataFrame:
    """Add-one log-odds of term counts between two classes; the `top` terms of each side."""
    scope = df.filter(F.col(label_col).isin([positive, negative]))
    counts = (
        scope.select(label_col, F.explode(words_col).alias("term"))
        .groupBy("term")
        .agg(
            F.count_if(F.col(label_col) == positive).alias("a"),
            F.count_if(F.col(label_col) == negative).alias("b"),
        )
    )
    sizes = counts.select(
        F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("v"))
    ).scalar()
    odds = F.log((F.col("a") + 1) / (sizes["a"] + sizes["v"])) - F.log(
        (F.col("b") + 1) / (sizes["b"] + sizes["v"])
    )
    scored = counts.withColumn("log_odds", odds)
    # Two bounded top-k reports, each kept small per task before anything is merged.
    high = scored.orderBy(F.col("log_odds").desc(), "term").limit(top).withColumn("label", F.lit(positive))
    low = scored.orderBy(F.col("log_odds"), "term").limit(top).withColumn("label", F.lit(negative))
    return high.unionByName(low).select("label", "term", "a", "b", "log_odds")
