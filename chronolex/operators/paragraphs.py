"""Articles to numbered, cleaned paragraphs."""

from pyspark.sql import DataFrame, functions as F

from chronolex import schema
from chronolex.functions import text as T
from chronolex.operators.running import running_sums
from chronolex.operators.skew import BROADCAST_BYTES, join_lookup
from chronolex.sources.articles import label_metadata

ISSUE_YEAR = ["series", "issue", "year"]


def with_year(articles: DataFrame) -> DataFrame:
    return articles.withColumn("year", F.year("date").cast("int"))


def label_articles(
    articles: DataFrame,
    metadata: DataFrame,
    train_labels: list[float] | None = None,
    train_year: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Articles with metadata, label and year, joined on `series`.

    `metadata` has one row per series. With `train_labels` only those labels stay, in `train_year` if
    one is given, else in all years; without, every labelled article does. The metadata is broadcast when its measured size
    allows; otherwise series with many articles are salted. Runs actions.
    """
    labels = metadata
    if train_labels is not None and train_year is None:
        labels = labels.filter(F.col("label").isin(train_labels))
    joined = with_year(join_lookup(articles, labels, ["series"], "inner", broadcast_bytes))
    if train_labels is not None and train_year is not None:
        joined = joined.filter((F.col("year") != train_year) | F.col("label").isin(train_labels))
    return joined


def ingest(
    articles: DataFrame,
    metadata: DataFrame,
    delimiter: str = schema.TAG_DELIMITER,
    labels: dict[str, float] | None = None,
    train_labels: list[float] | None = None,
    train_year: int | None = None,
) -> DataFrame:
    """Raw articles and raw metadata to labelled articles. Runs actions."""
    return label_articles(articles, label_metadata(metadata, delimiter, labels), train_labels, train_year)


def explode_paragraphs(articles: DataFrame, separator: str = schema.PARAGRAPH_SEPARATOR) -> DataFrame:
    """One row per paragraph with its position `pos` in the article; NULL text gives none."""
    others = [c for c in articles.columns if c != "text"]
    return articles.select(
        *others, F.posexplode(T.split_paragraphs(F.col("text"), separator)).alias("pos", "text")
    )


def paragraph_offsets(
    articles: DataFrame,
    separator: str = schema.PARAGRAPH_SEPARATOR,
    group_cols: list[str] = ISSUE_YEAR,
    order_cols: tuple[str, ...] = ("date", "article_id"),
) -> DataFrame:
    """Paragraphs before each article within its issue: one slim row per article. Runs actions."""
    counts = articles.filter(F.col("text").isNotNull()).select(
        *group_cols,
        *order_cols,
        F.size(T.split_paragraphs(F.col("text"), separator)).cast("long").alias("n"),
    )
    running = running_sums(counts, group_cols, [F.col(c) for c in order_cols], ["n"])
    return running.select("article_id", (F.col("cum_n") - F.col("n")).alias("_offset"))


def number_paragraphs(exploded: DataFrame, offsets: DataFrame) -> DataFrame:
    """`paragraph_id` = 1..n within (series, issue, year), running on across articles.

    Joined on the unique `article_id`, so no key is hot and only surviving paragraphs are shuffled.
    """
    return (
        exploded.join(offsets, "article_id", "inner")
        .withColumn("paragraph_id", (F.col("_offset") + F.col("pos") + 1).cast("long"))
        .drop("_offset", "pos")
    )


def split_into_paragraphs(
    articles: DataFrame,
    separator: str = schema.PARAGRAPH_SEPARATOR,
) -> DataFrame:
    """Numbered paragraphs. Needs `year` and a unique `article_id`. Runs actions."""
    offsets = paragraph_offsets(articles, separator)
    return number_paragraphs(explode_paragraphs(articles, separator), offsets)


def clean_paragraphs(
    paragraphs: DataFrame,
    min_word_len: int = schema.MIN_WORD_LENGTH,
    min_para_words: int = schema.MIN_PARAGRAPH_WORDS,
    stopwords: list[str] | None = None,
) -> DataFrame:
    """Add `cleaned_paragraph` and keep rows with strictly more than `min_para_words` words."""
    cleaned = T.clean_text(F.col("text"), min_word_len, stopwords)
    return (
        paragraphs.withColumn("cleaned_paragraph", cleaned)
        .filter(T.word_count(F.col("cleaned_paragraph")) > min_para_words)
    )


def transform(
    articles: DataFrame,
    separator: str = schema.PARAGRAPH_SEPARATOR,
    min_word_len: int = schema.MIN_WORD_LENGTH,
    min_para_words: int = schema.MIN_PARAGRAPH_WORDS,
    stopwords: list[str] | None = None,
) -> DataFrame:
    """Labelled articles of one or many years to processed paragraphs.

    Short paragraphs are dropped before the numbering join. Runs actions.
    """
    offsets = paragraph_offsets(articles, separator)
    others = [c for c in articles.columns if c != "text"]
    # Cleaned inside the array: a filter on a column of the exploded struct reuses the tokens, while a
    # filter on a projected expression would run the cleaning a second time. Only survivors are joined to a text.
    pairs = F.transform(
        T.split_paragraphs(F.col("text"), separator),
        lambda p: F.struct(p.alias("text"), T.clean_tokens(p, min_word_len, stopwords).alias("tokens")),
    )
    # The empty paragraph counts one word, as in `word_count`.
    words = F.greatest(F.size("pair.tokens"), F.lit(1))
    survivors = (
        articles.select(*others, F.posexplode(pairs).alias("pos", "pair"))
        .filter(words > min_para_words)
        .select(*others, "pos", "pair.text", F.array_join("pair.tokens", " ").alias("cleaned_paragraph"))
    )
    return number_paragraphs(survivors, offsets)


def cap_paragraphs(paragraphs: DataFrame, max_tokens: int = schema.MAX_PARAGRAPH_TOKENS) -> DataFrame:
    return paragraphs.withColumn("text", T.cap_tokens(F.col("text"), max_tokens))
