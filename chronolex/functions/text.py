"""Text expressions. Everything stays in the JVM; there is no Python worker."""

from pyspark.sql import Column, functions as F

from chronolex import schema

# Unicode letters and digits plus underscore; Java's \w alone is ASCII.
WORD_CLASS = r"\p{L}\p{N}_"


def clean_tokens(
    text: Column,
    min_word_len: int = schema.MIN_WORD_LENGTH,
    stopwords: list[str] | None = None,
) -> Column:
    """Lowercased tokens of a paragraph without symbols, short words and stop words.

    Words of 1..min_word_len characters go; commas stay glued to their neighbours, so a stop word
    next to a comma is kept. NULL and blank text give an empty array.
    """
    words = schema.STOPWORDS if stopwords is None else stopwords
    # One regex pass turns every run of other characters (line breaks included) into one blank.
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{WORD_CLASS},]+", " ")
    glued = F.replace(F.replace(spaced, F.lit(" ,"), F.lit(",")), F.lit(", "), F.lit(","))

    def has_comma(token: Column) -> Column:
        return F.contains(token, F.lit(","))

    def kept(token: Column) -> Column:
        long_enough = F.char_length(token) > min_word_len
        return has_comma(token) | (long_enough & ~F.lower(token).isin(words) if words else long_enough)

    def without_short_words(token: Column) -> Column:
        # Possessive runs take whole words: long ones are put back, short ones vanish.
        pattern = f"([{WORD_CLASS}]{{{min_word_len + 1},}}+)|[{WORD_CLASS}]{{1,{min_word_len}}}+"
        return F.regexp_replace(token, pattern, "$1") if min_word_len > 0 else token

    # Most tokens are plain words, for which a length test does; only glued ones need the regex.
    return F.transform(
        F.filter(F.split(glued, " "), kept),
        lambda w: F.lower(F.when(has_comma(w), without_short_words(w)).otherwise(w)),
    )


def clean_text(
    text: Column,
    min_word_len: int = schema.MIN_WORD_LENGTH,
    stopwords: list[str] | None = None,
) -> Column:
    """`clean_tokens` joined by single blanks; NULL and blank text give ''."""
    return F.array_join(clean_tokens(text, min_word_len, stopwords), " ")


def word_count(cleaned: Column) -> Column:
    """Tokens of a cleaned paragraph; the empty paragraph counts one, as a split would."""
    return F.size(F.split(cleaned, r"\s+"))


def split_paragraphs(text: Column, separator: str = schema.PARAGRAPH_SEPARATOR) -> Column:
    """Array of paragraphs; `separator` is a regular expression, trailing blanks are kept."""
    return F.split(text, separator, -1)


def cap_tokens(text: Column, max_tokens: int = schema.MAX_PARAGRAPH_TOKENS) -> Column:
    """First `max_tokens` blank-separated tokens."""
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, max_tokens), " ")
