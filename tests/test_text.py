import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from chronolex import schema
from chronolex.functions import text as T
from chronolex.operators import paragraphs as P, terms as TM
from conftest import plan_of

EDGE = [
    ("A,B ,  C bigger,the house which, which", ",, bigger, house which,which"),
    ("a ét snake_case x²y cafés, the,which whichever", "snake_case cafés,,which whichever"),
    (None, ""),
    ("", ""),
    ("  \n ", ""),
]


@pytest.mark.parametrize("raw,expected", EDGE)
def test_edge_rows(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "text string")
    assert df.select(T.clean_text(F.col("text"))).head()[0] == expected


def is_word(c):
    return c.isalnum() or c == "_"


def by_hand(text, shortest, stopwords):
    """Cleaning one character at a time, with no regular expression."""
    kept = "".join(c if is_word(c) or c == "," else " " for c in text)
    out = []
    for token in ",".join(" ".join(part.split()) for part in kept.split(",")).split(" "):
        pieces = [p if len(p) > shortest else "" for p in token.split(",")]
        joined = ",".join(pieces).lower()
        if joined and joined not in stopwords:
            out.append(joined)
    return " ".join(out)


@pytest.mark.parametrize("shortest", [0, 2, 4])
def test_cleaning_by_hand_on_whole_texts(spark, sf, shortest):
    words = schema.STOPWORDS
    lines = spark.read.parquet(f"{sf}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("text"))
    extra = spark.createDataFrame(
        [(" , a,, b ,c, ",), ("word glued\tby,  spaces",), ("1 22 333 4444 55555, 666666",), ("naïve Straße ÉTÉ",)],
        "text string",
    )
    rows = lines.union(extra).withColumn("c", T.clean_text(F.col("text"), shortest)).collect()
    assert len(rows) > 1000
    for r in rows:
        assert r["c"] == by_hand(r["text"], shortest, set(words)), r["text"]


# Letters whose lower case has the same length, digits, joiners, blanks, marks and symbols.
ALPHABET = "abWXéÜñßжλ中9²_,,,  \t\n-'.’—\u00a0\u0301\U0001f600"
WORDS = st.sampled_from(["which", "Their", "about", "whichever", "house", "a", "the"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.one_of(st.text(ALPHABET, max_size=9), WORDS, st.just(" ")), max_size=12), min_size=40, max_size=80))
def test_cleaning_by_hand_on_random_texts(spark, pieces):
    texts = ["".join(p) for p in pieces]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    stopwords = set(schema.STOPWORDS)
    for r in df.withColumn("c", T.clean_text(F.col("text"))).collect():
        assert r["c"] == by_hand(r["text"], 4, stopwords), repr(r["text"])


def test_stopwords_can_be_replaced(spark):
    df = spark.createDataFrame([("alpha bravo charlie",)], "text string")
    assert df.select(T.clean_text(F.col("text"), 4, ["bravo"])).head()[0] == "alpha charlie"
    assert df.select(T.clean_text(F.col("text"), 4, [])).head()[0] == "alpha bravo charlie"


def test_word_count_of_empty_is_one(spark):
    df = spark.createDataFrame([("",), ("a b",)], "c string")
    assert [r[0] for r in df.select(T.word_count(F.col("c"))).collect()] == [1, 2]


@pytest.mark.parametrize(
    "text,expected", [("a\n\nb\n\n", ["a", "b", ""]), ("a\n\n\nb", ["a", "\nb"]), (None, [])]
)
def test_split_paragraphs(spark, text, expected):
    articles = spark.createDataFrame(
        [("s", "1", 1869, None, 1, text)], "series string, issue string, year int, date date, article_id long, text string"
    )
    rows = P.split_into_paragraphs(articles).orderBy("paragraph_id").collect()
    assert [r["text"] for r in rows] == expected
    assert [r["paragraph_id"] for r in rows] == list(range(1, len(expected) + 1))


def test_min_words_is_strict(spark):
    df = spark.createDataFrame([("alpha bravo",), ("alpha bravo charlie",)], "text string")
    kept = P.clean_paragraphs(df, min_para_words=2).collect()
    assert [r["cleaned_paragraph"] for r in kept] == ["alpha bravo charlie"]


def test_cap_tokens(spark):
    df = spark.createDataFrame([("a b  c d",)], "text string")
    assert P.cap_paragraphs(df, 3).head()["text"] == "a b c"


def test_terms_are_counted_in_the_row(spark):
    rows = [(1, ["b", "a", "b", "c", "a", "b"]), (2, []), (3, None), (4, ["é"]), (5, ["z"] * 300)]
    df = spark.createDataFrame(rows, "k int, w array<string>")
    got = {r["k"]: [tuple(e) for e in r["c"]] for r in df.select("k", TM.row_counts(F.col("w")).alias("c")).collect()}
    assert got == {1: [("a", 2), ("b", 3), ("c", 1)], 2: [], 3: [], 4: [("é", 1)], 5: [("z", 300)]}


def test_tfidf_shuffles_no_documents(spark):
    rows = [(i, ["common", f"w{i % 7}", "common"]) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, filtered_words array<string>")
    made = TM.tfidf_terms(df, "k", min_doc_freq=1)
    main = plan_of(made).split("Subqueries")[0]  # the subquery counts all rows
    assert "BroadcastExchange" in main and not re.search(r"\) Exchange|SortMergeJoin|hashpartitioning", main)
    assert {(r["term"], r["tf"], r["df"]) for r in made.collect() if r["k"] == 3} == {("common", 2, 40), ("w3", 1, 6)}


def test_years_of_a_term_meet_in_one_row(spark):
    """Shuffled rows are the (year, term) pairs that occur, however many years are compared."""
    rows = [(1869, ["old", "both", "both"]), (1870, ["both", "new"]), (1871, ["old"])]
    df = spark.createDataFrame(rows, "year int, filtered_words array<string>")
    years = list(range(1870, 2020))
    drift = TM.vocabulary_drift(df, 1869, years)
    tree = plan_of(drift).split("Subqueries")[0].split("(1) Scan")[0]
    assert tree.index("Generate") < tree.index("Exchange")  # years are spread out above the last shuffle
    found = {(r["year"], r["term"]): (r["ref_tf"], r["cur_tf"], r["status"]) for r in drift.collect()}
    assert found[1870, "both"] == (2, 1, "kept") and found[1870, "new"] == (0, 1, "new") and found[1870, "old"] == (1, 0, "gone")
    assert found[1871, "old"] == (1, 1, "kept") and (1871, "new") not in found
    assert len(found) == 2 * len(years) + 1  # two reference terms in every year, one new term
