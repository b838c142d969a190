"""Exact duplicates by most-significant-digit radix partitioning of the text's bytes."""

from pyspark.sql import Column, DataFrame, functions as F

from chronolex.sources.scratch import materialize

# Bytes that the first level looks at; each further level looks at GROWTH times as many.
FIRST_DIGIT = 64
GROWTH = 8
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _split(level: DataFrame, width: int, depth: int) -> DataFrame:
    """Split every group by its next `width` bytes.

    The result has `grp` NULL for documents that are now alone, and `rest` NULL for those that are
    done: alone, or in a group that has ended, which is one whose last digit was not full.
    """
    digit = F.substring("rest", 1, width)
    # A group with two members or more gets a number; the table is written, so numbers stay.
    groups = (
        level.groupBy("grp", digit.alias("digit"))
        .agg(F.count("*").alias("members"))
        .filter("members > 1")
        .select("grp", "digit", (F.monotonically_increasing_id() * 64 + depth).alias("next"))
    )
    groups = materialize(groups, "radix-groups").withColumnsRenamed({"grp": "old", "digit": "prefix"})
    goes_on = F.col("next").isNotNull() & (F.length("prefix") == width)
    return level.join(
        groups.hint("shuffle_hash"), (F.col("grp") == F.col("old")) & (digit == F.col("prefix")), "left"
    ).select(
        "id", "points", "sha", F.col("next").alias("grp"), F.when(goes_on, F.expr(f"substring(rest, {width + 1})")).alias("rest")
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = FIRST_DIGIT,
    growth: int = GROWTH,
) -> DataFrame:
    """(id, points, sha, grp) per row: rows with the same `grp` have equal normalised texts, NULL is alone.

    Level by level, each group is split by the next digit of the UTF-8 bytes. A digit is a byte string
    whose width grows with the level, so long copies end after few levels. Digits are counted with
    map-side sums; a group that holds a third of all rows is one counted row, and the join that hands
    out group numbers streams its rows past that one row, which adaptive execution may cut anywhere.
    Only groups with two members or more keep their bytes for the next level. Equality rests on the
    bytes alone; the digest in the result is a label. Runs actions.
    """
    text = normalized(F.col(text_col))
    level = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("points"),
        F.sha2(text, 256).alias("sha"),
        F.lit(0).cast("long").alias("grp"),
        text.cast("binary").alias("rest"),
    )
    done, width, depth = None, first_digit, 0
    while True:
        level = materialize(_split(level, width, depth), "radix-level")
        ended = level.filter("rest IS NULL").drop("rest")
        done = ended if done is None else done.unionByName(ended)
        level = level.filter("rest IS NOT NULL")
        if level.isEmpty():
            return done
        width, depth = width * growth, depth + 1


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without white space (`[\\x20\\x09-\\x0D]`); NULL counts as
    empty, and empty texts are equal. The row with the most code points in its original text stays,
    then the smallest id; NULL ids come last. Rows that repeat an id count as documents of their own
    in `group_size`; if such rows tie for first place, each is marked kept. An empty table gives no
    rows. Other columns are not looked at. Runs actions.
    """
    rows = exact_groups(docs, id_col, text_col)
    order = F.struct(F.col("points"), F.col("id").isNotNull(), -F.col("id"))
    best = (
        rows.filter("grp IS NOT NULL")
        .groupBy("grp")
        .agg(
            F.max_by("id", order).alias("keep_id"),
            F.max("points").alias("most"),
            F.count("*").alias("group_size"),
        )
    )
    members = rows.filter("grp IS NOT NULL").join(best, "grp")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))
    alone = rows.filter("grp IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    both = members.select("id", "keep_id", "group_size", kept.alias("kept"), "sha").unionByName(alone)
    return both.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
