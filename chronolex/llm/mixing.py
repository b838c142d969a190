"""Mixing sources to target weights by hash thresholds. DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolex.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# The hash of a document is cut into LEVELS digits of DIGIT_BITS bits each.
DIGIT_BITS = 10
LEVELS = 6


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds `target` to one row per source (`source`, `source_size`).

    Sources in code point order, NULL last, weigh `weights` in turn and share the sum of all sizes; a
    target stops at `max_repeats` times its source's size, and the excess is shared anew by weight.
    Sharing anew until none is above has a closed form: with sources ordered by limit per weight, a
    first run of them is at its limit and the others have one rate, words per weight. The windows see
    one row per source, not documents.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(number, F.lit(len(weights))) + 1)
    limit = F.col("source_size") * float(max_repeats)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(1))
    rated = (
        sizes.withColumns({"weight": weight, "limit": limit})
        .withColumn("rate", (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("free", F.col("rate") * F.col("weight") <= F.col("limit"))
    )
    # The first source whose share stays within its limit sets the rate for itself and all after it.
    rate = F.min_by(F.when(F.col("free"), F.col("rate")), F.when(F.col("free"), F.col("limit") / F.col("weight")))
    return rated.withColumn("common", rate.over(everywhere)).select(
        "source",
        "source_size",
        F.least(F.col("limit"), F.coalesce(F.col("common") * F.col("weight"), F.col("limit"))).alias("target"),
    )


def _digit(level: int) -> Column:
    return F.shiftrightunsigned(F.col("hash"), 64 - DIGIT_BITS * (level + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def thresholds(docs: DataFrame, by_source: DataFrame) -> DataFrame:
    """Adds `repeats` and `bound` to one row per source.

    Every document is taken `repeats` times, whole rounds of the target, and once more if the leading
    `DIGIT_BITS * LEVELS` bits of its hash are below `bound`. Level by level, the words of each
    source are summed by the next digit of the hash; buckets below the boundary bucket are taken and
    only the boundary bucket is looked at by the next level. After the last level the boundary bucket
    is one hash value, which is taken if that brings the source closer to its target. A larger target
    takes all that a smaller one takes. Runs actions.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = by_source.withColumn("repeats", rounds.cast("long")).withColumns(
        {"left": F.col("target") - F.col("repeats") * F.col("source_size"), "prefix": F.lit(0).cast("long")}
    )
    names = state.columns
    for level in range(LEVELS):
        state = materialize(state, "mix-thresholds")
        prefix = F.shiftrightunsigned(F.col("hash"), 64 - DIGIT_BITS * level) if level else F.lit(0).cast("long")
        side = state.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
        inside = docs.join(side, F.col("source").eqNullSafe(F.col("_source")) & (prefix == F.col("_prefix")))
        histogram = inside.groupBy("source", _digit(level).alias("digit")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = histogram.withColumn("upto", F.sum("words").over(upto)).withColumnRenamed("source", "_source")
        # The boundary is the first bucket that does not fit whole; if all fit, the one after the last.
        cut = state.join(summed, F.col("source").eqNullSafe(F.col("_source")), "left").groupBy(*names)
        fits = F.col("upto") <= F.col("left")
        cut = cut.agg(
            F.min(F.when(~fits, F.col("digit"))).alias("boundary"),
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("below"),
            F.min_by(F.when(~fits, F.col("words")), F.when(~fits, F.col("digit"))).alias("words"),
        )
        last = level == LEVELS - 1
        # Nothing lies beyond a level in which all fit: its end is a bound too.
        here = F.coalesce(F.col("boundary"), F.lit(1 << DIGIT_BITS))
        left = F.col("left") - F.col("below")
        step = F.when(F.col("words") - left < left, 1).otherwise(0) if last else F.lit(0)
        bound = F.col("prefix") * (1 << DIGIT_BITS) + here + F.when(F.col("boundary").isNotNull(), step).otherwise(0)
        state = cut.withColumns({"_bound": bound.cast("long"), "_left": left}).select(
            *[c for c in names if c not in ("left", "prefix")], F.col("_left").alias("left"), F.col("_bound").alias("prefix")
        )
    return materialize(
        state.select("source", "source_size", "target", "repeats", F.col("prefix").alias("bound")), "mix-thresholds"
    )


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"),
    )


def _copies(max_repeats: int) -> Column:
    leading = F.shiftrightunsigned(F.col("hash"), 64 - DIGIT_BITS * LEVELS)
    return F.least(F.col("repeats") + F.when(leading < F.col("bound"), 1).otherwise(0), F.lit(max_repeats)).cast("long")


def _chosen(rows: DataFrame, weights: tuple, max_repeats: int) -> DataFrame:
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return thresholds(rows, targets(sizes, weights, max_repeats)).withColumnRenamed("source", "_source")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies, taken.

    `copies` is how often the mix holds the row, `taken` the words that makes. NULL sources are one
    source, ordered last; NULL and empty texts have size zero and follow their hash like any other
    row, in a source without any words each row is taken once. Rows that agree in id and text have one
    hash, hence one fate. Hashes depend on id and text only, so reruns agree. An empty table gives no
    rows. Other columns are not looked at. Runs actions.
    """
    rows = materialize(_rows(docs, id_col, text_col, source_col), "mix-sizes")
    chosen = _chosen(rows, weights, max_repeats)
    return (
        rows.join(chosen, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", _copies(max_repeats))
        .select(
            F.col("id").alias(id_col),
            F.col("source").alias(source_col),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """The mix itself: each input row, with its columns, as often as `mixed` says.

    Only thresholds, one row per source, are joined to the documents, so texts are not shuffled
    unless there are more sources than may be broadcast. Runs actions.
    """
    chosen = _chosen(materialize(_rows(docs, id_col, text_col, source_col), "mix-sizes"), weights, max_repeats)
    kept = [F.col(f"_row.{c}").alias(c) for c in docs.columns]
    whole = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col(source_col).alias("_own_source"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"),
    )
    joined = whole.join(chosen, F.col("_own_source").eqNullSafe(F.col("_source")))
    repeated = joined.withColumn("_copies", _copies(max_repeats)).filter("_copies > 0")
    return repeated.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*kept)
