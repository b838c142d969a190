"""Document fingerprints as threshold-scaled sketches of shingle hashes. DataFrame functions only."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolex.sources.scratch import materialize

WIDTH = 5
# One of SCALE hashes is kept, whatever the length of the text.
SCALE = 16
DIGITS = 16
CHUNK_ROWS = 1_000_000
WHITE = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def threshold(scale: int = SCALE) -> str:
    """Hashes, as 16 hex digits, below it are kept."""
    return format(-(-(1 << 4 * DIGITS) // scale), f"0{DIGITS}x") if scale > 1 else "~"


def words(text: Column) -> Column:
    """Lower-case runs of other characters than white space `[\\x20\\x09-\\x0D]`."""
    trimmed = F.lower(F.trim(text, F.lit(WHITE)))
    return F.filter(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sketch(text: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """Sorted array of the distinct shingle hashes of `text` that lie below `threshold(scale)`.

    A shingle is `width` words joined by a space, or all words of a shorter text; its hash is the first 16
    hex digits of its MD5. Whether a hash is kept depends on nothing but the hash, so the sketch of a union
    is the union of sketches (`merge`), and a sketch grows with its text. A text none of whose hashes lies
    below keeps its smallest one, so that short texts have a sketch, too. No words, or NULL: an empty
    array. Only the places of kept shingles are held in memory, not all hashes.
    """

    def of(own: Column) -> Column:
        last = F.greatest(F.size(own) - F.lit(width), F.lit(0))
        places = F.sequence(F.lit(1), last + 1)
        hashed = lambda i: F.substring(F.md5(F.array_join(F.slice(own, i, F.lit(width)), " ")), 1, DIGITS)
        low = F.transform(F.filter(places, lambda i: hashed(i) < threshold(scale)), hashed)
        least = lambda kept: F.when(F.size(kept) > 0, F.array_sort(F.array_distinct(kept))).otherwise(
            F.array(F.array_min(F.transform(places, hashed)))
        )
        return F.when(F.size(own) > 0, _let(low, least)).otherwise(F.array().cast("array<string>"))

    return _let(words(F.coalesce(text, F.lit(""))), of)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of the shingles of both sides together."""

    def of(both: Column) -> Column:
        low = F.filter(both, lambda h: h < threshold(scale))
        return F.when((F.size(low) > 0) | (F.size(both) == 0), F.array_sort(low)).otherwise(F.array(F.array_min(both)))

    return _let(F.array_union(a, b), of)


def fingerprint(sketched: Column) -> Column:
    """The hashes of a sketch as one string, 16 hex digits each; empty for a text without words."""
    return F.array_join(sketched, "")


def hashes(printed: Column) -> Column:
    """The sketch of a fingerprint string."""
    places = F.sequence(F.lit(1), F.greatest(F.length(printed), F.lit(1)), F.lit(DIGITS))
    cut = F.transform(places, lambda i: F.substr(printed, i, F.lit(DIGITS)))
    return F.when(printed == "", F.array().cast("array<string>")).otherwise(cut)


def resemblance(a: Column, b: Column) -> Column:
    """Estimate of the shared among all distinct shingles of two texts; 1 for two without words."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def containment(a: Column, b: Column) -> Column:
    """Estimate of the share of a's distinct shingles that `b` has, however much longer `b` is; 1 if `a` has none."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)).cast("double") / F.size(a))


KEY = ["no_id", "id", "hash"]


def _takers(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Each distinct key with the row before it in descending order of ids, the first one's being the last.

    Rows are range-partitioned; a window runs inside each chunk, and the last rows of chunks, one each,
    say what lies before the next one. Chunk numbers are written, so a lost executor cannot change them.
    """
    session = rows.sparkSession
    chunks = max(int(session.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / chunk_rows))
    order = [F.col("no_id"), F.col("id").desc(), F.col("hash")]
    ranged = rows.repartitionByRange(chunks, *order).withColumn("chunk", F.spark_partition_id())
    chunked = materialize(ranged, "sketch-chunks")
    inside = Window.partitionBy("chunk").orderBy(*order)
    own = F.struct(*KEY, "half")
    walked = chunked.withColumns({"before": F.lag(own).over(inside), "after": F.lead(F.lit(1)).over(inside)})
    ends = walked.filter("after IS NULL").select("chunk", own.alias("end"))
    around = Window.orderBy("chunk")
    whole = Window.partitionBy(F.lit(1)).orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = ends.select("chunk", F.coalesce(F.lag("end").over(around), F.last("end").over(whole)).alias("head"))
    # One row per chunk.
    joined = walked.join(F.broadcast(heads), "chunk").withColumn("taker", F.coalesce("before", "head"))
    return joined.select(*KEY, *[F.col(f"taker.{c}").alias(f"to_{c}") for c in (*KEY, "half")])


def with_edits(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    scale: int = SCALE,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each text's sketch beside that of its edited text and of the next document.

    Per input row: id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch. The next document is
    the one with the next smaller id, and the largest after the smallest; in the edited text, the last
    floor(n_chars / 2) characters give way to as many of the next document's first ones, or all it has.
    NULL and empty texts have no characters and an empty sketch. Rows that repeat an id follow each other
    in order of a hash of their texts, rows that repeat id and text are each other's next; NULL ids come
    last. A single row is its own next document. An empty table gives no rows. Other columns are not looked
    at. Runs actions.

    Texts are shuffled once, by id; of each, the characters that its neighbour takes go there. Rows with
    equal id and text are one row with a count before that, so no such group meets in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType
    known = F.coalesce(F.col(id_col), F.lit("0").cast(kind))  # keys without NULLs join by plain equality
    rows = docs.select(F.col(id_col).isNull().alias("no_id"), known.alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    takers = _takers(materialize(rows.select(*KEY, half.alias("half")).distinct(), "sketch-ids"), chunk_rows)
    whole = rows.select(*KEY, F.struct("text", sketch(F.col("text"), width, scale).alias("sketch")).alias("own"))
    once = whole.groupBy(*KEY).agg(F.first("own").alias("own"), F.count("*").alias("copies"))
    # `copies` is looked at here only to have the same columns as below: the two plans share one shuffle.
    given = F.when(F.col("copies") > 0, F.substring(F.col("own.text"), F.lit(1), F.col("to_half")))
    following = F.struct(given.alias("start"), F.col("own.sketch").alias("sketch")).alias("following")
    sent = once.join(takers, KEY).select(*[F.col(f"to_{c}").alias(c) for c in KEY], following)
    length = F.length("own.text")
    itself = F.struct(F.substring(F.col("own.text"), F.lit(1), F.floor(length / 2).cast("int")).alias("start"), F.col("own.sketch").alias("sketch"))
    neighbours = F.array(
        F.struct(F.lit(1).cast("long").alias("times"), F.col("following")),
        F.struct((F.col("copies") - 1).alias("times"), itself.alias("following")),
    )
    paired = once.join(sent, KEY).select("no_id", "id", "own", F.explode(F.filter(neighbours, lambda f: f["times"] > 0)).alias("f"))
    kept = F.substring(F.col("own.text"), F.lit(1), length - F.floor(length / 2).cast("int"))
    edited = paired.select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col),
        length.cast("long").alias("n_chars"),
        F.concat(kept, "f.following.start").alias("edited"),
        "own.sketch",
        F.col("f.following.sketch").alias("next_sketch"),
        "f.times",
    )
    made = edited.select(
        id_col,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        sketch(F.col("edited"), width, scale).alias("edited_sketch"),
        "next_sketch",
        "times",
    )
    return made.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")


def near_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """`with_edits` as digests and estimates, one row per input row.

    id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (resemblance of
    the text to its edited text and to the next document), within_edited and within_next (share of the
    text's shingles that those have).
    """
    made = with_edits(docs, id_col, text_col, width, scale)
    return made.select(
        id_col,
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("within_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("within_next"),
    )
