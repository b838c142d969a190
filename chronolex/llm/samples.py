"""Bounded samples of labelled rows to train on."""

from pyspark.sql import Column, DataFrame, Window, functions as F

FOLDS = 5
# A label's rows are ranked in so many parts, whose first rows are ranked together.
PARTS = 64


def held_out(id_col: str = "doc_id") -> Column:
    """True for ids that no label is learned from: crc32 of the id as text is divisible by FOLDS."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int, characters: int
) -> list:
    """At most `per_label` training rows (id, label, text) of each label, one per id, the same on each run.

    Rows are taken in order of a hash of the id, all labels in one pass: each task keeps the first
    `per_label` of a label before rows are shuffled, so neither the labels nor the texts are gathered,
    however hot a label is. Texts are cut to `characters`. Both bounds apply to training
    only. A document with several labels takes the
    largest. Empty tables give no rows; other columns, whatever their names, are not looked at. Runs actions.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    own = own.filter(F.col("_label").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id")).distinct()
    order = [F.xxhash64("_id"), F.col("_id")]
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) <= per_label
    parts = own.withColumn("_part", F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(PARTS)))
    in_part = parts.withColumn("_first", first("_label", "_part")).filter("_first")
    chosen = in_part.withColumn("_first", first("_label")).filter("_first").select("_id", "_label").collect()
    if not chosen:
        return []
    picked = docs.sparkSession.createDataFrame(chosen, own.schema).groupBy("_id").agg(F.max("_label").alias("_label"))
    narrow = docs.select(
        F.col(id_col).alias("_id"), F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, characters).alias("_text")
    )
    texts = narrow.join(F.broadcast(picked), "_id")
    # One text of an id, however many rows repeat it.
    first = F.min_by("_text", F.struct(F.xxhash64("_text"), F.col("_text"))).alias("_text")
    return sorted(tuple(r) for r in texts.groupBy("_id", "_label").agg(first).collect())
