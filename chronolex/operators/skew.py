"""Joins that stay even when a few keys hold most rows."""

from pyspark.sql import Column, DataFrame, functions as F

from chronolex.sources.scratch import materialize

# A key with more than 1/HOT_SHARE of all rows is hot: there are fewer than HOT_SHARE such keys.
HOT_SHARE = 10_000
BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Data size of `df` from its values; nested columns count by their text form. Runs one aggregate."""

    def width(column: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(column), F.lit(0))
        flat = not kind.startswith(("array", "map", "struct", "vector", "matrix", "variant"))
        # A number takes up to 8 bytes in memory and at least one character and a separator as text.
        return F.lit(0) if flat else 8 * F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))

    widths = [width(c, t) for c, t in df.dtypes]
    row = F.lit(16 * len(widths)).cast("long")
    for own in widths:
        row = row + own
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).head()[0]


def hot_keys(key_counts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Hot keys with the number of salts that brings each share down to 1/HOT_SHARE.

    Shares add up to one, so there are fewer than HOT_SHARE keys and 2 * HOT_SHARE salts: the
    result is safe to broadcast. It is written once. Runs an action.
    """
    total = key_counts.select(F.sum(count)).scalar()
    salts = F.ceil(F.col(count) * HOT_SHARE / total).cast("int")
    hot = key_counts.filter(F.col(count) * HOT_SHARE > total).select(*keys, salts.alias("_salts"))
    return materialize(hot, "hot-keys")


def join_even(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, key_counts: DataFrame | None = None
) -> DataFrame:
    """Shuffle join of `facts` with `lookup` (one row per key) that salts the hot keys.

    Rows of a hot key go to a salt by the hash of their content, which a retried task repeats;
    its lookup row is copied to each salt. `key_counts` (the keys and a count) may be passed if
    known. Runs actions.
    """
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_rows")) if key_counts is None else key_counts
    count = next(c for c in counts.columns if c not in keys)
    hot = F.broadcast(hot_keys(counts, keys, count))
    row_salt = F.pmod(F.xxhash64(*facts.columns), F.col("_salts")).cast("int")
    salted = (
        facts.join(hot, keys, "left")
        .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(row_salt))
        .drop("_salts")
    )
    last_salt: Column = F.coalesce("_salts", F.lit(1)) - 1
    copies = (
        lookup.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
        .drop("_salts")
    )
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def join_lookup(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join with a lookup table that is broadcast if its measured size allows, else `join_even`.

    The lookup should be a stored table, since it is read twice. Runs actions.
    """
    if measured_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), keys, how)
    return join_even(facts, lookup, keys, how)
