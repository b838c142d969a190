"""Running sums over groups of any size."""

import math

from pyspark.sql import DataFrame, Window, functions as F

from chronolex.sources.scratch import materialize

# Rows that one chunk holds at most, about: what one task sorts comfortably.
CHUNK_ROWS = 1_000_000


def running_sums(
    df: DataFrame, group_cols: list[str], order_cols: list, value_cols: list[str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add inclusive running sums `cum_<value>` and group totals `total_<value>`.

    `order_cols` (columns, possibly descending) must order each group without ties. The input is
    written to the shared folder once. Rows are range-partitioned by group and order, so even one
    group holding most rows is cut into even chunks: a window runs inside each chunk, and chunk totals
    (one row per group and chunk) give the offsets. The chunk numbers are written too, so a lost
    executor cannot change them. Runs actions.
    """
    base = materialize(df, "running-input")
    group = [F.col(c) for c in group_cols]
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    # Enough chunks that each stays near the size one task handles, however large the input is.
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(usual, math.ceil(base.count() / chunk_rows))
    ranged = base.repartitionByRange(chunks, *group, *order_cols)
    chunked = materialize(ranged.withColumn("_chunk", F.spark_partition_id()), "running-chunks")
    keys = [*group_cols, "_chunk"]
    totals = chunked.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{c}") for c in value_cols])
    whole = Window.partitionBy(*group)
    chunk_order = whole.orderBy("_chunk").rowsBetween(*up_to_here)
    offsets = totals.select(
        *[F.col(c).alias(f"_key_{c}") for c in keys],
        *[(F.sum(f"_sum_{c}").over(chunk_order) - F.col(f"_sum_{c}")).alias(f"_before_{c}") for c in value_cols],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in value_cols],
    )
    in_chunk = Window.partitionBy(*group, "_chunk").orderBy(*order_cols).rowsBetween(*up_to_here)
    # NULL is a group like any other here, as it is in a window.
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
    return (
        chunked.withColumns({f"_run_{c}": F.sum(c).over(in_chunk) for c in value_cols})
        .join(offsets, same, "inner")
        .select(
            *df.columns,
            *[(F.col(f"_before_{c}") + F.col(f"_run_{c}")).alias(f"cum_{c}") for c in value_cols],
            *[F.col(f"total_{c}") for c in value_cols],
        )
    )
