"""Embeddings as whole numbers, and their sums over all rows."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronolex.sources.scratch import materialize


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, others: dict[str, Column], scale: int, limit: float, multiple: int = 1) -> tuple[DataFrame, int]:
    """A stored table of the id, `others` and `x` = floor(scale * component), and the length of all `x`.

    Left out are rows whose vector is NULL or has a NULL or non-finite component, or one whose scaled
    size reaches `limit`, beyond which results would not fit a long. Vectors of unequal length are filled
    with zeros to the longest, and to a multiple of `multiple`. Runs actions.
    """
    scaled = lambda v: v.cast("double") * float(scale)
    # NaN is above all numbers, so the comparison also drops what is not finite.
    usable = F.forall(vector_col, lambda v: v.isNotNull() & (F.abs(scaled(v)) < limit))
    kept = df.filter(F.col(vector_col).isNotNull() & usable).select(
        F.col(id_col).alias("id"),
        *[c.alias(name) for name, c in others.items()],
        F.transform(vector_col, lambda v: F.floor(scaled(v)).cast("long")).alias("x"),
    )
    stored = materialize(kept, "whole-vectors")
    shortest, longest = stored.agg(F.min(F.size("x")), F.max(F.size("x"))).head()
    length = -(-(longest or 0) // multiple) * multiple
    if shortest is not None and shortest < length:
        filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("x")))
        stored = materialize(stored.withColumn("x", filled), "whole-vectors")
    return stored, length


def matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    """The rows of an Arrow list column as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def summed(rows: DataFrame, length: int, cells: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all rows of `cells(matrix of x)`, an array whose length does not depend on the rows.

    Each task sums its batches and sends one value per cell, which Spark adds up: the driver gets one row
    per cell, whatever the number of rows or tasks. Runs an action.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = cells(matrix(batch.column(0), length))
                total = own if total is None else total + own
        if total is not None:
            at = pa.array(np.arange(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["cell", "value"])

    parts = rows.select("x").mapInArrow(partial, f"cell int, value {kind}")
    value = F.col("value").cast("decimal(20,0)") if kind == "bigint" else F.col("value")
    found = {r[0]: r[1] for r in parts.groupBy("cell").agg(F.sum(value)).collect()}
    return np.array([found[i] for i in range(len(found))])
