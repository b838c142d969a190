"""Group-aware train/test split."""

from pyspark.sql import Column, DataFrame, functions as F

from chronolex.operators.skew import join_lookup
from chronolex.sources.scratch import materialize

GROUP = ["series", "issue"]


def group_fraction(seed: int | str, group_cols: list[str] = GROUP) -> Column:
    """A number in [0, 1) that depends on the seed and the group only, not on the partitioning."""
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), *group_cols))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_split(
    df: DataFrame, train_ratio: float = 0.8, seed: int = 0, group_cols: list[str] = GROUP
) -> DataFrame:
    """Add `split`: every row of a group lands on the same side. Needs no shuffle."""
    side = F.when(group_fraction(seed, group_cols) < train_ratio, F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn("split", side)


def group_split(
    df: DataFrame, train_ratio: float = 0.8, seed: int = 0, group_cols: list[str] = GROUP
) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, train_ratio, seed, group_cols)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )


def split_by_membership(
    df: DataFrame, train_groups: DataFrame, group_cols: list[str] = GROUP
) -> tuple[DataFrame, DataFrame]:
    """Split by a given table of training groups instead of the hash. Runs actions."""
    groups = materialize(train_groups.select(*group_cols).distinct(), "train-groups")
    return join_lookup(df, groups, group_cols, "left_semi"), join_lookup(df, groups, group_cols, "left_anti")


def drop_shared_text(test: DataFrame, train: DataFrame, text_col: str = "text") -> DataFrame:
    """Test rows whose exact text does not occur in the training rows.

    Only distinct hashes meet, so copies collapse before the shuffle; the texts stay where they are
    unless the shared hashes are too many to broadcast. Runs actions.
    """

    def hashes(df: DataFrame) -> DataFrame:
        return df.select(F.md5(text_col).alias("_hash")).distinct()

    shared = materialize(hashes(test).join(hashes(train), "_hash", "left_semi"), "shared-text")
    hashed = test.withColumn("_hash", F.md5(text_col))
    return join_lookup(hashed, shared, ["_hash"], "left_anti").drop("_hash")
