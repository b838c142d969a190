"""Label expression over delimited tag lists."""

from pyspark.sql import Column, functions as F

from chronolex import schema


def label_from_tags(
    contents: Column,
    delimiter: str = schema.TAG_DELIMITER,
    labels: dict[str, float] | None = None,
) -> Column:
    """First tag of `labels` (in its order) that occurs in the list; 'other' if none or NULL."""
    values = schema.LABELS if labels is None else labels
    tags = F.split(contents, delimiter)
    otherwise = F.lit(float(values["other"]))
    matches = [
        F.when(F.array_contains(tags, name), F.lit(float(value)))
        for name, value in values.items()
        if name != "other"
    ]
    return F.coalesce(*matches, otherwise)
