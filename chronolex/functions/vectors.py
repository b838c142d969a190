"""ML vectors without Python UDFs."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def vector_element(vector: Column, index: int) -> Column:
    """Element of a short vector (probabilities); NULL if the vector or the element is absent."""
    return F.get(vector_to_array(vector), F.lit(index))


def stored_values(vector: Column) -> Column:
    """Stored values of a vector; wide sparse vectors are never made dense."""
    return F.unwrap_udt(vector).getField("values")


def stored_indices(vector: Column) -> Column:
    """Places of the stored values of a sparse vector; NULL for a dense one."""
    return F.unwrap_udt(vector).getField("indices")


def nonzero_count(vector: Column) -> Column:
    return F.size(F.filter(stored_values(vector), lambda x: x != 0.0))
