"""Importing this module registers every query."""

from chronolex.plans import (  # noqa: F401
    contract_queries,
    drift_queries,
    model_queries,
    pipeline_queries,
    summary_queries,
    term_queries,
    text_queries,
)
from chronolex.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
