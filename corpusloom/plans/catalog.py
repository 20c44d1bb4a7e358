"""All registered queries."""

from corpusloom.plans import (  # noqa: F401
    corpus_queries,
    evaluation_queries,
    operational_queries,
    page_queries,
    streaming_queries,
    trainset_queries,
)
from corpusloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
