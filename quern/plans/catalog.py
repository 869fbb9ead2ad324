"""All registered queries."""

from quern.plans import (  # noqa: F401
    episode_queries,
    evaluation_queries,
    frame_queries,
    lifecycle_queries,
    order_queries,
    search_queries,
    text_queries,
)
from quern.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
