"""Loads every query module, so that all queries are registered."""

from . import (  # noqa: F401
    keyed_queries,
    log_queries,
    metric_queries,
    positioned_queries,
    routing_queries,
    row_queries,
    sink_queries,
    stream_queries,
    subscription_queries,
    value_queries,
)
from .registry import QUERIES, SQL  # noqa: F401
