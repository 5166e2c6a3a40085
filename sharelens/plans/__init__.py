"""Registered queries (stand-ins on the driver's tables) and end-to-end plans."""

from . import (  # noqa: F401  (importing registers the queries)
    e2e_queries,
    graph_queries,
    key_queries,
    linkage_queries,
    series_queries,
    share_queries,
    table_queries,
)
from .registry import QUERIES, register, table  # noqa: F401
