"""All registered queries."""

from swaplens.checks import market_queries, stream_queries, swap_queries  # noqa: F401
from swaplens.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
