"""All queries and the SQL that checks them."""

from finlake.queries import gold, growth, quality, silver, storage  # noqa: F401 - registration
from finlake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
