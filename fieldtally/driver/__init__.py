from fieldtally.driver import mart_queries, operator_queries, refresh_queries  # noqa: F401  (they register their queries)
from fieldtally.driver.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
