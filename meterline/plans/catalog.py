"""All registered queries. Importing a module registers its queries, in survey order."""

from . import series_queries, forecast_queries, vintage_queries, account_queries, explain_queries, tree_queries  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
