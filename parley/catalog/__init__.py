"""Named queries over the test tables, with their SQL equivalents."""

from parley.catalog import dialog_queries, source_queries, table_queries, text_queries, training_queries  # noqa: F401
from parley.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
