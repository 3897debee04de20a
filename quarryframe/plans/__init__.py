"""Named queries over the driver's tables; importing this package fills the registry."""

from . import expressions, listings, metrics, more, series, stores, tables  # noqa: F401
from .registry import REGISTRY, Query, query

__all__ = ["REGISTRY", "Query", "query"]
