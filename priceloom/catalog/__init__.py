"""The registered queries, each next to the SQL that states its result."""

from priceloom.catalog import cleaning, documented, encoding, learning, scoring, shape, sources, splitting
from priceloom.catalog.base import REGISTRY, Query

__all__ = [
    "REGISTRY",
    "Query",
    "cleaning",
    "documented",
    "encoding",
    "learning",
    "scoring",
    "shape",
    "sources",
    "splitting",
]
