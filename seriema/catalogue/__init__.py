"""Queries of this package over the test tables and the SQL that checks them."""

from . import (  # noqa: F401
    aggregates,
    calendar,
    cleaning,
    plans,
    quality,
    scalars,
    sources,
    windows,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
