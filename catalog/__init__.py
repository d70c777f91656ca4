"""Registered queries: each pairs a Spark query over the test tables with its SQL counterpart."""

from catalog import batches, cleaning, files, models, profiles, rates, statistics, units  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
