"""Ratios, shares, indices and rates. NULL or a zero denominator gives NULL, never an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rate_per(count: Column, base: Column, scale: int = 1000) -> Column:
    """``count`` per ``scale`` of ``base``; NULL unless the base is positive."""
    return F.when(base > 0, safe_ratio(count, base) * scale)


def log1p_or_null(value: Column) -> Column:
    return F.log1p(F.when(value > -1, value))


def yes_share(yes: Column, no: Column) -> Column:
    """Share of yes among declared answers."""
    return safe_ratio(yes, yes + no)


def weighted_share(weights: Mapping[str, int], total: Sequence[str]) -> Column:
    """Weighted sum of counters over the plain sum of the ``total`` counters."""
    weighted = reduce(add, (F.col(name) * weight for name, weight in weights.items()))
    return safe_ratio(weighted, reduce(add, map(F.col, total)))


def complement(name: str) -> Column:
    return 1 - F.col(name)


def composite_mean(parts: Sequence[Column]) -> Column:
    """Plain mean of several parts; NULL as soon as one part is NULL."""
    return reduce(add, parts) / len(parts)
