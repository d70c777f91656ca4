"""Exact quantiles of many columns at once, in the same way at any size.

The first aggregate gives each column's count, extremes, mean, deviation and a mergeable sketch. A sketch of up to
CAPACITY values holds them all, so a column of that size is settled in one scan. In a larger one the sketch brackets
the wanted ranks; the next scan counts what lies below and in each bracket, which checks it (a miss widens
it), and sketches what lies strictly inside. Each scan shrinks a bracket some 1,500 times. All columns share the scans. No
task holds a column's values, and the driver sees one sketch per bracket.

Only finite values count: NaN and the infinities are left out like NULL.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arealis.functions.text import column

ACCURACY = 10_000
# Values a sketch holds before it thins them out.
CAPACITY = 1 << 15


def finite(value: Column) -> Column:
    """The value as a double; NULL for NaN and the infinities."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(math.inf)), number)


def approximate_quantiles(
    df: DataFrame, name: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per probability, rank error at most 1/accuracy, one pass."""
    picked = F.percentile_approx(finite(column(name)), list(probabilities), accuracy)
    return df.agg(picked.alias("q")).select(_rows(F.col("q"), probabilities))


def quantile_table(df: DataFrame, name: str, probabilities: Sequence[float]) -> DataFrame:
    """One row per probability with the exact, linearly interpolated quantile."""
    found = exact_quantiles(df, name, probabilities)
    quantiles = F.array(*[F.lit(value).cast("double") for value in found])
    return df.sparkSession.range(1).select(_rows(quantiles, probabilities))


def exact_quantiles(df: DataFrame, name: str, probabilities: Sequence[float]) -> list[float | None]:
    """The exact quantiles as numbers, for use as thresholds in later queries."""
    return quantiles_of_columns(df, {name: probabilities})[name]


def quantiles_of_columns(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated quantiles of several columns; None for a column without values."""
    search = RankSearch(df, list(wanted))
    places = {name: search.positions(name, levels) for name, levels in wanted.items()}
    search.settle({name: ranks_around(at) for name, at in places.items()})
    return {
        name: [search.interpolated(name, place) for place in places[name]] if places[name] else [None] * len(levels)
        for name, levels in wanted.items()
    }


def _rows(quantiles: Column, probabilities: Sequence[float]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(float(p)).alias("probability"), quantiles[i].alias("value"))
                for i, p in enumerate(probabilities)
            ]
        )
    )


def ranks_around(places: Sequence[float]) -> list[int]:
    return sorted({rank(place) for place in places for rank in (math.floor, math.ceil)})


@dataclass
class _Part:
    """Some of a column's values: how many lie below all of them, their number, a sketch of them, the wanted ranks."""

    column: int
    below: int
    size: int
    sketch: bytes
    ranks: list[int]


# Closed bounds: the column's number, the lowest and the highest value, the 0-based ranks in between.
_Bounds = tuple[int, float, float, list[int]]


class RankSearch:
    """Order statistics of some columns of a frame. Ranks count from 0 among a column's finite values.

    What was found stays, and later ranks begin with the first scan's sketches.
    """

    def __init__(self, df: DataFrame, names: Sequence[str]) -> None:
        self.spark: SparkSession = df.sparkSession
        self.numbers = {name: i for i, name in enumerate(names)}
        self.values = df.select(*[finite(column(name)).alias(f"v{i}") for i, name in enumerate(names)])
        self.found: dict[tuple[int, int], float] = {}
        parts = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max, "sketch": _sketch}
        self.first: Row = self.values.agg(
            *[make(F.col(f"v{i}")).alias(f"{part}{i}") for i in range(len(names)) for part, make in parts.items()]
        ).first()

    def known(self, name: str, part: str) -> float | None:
        """``count``, ``mean``, ``stddev``, ``min`` or ``max`` of a column."""
        return self.first[f"{part}{self.numbers[name]}"]

    def positions(self, name: str, probabilities: Sequence[float], size: int | None = None) -> list[float]:
        """Places of quantiles among the first ``size`` values, all by default; none without values."""
        size = self.known(name, "count") if size is None else size
        return [p * (size - 1) for p in probabilities] if size else []

    def interpolated(self, name: str, place: float) -> float:
        i = self.numbers[name]
        low, high = self.found[i, math.floor(place)], self.found[i, math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))

    def quantiles(self, name: str, probabilities: Sequence[float], size: int | None = None) -> list[float | None]:
        """Interpolated quantiles of the first ``size`` values of a column."""
        places = self.positions(name, probabilities, size)
        self.settle({name: ranks_around(places)})
        return [self.interpolated(name, place) for place in places] or [None] * len(probabilities)

    def up_to_quantile(
        self, name: str, probability: float, probabilities: Sequence[float] = ()
    ) -> tuple[float | None, int, list[float | None]]:
        """A quantile, how many values do not exceed it, and ``probabilities`` among those.

        Values up to a quantile are the first ranks of the column, so their own quantiles are ranks of the same search.
        """
        n = self.known(name, "count")
        if not n:
            return None, 0, [None] * len(probabilities)
        (place,) = self.positions(name, [probability])
        size = math.floor(place) + 1  # if nothing equals the last of them
        inner = ranks_around(self.positions(name, probabilities, size))
        self.settle({name: [*ranks_around([place]), min(size, n - 1), *inner]})
        limit = self.interpolated(name, place)
        if size < n and self.found[self.numbers[name], size] <= limit:
            value = F.col(f"v{self.numbers[name]}")
            size = self.values.agg(F.count_if(value <= F.lit(limit))).first()[0]
        return limit, size, self.quantiles(name, probabilities, size)

    def largest_of(self, name: str, size: int) -> float:
        """The greatest of the first ``size`` values of a column."""
        self.settle({name: [size - 1]})
        return self.found[self.numbers[name], size - 1]

    def settle(self, wanted: Mapping[str, Sequence[int]]) -> None:
        """Find the values at these ranks."""
        parts = []
        for name, ranks in wanted.items():
            i = self.numbers[name]
            left = sorted({rank for rank in ranks if (i, rank) not in self.found})
            if left:
                parts.append(_Part(i, 0, self.first[f"count{i}"], bytes(self.first[f"sketch{i}"]), left))
        margin = 2.0
        while parts:
            bounds = self._bounds(parts, margin)
            if not bounds:
                return
            row = self._count(bounds)
            if any(not row[f"under{k}"] <= rank < row[f"high{k}"] for k, bound in enumerate(bounds) for rank in bound[3]):
                margin *= 2  # a sketch placed a bound on the wrong side of a rank
                continue
            parts = [part for k, bound in enumerate(bounds) for part in self._inside(row, k, bound)]
            margin = 2.0

    def _bounds(self, parts: list[_Part], margin: float) -> list[_Bounds]:
        """Closed bounds around the ranks of each part; parts that their sketch holds whole are settled instead."""
        shares = []
        error = 2.3 / CAPACITY**0.9  # a share of the ranks that a sketch seldom errs by more
        for part in parts:
            room = 0 if part.size <= CAPACITY else math.ceil(margin * error * part.size) + 1
            places = [rank - part.below + 0.5 + side for rank in part.ranks for side in (-room, room)]
            shares.append([min(1.0, max(0.0, place / part.size)) for place in places])
        sketches = self.spark.createDataFrame([[part.sketch for part in parts]], ", ".join(f"s{k} binary" for k in range(len(parts))))
        row = sketches.select(
            *[F.kll_sketch_get_quantile_double(f"s{k}", F.array(*map(F.lit, at))).alias(f"q{k}") for k, at in enumerate(shares)]
        ).first()
        bounds: list[_Bounds] = []
        for k, part in enumerate(parts):
            ends = list(zip(row[k][::2], row[k][1::2], part.ranks, strict=True))
            if part.size <= CAPACITY:
                self.found.update({(part.column, rank): value for value, _, rank in ends})
                continue
            merged: list[_Bounds] = []
            for low, high, rank in ends:
                if merged and low <= merged[-1][2]:
                    _, first, last, ranks = merged.pop()
                    merged.append((part.column, first, max(last, high), [*ranks, rank]))
                else:
                    merged.append((part.column, low, high, [rank]))
            bounds += merged
        return bounds

    def _count(self, bounds: list[_Bounds]) -> Row:
        """Exact counts at the bounds, and sketches of what lies strictly between: the bounds may be hot values."""
        counters = []
        for k, (number, low, high, _) in enumerate(bounds):
            value = F.col(f"v{number}")
            counters += [
                F.count_if(value < F.lit(low)).alias(f"under{k}"),
                F.count_if(value <= F.lit(low)).alias(f"low{k}"),
                F.count_if(value < F.lit(high)).alias(f"before{k}"),
                F.count_if(value <= F.lit(high)).alias(f"high{k}"),
                _sketch(F.when((value > F.lit(low)) & (value < F.lit(high)), value)).alias(f"inside{k}"),
            ]
        return self.values.agg(*counters).first()

    def _inside(self, row: Row, k: int, bound: _Bounds) -> list[_Part]:
        """What is left of a bracket without the ranks that fall on its bounds."""
        number, low, high, ranks = bound
        at_low, before = row[f"low{k}"], row[f"before{k}"]
        self.found.update({(number, rank): low for rank in ranks if rank < at_low})
        self.found.update({(number, rank): high for rank in ranks if rank >= max(before, at_low)})
        left = [rank for rank in ranks if at_low <= rank < before]
        return [_Part(number, at_low, before - at_low, bytes(row[f"inside{k}"]), left)] if left else []


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(CAPACITY))
