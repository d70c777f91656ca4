"""Summaries, histograms and box-plot statistics as typed tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import column
from arealis.operators.quantiles import RankSearch, finite, ranks_around

QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5


def summary_stats(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles, one row per column.

    Only finite values count. All but the quartiles come from the first scan of the search for these, which all
    columns share; small columns need no other.
    """
    search = RankSearch(df, names)
    search.settle({name: ranks_around(search.positions(name, QUARTILES)) for name in names})
    parts = ("count", "mean", "stddev", "min")
    lines = [
        (name, *[search.known(name, part) for part in parts], *search.quantiles(name, QUARTILES), search.known(name, "max"))
        for name in names
    ]
    kinds = "mean double, stddev double, min double, p25 double, p50 double, p75 double, max double"
    return df.sparkSession.createDataFrame(lines, f"variable string, count long, {kinds}")


def histogram(
    df: DataFrame, name: str, bins: int = 50, at_most: float | None = None, up_to: float | None = None
) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last bin closed.

    Empty bins are listed with zero. When all values are equal the range is half a unit to each
    side, so one bin holds them all. ``at_most`` leaves out larger values first, ``up_to`` those above that quantile.
    Bins hold finite values; ``not_finite``, the same in every row, counts the NaN and infinite values left beside them.
    """
    every = df.select(column(name).cast("double").alias("v")).where("v IS NOT NULL")
    if up_to is not None:
        search = RankSearch(every, ["v"])
        limit, size, _ = search.up_to_quantile("v", up_to)
        at_most = math.inf if limit is None else limit
        extremes = (search.known("v", "min"), search.largest_of("v", size)) if size else None
    if at_most is not None:
        every = every.where(F.col("v") <= F.lit(at_most))
    if up_to is None:
        value = finite(F.col("v"))
        extremes = every.agg(F.min(value), F.max(value)).first()
    low, high = (F.lit(end).cast("double") for end in extremes or (None, None))
    pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))

    def edge(index: Column) -> Column:
        return F.when(index == bins, F.col("hi")).otherwise(F.col("lo") + index * F.col("step"))

    def with_range(frame: DataFrame) -> DataFrame:
        return frame.withColumns({"lo": low - pad, "hi": high + pad}).withColumn(
            "step", (F.col("hi") - F.col("lo")) / bins
        )

    guess = F.least(F.floor((F.col("v") - F.col("lo")) / F.col("step")).cast("int"), F.lit(bins - 1))
    last = F.lit(bins - 1)
    settled = (
        F.when(F.col("v") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("guess") < last) & (F.col("v") >= edge(F.col("guess") + 1)), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    # Rows that are not finite have no bin; their number rides along.
    counted = (
        with_range(every.select(finite(F.col("v")).alias("v")))
        .withColumn("guess", guess)
        .groupBy(F.when(F.col("v").isNotNull(), settled.cast("int")).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    counted = counted.agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "count")))).alias("counts"),
        F.coalesce(F.sum(F.when(F.col("bin").isNull(), F.col("count"))), F.lit(0)).alias("not_finite"),
    )
    lines = with_range(counted.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    return lines.select(
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)).cast("bigint").alias("count"),
        F.col("not_finite").cast("bigint").alias("not_finite"),
    )


def box_stats(df: DataFrame, name: str, at_most: float | None = None, up_to: float | None = None) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of finite values outside.

    ``at_most`` leaves out larger values first, ``up_to`` those above that quantile, found by the same search.
    """
    values = df.select(finite(column(name)).alias("v")).where("v IS NOT NULL")
    if at_most is not None:
        values = values.where(F.col("v") <= F.lit(at_most))
    search = RankSearch(values, ["v"])
    if up_to is None:
        quartiles = search.quantiles("v", QUARTILES)
    else:
        limit, _, quartiles = search.up_to_quantile("v", up_to, QUARTILES)
        values = values.where(F.col("v") <= F.lit(limit).cast("double"))
    q1, median, q3 = [F.lit(q).cast("double") for q in quartiles]
    reach = (q3 - q1) * WHISKER
    value = F.col("v")
    inside = values.agg(
        F.count("*").alias("count"),
        F.min(F.when(value >= q1 - reach, value)).alias("first_inside"),
        F.max(F.when(value <= q3 + reach, value)).alias("last_inside"),
        F.count_if(value < q1 - reach).alias("outliers_low"),
        F.count_if(value > q3 + reach).alias("outliers_high"),
    )
    return inside.select(
        "count",
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        F.least("first_inside", q1).alias("whisker_low"),
        F.greatest("last_inside", q3).alias("whisker_high"),
        "outliers_low",
        "outliers_high",
    )
