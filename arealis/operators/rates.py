"""Counts of flagged events per area and period, and rates on the area's population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.ratios import log1p_or_null, rate_per, safe_ratio
from arealis.functions.text import column
from arealis.operators.combine import zero_fill_join
from arealis.presets.analysis import EVENT_FLAGS, LOG_RATE, TARGET_RATE

# count column, rate column
RATES = {
    "qt_crimes": TARGET_RATE,
    "qt_roubos": "tx_roubos_1000_hab",
    "qt_furtos": "tx_furtos_1000_hab",
}


def flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows where at least one boolean flag is true."""
    return df.where(reduce(or_, map(column, flags)))


def count_events(
    events: DataFrame,
    key: str,
    by: Sequence[str] = (),
    flags: Mapping[str, str] = EVENT_FLAGS,
    total: str = "qt_crimes",
) -> DataFrame:
    """Flagged events per key and period: the total and one count per flag.

    Every aggregate is a plain count, so a hot key collapses to one row per map task.
    """
    return (
        flagged(events, list(flags.values()))
        .where(column(key).isNotNull())
        .groupBy(key, *by)
        .agg(
            F.count("*").alias(total),
            *[F.count_if(column(flag)).alias(name) for name, flag in flags.items()],
        )
    )


def add_rates(
    df: DataFrame,
    population: str = "qt_pessoas",
    area: str | None = "area_km2",
    rates: Mapping[str, str] = RATES,
) -> DataFrame:
    """Rates per 1000 inhabitants, their log, and events per square kilometre."""
    added: dict[str, Column] = {
        rate: rate_per(column(count), column(population))
        for count, rate in rates.items()
        if count in df.columns
    }
    if area is not None:
        added["tx_crimes_km2"] = safe_ratio(F.col("qt_crimes"), column(area))
    if TARGET_RATE in added:
        added[LOG_RATE] = log1p_or_null(added[TARGET_RATE])
    return df.withColumns(added)


def rates_by_unit_period(
    events: DataFrame,
    units: DataFrame,
    key: str,
    by: Sequence[str] = ("ano", "trimestre"),
    how: str = "inner",
) -> DataFrame:
    """Counts first, then the join: the shuffle to the units carries one row per key and period."""
    return add_rates(count_events(events, key, by).join(units, on=key, how=how))


def rates_by_unit(events: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """One row per unit, units without events included with zero counts."""
    counts = count_events(events, key)
    filled = ["qt_crimes", *EVENT_FLAGS]
    return add_rates(zero_fill_join(units, counts, key, filled))


def population_floor(df: DataFrame, floor: int, population: str = "qt_pessoas") -> DataFrame:
    return df.where(column(population) >= floor)


def sum_by(df: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of measures per group."""
    return df.groupBy(*by).agg(*[F.sum(column(name)).alias(name) for name in measures])


def district_rate(base: DataFrame, district: str = "nm_dist") -> DataFrame:
    """Events over the population summed across unit and period rows.

    A unit's population counts once per period with events, as in the published tables: this is
    the mean rate of an active period. ``district_rate_per_resident`` counts each resident once.
    """
    sums = sum_by(base, [district], ["qt_crimes", "qt_pessoas"])
    return sums.withColumn(TARGET_RATE, rate_per(F.col("qt_crimes"), F.col("qt_pessoas")))


def district_rate_per_resident(base: DataFrame, key: str, district: str = "nm_dist") -> DataFrame:
    """Events over the population of the district's distinct units."""
    per_unit = base.groupBy(key, district).agg(
        F.sum("qt_crimes").alias("qt_crimes"), F.max("qt_pessoas").alias("qt_pessoas")
    )
    return district_rate(per_unit, district)


def share_of_total(df: DataFrame, measure: str, target: str = "participacao_pct") -> DataFrame:
    """Percentage of the grand total, which is a scalar subquery: no window gathers the rows.

    The frame is read twice, so give it as a stored table where its plan is long.
    """
    total = df.agg(F.sum(column(measure))).scalar()
    return df.withColumn(target, safe_ratio(column(measure), total) * 100)


def top_rows(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """Largest ``n`` rows by a measure; ``ties`` make the choice the same on every run."""
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(n)
