"""Frequency tables and category grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import column
from arealis.operators.schema import require


def frequency_table(df: DataFrame, name: str) -> DataFrame:
    """Values of one column with their counts, most frequent first."""
    counts = df.groupBy(column(name).alias(name)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(name))


def frequency_tables(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same for several columns in one pass, as (variable, value, count)."""
    require(df, names)
    texts = df.select(*[column(name).cast("string").alias(name) for name in names])
    return (
        texts.unpivot([], list(names), "variable", "value")
        .groupBy("variable", "value")
        .agg(F.count("*").alias("count"))
    )


def pair_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.groupBy(first, second).agg(F.count("*").alias("count"))


def category_grid(df: DataFrame, row: str, across: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` against the given values of ``across``; absent pairs are zero.

    Rows of the grid without any of the values are left out, after the counting: a filter before it
    would compute a derived category twice per input row.
    """
    cells = [F.count_if(column(across) == value).alias(value) for value in values]
    grid = df.groupBy(row).agg(*cells)
    return grid.where(reduce(or_, [column(value) > 0 for value in values]))


def hourly_counts(df: DataFrame, hour: str) -> DataFrame:
    """Events per hour, rows without an hour left out."""
    return df.where(column(hour).isNotNull()).groupBy(hour).agg(F.count("*").alias("count"))
