"""Joins, unions and deduplication.

No join is forced to broadcast a table that can grow: Spark broadcasts a side by itself when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise. Only
top-N key lists, whose length is an argument, carry the hint.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import column


def left_chain(base: DataFrame, others: Iterable[DataFrame], key: str) -> DataFrame:
    """Left equi-joins on one key, one after the other."""
    return reduce(lambda joined, other: joined.join(other, on=key, how="left"), others, base)


def zero_fill_join(
    units: DataFrame, counts: DataFrame, key: str, filled: Sequence[str]
) -> DataFrame:
    """Keep every unit; units without a match get zero in the ``filled`` columns."""
    return units.join(counts, on=key, how="left").na.fill(0, subset=list(filled))


def top_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys, ties by key; the counts are made before anything is sorted."""
    counts = df.groupBy(column(key).alias(key)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(key)).limit(n).select(key)


def semi_join_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is one of the ``n`` most frequent. The key list has at most ``n`` rows."""
    return df.join(F.broadcast(top_keys(df, key, n)), on=key, how="left_semi")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns that a frame lacks are NULL there."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of each distinct row (NULLs equal). Copies collapse before the shuffle."""
    return df.dropDuplicates()
