"""Pearson correlation of many variables with one target, in a single aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import column
from arealis.operators.schema import require


def pearson(a: Column, b: Column) -> Column:
    """Pearson's r over pairs without NULL; NULL for a constant side or fewer than two pairs.

    ``corr`` raises on a constant column in ANSI mode. The three sums skip the same pairs.
    """
    a, b = a.cast("double"), b.cast("double")
    spread = F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b))
    return F.try_divide(F.regr_sxy(a, b), spread)


def correlate(
    df: DataFrame,
    target: str,
    variables: Sequence[str],
    where: str | Column | None = None,
    ascending: bool = False,
) -> DataFrame:
    """(variable, r) rows in order of r; variables without a defined r are left out."""
    require(df, [target, *variables])
    base = df if where is None else df.where(where)
    wide = base.agg(
        *[pearson(column(name), column(target)).alias(f"r{i}") for i, name in enumerate(variables)]
    )
    lines = [
        F.struct(F.lit(name).alias("variable"), F.col(f"r{i}").alias("correlation"))
        for i, name in enumerate(variables)
    ]
    return (
        wide.select(F.inline(F.array(*lines)))
        .where("correlation IS NOT NULL")
        .orderBy(F.asc("correlation") if ascending else F.desc("correlation"), "variable")
    )


def correlate_groups(
    df: DataFrame, target: str, groups: Mapping[str, Sequence[str]], where: str | Column | None = None
) -> DataFrame:
    """(variable_group, variable, r) for named groups of variables, all from one aggregation."""
    everything = list(dict.fromkeys(name for names in groups.values() for name in names))
    places = [F.when(F.col("variable").isin(*names), F.lit(group)) for group, names in groups.items()]
    found = correlate(df, target, everything, where)
    return found.select(
        F.explode(F.array_compact(F.array(*places))).alias("variable_group"), "variable", "correlation"
    )
