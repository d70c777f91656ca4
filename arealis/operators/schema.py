"""Names, column selection and typed projections."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import column, normalize_name


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename every column to ASCII snake_case; two names that become one are an error."""
    names = [normalize_name(name) for name in df.columns]
    clashes = sorted(name for name, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"several columns normalise to the same name: {clashes}")
    return df.toDF(*names)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that the frame has, in the given order."""
    existing = set(df.columns)
    return [name for name in names if name in existing]


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}; the frame has {df.columns}")


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*present(df, names))


def map_present(
    df: DataFrame, names: Iterable[str], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``change`` to those of the named columns that exist, all in one projection."""
    changed = {name: change(column(name)) for name in present(df, names)}
    return df.withColumns(changed) if changed else df


def project(
    df: DataFrame,
    mapping: Iterable[tuple[str, str, str]],
    converters: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """Select, convert and rename from rows of (source, target, converter name).

    Source names resolve as Spark resolves them, so their case does not matter by default.
    """
    return df.select(
        *[converters[kind](column(source)).alias(target) for source, target, kind in mapping]
    )


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def preview(df: DataFrame, rows: int, *order_by: str) -> DataFrame:
    """First rows, by the given order when there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as a table: position, name and type of each column."""
    rows = [
        (position, field.name, field.dataType.simpleString())
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
