"""Column-wise cleaning. Each operator is one projection over the columns that exist."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions import casts
from arealis.functions.rules import Rule, categorize, ignores_case, indicator
from arealis.functions.text import NULL_TOKENS, column, null_tokens_to_null, tidy
from arealis.operators.schema import map_present


def trim_text(df: DataFrame, whitespace: str = "spaces") -> DataFrame:
    """Trim every string column."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return map_present(df, texts, partial(tidy, whitespace=whitespace))


def blank_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Turn null tokens into NULL in every column; types stay."""
    return map_present(df, df.columns, partial(null_tokens_to_null, tokens=tokens))


def upper_text(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, F.upper)


def cast_dates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, casts.parse_date)


def cast_timestamps(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, casts.parse_timestamp)


def cast_integers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, casts.parse_integer)


def cast_clocks(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, casts.parse_clock)


def cast_coordinates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_present(df, names, casts.parse_coordinate)


def cast_flags(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Boolean flags, whatever text or number they were stored as.

    Columns that are boolean already stay untouched, so filters on them still reach the scan.
    """
    booleans = {field.name for field in df.schema.fields if isinstance(field.dataType, T.BooleanType)}
    return map_present(df, [name for name in names if name not in booleans], casts.parse_flag)


def add_hour(df: DataFrame, source: str, target: str) -> DataFrame:
    if source not in df.columns:
        return df
    return df.withColumn(target, casts.clock_hour(column(source)))


def add_categories(
    df: DataFrame, table: Iterable[tuple[str, str, Sequence[Rule], str | None]]
) -> DataFrame:
    """Add the category columns whose source exists, from (target, source, rules, default) rows.

    Upper-cased sources get a projection of their own, so that a row computes each of them once
    and not once per rule.
    """
    rows = [row for row in table if row[1] in df.columns]
    folds = {source: f"__upper_{source}" for _, source, rules, _ in rows if ignores_case(rules)}
    folded = df.withColumns({name: F.upper(column(source)) for source, name in folds.items()})
    added = {
        target: categorize(
            column(source), rules, default, column(folds[source]) if source in folds else None
        )
        for target, source, rules, default in rows
    }
    return folded.withColumns(added).drop(*folds.values())


def add_indicators(df: DataFrame, table: Iterable[tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """Add the 0/1 columns whose category exists, from (target, category, accepted) rows."""
    added = {
        target: indicator(column(source), *accepted)
        for target, source, accepted in table
        if source in df.columns
    }
    return df.withColumns(added)
