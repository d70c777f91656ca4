"""Data quality: missing values, duplicates, key parity and coverage. One pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.ratios import safe_ratio
from arealis.functions.text import column


def is_missing(value: Column) -> Column:
    """NULL, blank or a ``nan`` text in any case."""
    text = F.lower(F.trim(value.cast("string")))
    return F.coalesce(text.isin("", "nan"), F.lit(True))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column: count, and percentage with two decimals."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(is_missing(column(name))).alias(f"m{i}") for i, name in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"m{i}").alias("missing"),
            F.round(safe_ratio(F.col(f"m{i}"), F.col("total")) * 100, 2).alias("missing_pct"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def missing_counts(name: str) -> dict[str, Column]:
    """Aggregates: rows, NULLs and empty texts of one column."""
    value = column(name)
    return {
        "total": F.count("*"),
        "total_null": F.count_if(value.isNull()),
        "total_empty": F.count_if(value.cast("string") == ""),
    }


def missing_by(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Rows, NULLs and empty texts of one column per group."""
    return df.groupBy(*by).agg(*[count.alias(part) for part, count in missing_counts(name).items()])


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before and after full-row deduplication, from one grouping of the rows."""
    copies = df.groupBy(*map(column, df.columns)).agg(F.count("*").alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
    )


def key_parity(base: DataFrame, export: DataFrame, key: str) -> DataFrame:
    """Distinct keys on both sides and whether they agree in number."""

    def distinct_keys(df: DataFrame, alias: str) -> Column:
        return df.agg(F.count_distinct(column(key)).alias(alias)).scalar()

    one_row = base.sparkSession.range(1)
    return one_row.select(
        distinct_keys(base, "base_keys").alias("base_keys"),
        distinct_keys(export, "export_keys").alias("export_keys"),
    ).withColumn("equal", F.col("base_keys") == F.col("export_keys"))


def coverage(df: DataFrame, name: str) -> DataFrame:
    """Rows that have a value, all rows, and the percentage with one decimal."""
    return df.agg(
        F.count(column(name)).alias("with_value"), F.count("*").alias("total")
    ).withColumn(
        "coverage_pct", F.round(safe_ratio(F.col("with_value"), F.col("total")) * 100, 1)
    )
