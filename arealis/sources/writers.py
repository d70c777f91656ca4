"""Sinks. Failures are raised; nothing is swallowed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.sources.readers import LATIN_1, SCHEMA_FOLDER, exists, stored_schema

BYTE_ORDER_MARK = "\ufeff"


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    encoding: str | None = None,
) -> None:
    """Write as parquet, csv (with header, Latin-1 unless told otherwise) or json lines.

    ``single_file`` is for small exports. It shuffles into the one writer instead of coalescing, so
    the stages before it keep their parallelism.
    """
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unsupported format {fmt!r}")
    writer = (df.repartition(1) if single_file else df).write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("encoding", encoding or LATIN_1).csv(path)
    elif fmt == "json":
        writer.option("encoding", encoding or "UTF-8").json(path)
    else:
        writer.parquet(path)


def save_partitioned(
    df: DataFrame,
    path: str,
    by: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    only_touched: bool = False,
) -> None:
    """One folder per value of ``by``.

    The rebalance hint brings a partition's rows together so that it gets few files, and lets
    adaptive execution split a partition that is larger than the advisory size over many tasks.
    With ``only_touched``, folders that the frame has no rows for are left as they are. Beside a Parquet table its schema
    is kept, with the columns of the folders left, so that readers open no footer for it.
    """
    spark = df.sparkSession
    before = stored_schema(spark, path) if only_touched and fmt == "parquet" else None
    fresh = not only_touched or not exists(spark, path)
    schema = _merged(before, df.schema)
    writer = df.hint("rebalance", by).write.mode(mode).partitionBy(by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("encoding", LATIN_1)
    writer.format(fmt).save(path)
    # A table of another hand that is only touched has columns that are not known here: its footers are the schema.
    if fmt == "parquet" and mode == "overwrite" and (fresh or before is not None):
        text = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}")


def _merged(before: StructType | None, now: StructType) -> StructType:
    """The columns of both; a column that changes its type is an error."""
    if before is None:
        return now
    known = {field.name: field for field in before}
    if changed := [f.name for f in now if f.name in known and known[f.name].dataType != f.dataType]:
        raise ValueError(f"columns with another type than in the table: {changed}")
    return StructType([*before, *(field for field in now if field.name not in known)])


def save_distinct(df: DataFrame, path: str, fmt: str = "parquet") -> tuple[int, int]:
    """Write one copy of each row; returns the numbers of rows before and after.

    Both are observed on the write itself: the deduplication carries the number of copies along, and they are summed
    where the rows go to the files, so a task that is run again after a lost executor counts once.
    """
    copies = df.groupBy(*[F.col(f"`{name}`") for name in df.columns]).agg(F.count("*").alias("__copies"))
    seen = Observation()
    counts = F.coalesce(F.sum("__copies"), F.lit(0)).alias("before"), F.count("*").alias("after")
    save(copies.observe(seen, *counts).drop("__copies"), path, fmt)
    return int(seen.get["before"]), int(seen.get["after"])


def split_by_quarter(df: DataFrame, path: str, day: str, fmt: str = "csv") -> None:
    """One folder per quarter of a date column, from one scan; rows without a date go nowhere."""
    quarter = F.quarter(F.col(day).try_cast("date"))
    with_quarter = df.withColumn("trimestre", quarter).where("trimestre IS NOT NULL")
    save_partitioned(with_quarter, path, "trimestre", fmt)


def save_bundle(
    tables: Mapping[str, DataFrame], path: str, level: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Write each table of a bundle to ``<path>/<table>/processed/<level>``."""
    targets = {name: f"{path}/{name}/processed/{level}" for name in tables}
    for name, table in tables.items():
        save(table, targets[name], fmt)
    return targets


def export_gis(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Semicolon-separated UTF-8 text that opens with a byte order mark, for desktop GIS tools."""
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias(BYTE_ORDER_MARK + first), *[f"`{c}`" for c in rest])
    writer = (marked.repartition(1) if single_file else marked).write.mode("overwrite")
    writer.option("header", True).option("sep", ";").option("encoding", "UTF-8").csv(path)
