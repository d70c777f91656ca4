"""Batch runs over years and levels. One item's failure does not stop the others, and is raised or reported."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arealis.operators.quality import missing_by, missing_counts
from arealis.operators.combine import union_by_name
from arealis.operators.schema import with_constants
from arealis.plans.occurrences import clean_occurrences
from arealis.plans.units import build_units
from arealis.sources import readers, scratch, writers

# Items whose jobs run side by side; Spark shares the executors among them.
AT_ONCE = 4


@dataclass
class Outcome:
    """What became of one item: its result, or the error that ended it."""

    item: Any
    result: Any = None
    error: Exception | None = None


def run_all(spark: SparkSession, items: Iterable, work: Callable, at_once: int = AT_ONCE) -> list[Outcome]:
    """Run ``work`` for every item, several at a time from threads of the driver; outcomes in the order of the items.

    Each item has its own intermediate tables, which go when it ends, failed or not.
    """

    def one(item: Any) -> Outcome:
        try:
            with scratch.stage(spark, keep=False):
                return Outcome(item, result=work(item))
        except Exception as error:
            error.add_note(f"while processing {item!r}")
            return Outcome(item, error=error)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), list(items)))


def run_each(spark: SparkSession, items: Iterable, work: Callable, at_once: int = AT_ONCE) -> dict:
    """The results by item; all failures are raised together after the other items ran."""
    outcomes = run_all(spark, items, work, at_once)
    if failures := [outcome.error for outcome in outcomes if outcome.error]:
        raise ExceptionGroup("some items failed", failures)
    return {outcome.item: outcome.result for outcome in outcomes}


def outcome_table(spark: SparkSession, outcomes: Iterable[Outcome], schema: str) -> DataFrame:
    """``item, error`` and the columns of ``schema``: one row per outcome, from results that are rows of it.

    ``error`` is the error's condition if Spark named one, else its type; null for a result.
    """
    rows = []
    width = len(schema.split(","))
    for outcome in outcomes:
        found = tuple(outcome.result) if outcome.error is None else (None,) * width
        rows.append((str(outcome.item), _condition(outcome.error), *found))
    return spark.createDataFrame(rows, f"item string, error string, {schema}")


def _condition(error: Exception | None) -> str | None:
    if error is None:
        return None
    named = getattr(error, "getCondition", lambda: None)()
    return named or traceback.format_exception_only(error)[0].split(":")[0].strip()


def clean_years(
    spark: SparkSession,
    years: Iterable[str | int],
    raw_pattern: str,
    clean_pattern: str,
    fmt: str = "parquet",
) -> dict:
    """Clean each year's landed sheet into its own folder, several years at a time; patterns hold ``{year}``."""

    def one(year):
        raw = readers.read_text_table(spark, raw_pattern.format(year=year))
        target = clean_pattern.format(year=year)
        writers.save(clean_occurrences(raw), target, fmt)
        return target

    return run_each(spark, years, one)


def clean_and_count(
    spark: SparkSession,
    years: Iterable[str | int],
    raw_pattern: str,
    clean_pattern: str,
    fmt: str = "parquet",
    name: str = "data_ocorrencia_bo",
) -> list[Outcome]:
    """Clean each year and count its rows, NULL and empty dates on the write itself; nothing is read again.

    A result is ``(total, total_null, total_empty)``. The counts are observed after the last shuffle, so a task that runs
    again after a lost executor counts once. A year that fails, a sheet without the column included, has its error.
    """

    def one(year: str | int) -> tuple[int, int, int]:
        seen = Observation()
        cleaned = clean_occurrences(readers.read_text_table(spark, raw_pattern.format(year=year)))
        counted = cleaned.observe(seen, *[count.alias(part) for part, count in missing_counts(name).items()])
        writers.save(counted, clean_pattern.format(year=year), fmt)
        return tuple(int(seen.get[part]) for part in missing_counts(name))

    return run_all(spark, years, one)


def missing_dates(tables: Mapping[str, DataFrame], name: str = "data_ocorrencia_bo") -> DataFrame:
    """Rows, NULL and empty dates per year, all years in one pass."""
    stamped = [with_constants(table.select(name), ano=str(year)) for year, table in tables.items()]
    return missing_by(union_by_name(stamped), ["ano"], name)


def split_years(
    spark: SparkSession,
    years: Iterable[str | int],
    clean_pattern: str,
    split_pattern: str,
    day: str = "data_ocorrencia_bo",
) -> dict:
    """Split each cleaned year by quarter of the event date."""

    def one(year):
        target = split_pattern.format(year=year)
        cleaned = spark.read.parquet(clean_pattern.format(year=year))
        writers.split_by_quarter(cleaned, target, day)
        return target

    return run_each(spark, years, one)


def curate(
    spark: SparkSession, pattern: str, years: Iterable[str | int], target: str
) -> str:
    """Located quarter files to one table partitioned by period."""
    writers.save_partitioned(
        readers.read_quarter_files(spark, pattern, list(years)), target, "ano_trimestre"
    )
    return target


MANIFEST = "_sources"  # hidden from readers of the table


def curate_changed(
    spark: SparkSession, pattern: str, years: Iterable[str | int], target: str
) -> tuple[list[str], list[str]]:
    """Bring the curated table up to date: rewrite the periods whose source files changed, drop those without any.

    A manifest beside the table holds a fingerprint of each period's files: their names, sizes and times of change. It
    is written last, so a run that breaks off is repeated by the next. Returns the periods rewritten and dropped.
    The driver sees one row per period.
    """
    found = readers.quarter_paths(spark, pattern, list(years))
    now = _fingerprints(spark, found)
    manifest = f"{target.rstrip('/')}/{MANIFEST}"
    before = {}
    if readers.exists(spark, manifest):
        before = {row.period: row.fingerprint for row in spark.read.parquet(manifest).collect()}
    changed = sorted(period for period in now if before.get(period) != now[period])
    gone = sorted(period for period in before if period not in now)
    if changed:
        located = readers.read_quarter_paths(spark, pattern, {p: path for p, path in found.items() if f"{p[0]}_{p[1]}" in changed})
        writers.save_partitioned(located, target, "ano_trimestre", only_touched=True)
    for period in gone:
        scratch.remove(spark, f"{target.rstrip('/')}/ano_trimestre={period}")
    if changed or gone:
        table = spark.createDataFrame(sorted(now.items()), "period string, fingerprint long")
        table.coalesce(1).write.mode("overwrite").parquet(manifest)
    return changed, gone


def _fingerprints(spark: SparkSession, found: Mapping[tuple[str, int], str]) -> dict[str, int]:
    """By period, from one listing of its files; their contents are not read."""
    if not found:
        return {}
    files = [
        spark.read.format("binaryFile").load(path).select(
            F.lit(f"{year}_{quarter}").alias("period"), F.xxhash64("path", "length", "modificationTime").alias("file")
        )
        for (year, quarter), path in found.items()
    ]
    by_period = union_by_name(files).groupBy("period").agg(F.xxhash64(F.bit_xor("file"), F.count("*")).alias("fingerprint"))
    return {row.period: row.fingerprint for row in by_period.collect()}


def build_levels(
    spark: SparkSession,
    levels: Iterable[str],
    paths: Mapping[str, Mapping[str, str]],
    target: str,
) -> dict:
    """Census tables of each level: read, build, write the bundle."""

    def one(level):
        tables = build_units(readers.read_census(spark, level, paths), level)
        return writers.save_bundle(tables, target, level)

    return run_each(spark, levels, one)
