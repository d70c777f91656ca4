"""Sources. Text inputs are read as strings with no inference pass; typing is a later operator."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.levels import Level, level_named
from arealis.operators.combine import union_by_name
from arealis.operators.schema import with_constants

LATIN_1 = "ISO-8859-1"
QUARTERS = (1, 2, 3, 4)
CENSUS_TABLES = ("basico", "entorno", "rendimento")


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    encoding: str = LATIN_1,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Delimited file or folder with a header, every column a string.

    With ``columns`` the header is not sampled, which saves a job on wide folders. A folder's files
    must share one header; read files with different headers one by one and union them by name.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    return reader.csv(path)


def read_parquet_as_text(spark: SparkSession, path: str) -> DataFrame:
    """A landed sheet kept in Parquet, with every column as a string."""
    return as_text(spark.read.parquet(path))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def read_if_exists(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """A text table, or None where the path is missing, on any file system Spark can reach."""
    try:
        return read_text_table(spark, path, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path matches anything, on any file system Spark can reach."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def headers(spark: SparkSession, paths: Sequence[str], sep: str = ",", encoding: str = LATIN_1) -> dict[str, tuple[str, ...]]:
    """The column names of each path, a delimited file or a folder of such, from one job over all of them.

    A task stops after the first line it reads, so the job costs one task per split and no pass over the data. Names are
    as Spark's reader gives them: unnamed and repeated columns get their position. Empty files have no entry.
    """
    first = [
        spark.read.option("lineSep", "\n").text(path).select(
            F.lit(i).alias("path"),
            F.col("_metadata.file_block_start").alias("at"),
            F.col("_metadata.file_path").alias("file"),
            F.col("value").cast("binary").alias("line"),
        )
        for i, path in enumerate(paths)
    ]

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    if not first:
        return {}
    every = union_by_name(first).mapInArrow(one, "path int, at long, file string, line binary")
    lines = every.groupBy("path").agg(F.min_by("line", F.struct("at", "file")).alias("line")).collect()
    return {paths[row.path]: _column_names(bytes(row.line).decode(encoding), sep) for row in lines}


def _column_names(line: str, sep: str) -> tuple[str, ...]:
    (names,) = csv.reader([line.removeprefix("\ufeff").rstrip("\r\n")], delimiter=sep) or [[]]
    lower = [name.lower() for name in names]
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if lower.count(name.lower()) > 1 else name for i, name in enumerate(names)
    )


def quarter_paths(spark: SparkSession, pattern: str, years: Sequence[str | int]) -> dict[tuple[str, int], str]:
    """The paths of ``pattern``, with ``{year}`` and ``{quarter}`` filled in, that exist."""
    every = {(str(year), quarter): pattern.format(year=year, quarter=quarter) for year in years for quarter in QUARTERS}
    return {period: path for period, path in every.items() if exists(spark, path)}


def read_quarter_files(
    spark: SparkSession, pattern: str, years: Sequence[str | int], sep: str = ",", encoding: str = LATIN_1
) -> DataFrame:
    """Union of the per-quarter files that exist, each stamped with its period.

    ``pattern`` holds ``{year}`` and ``{quarter}``, and may hold ``*`` and ``?``. Headers may differ: one job reads them all, files with the
    same header are one scan, and columns are matched by name. The period comes from the name of the file. Finding no
    file at all is an error.
    """
    found = quarter_paths(spark, pattern, years)
    if not found:
        raise FileNotFoundError(f"no file matches {pattern} for years {list(years)}")
    return read_quarter_paths(spark, pattern, found, sep, encoding)


def read_quarter_paths(
    spark: SparkSession, pattern: str, found: Mapping[tuple[str, int], str], sep: str = ",", encoding: str = LATIN_1
) -> DataFrame:
    """The same for paths of ``pattern`` that are known to exist, by year and quarter."""
    alike: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers(spark, list(found.values()), sep, encoding).items():
        alike.setdefault(names, []).append(path)
    if not alike:
        raise FileNotFoundError(f"all files of {pattern} are empty: {sorted(found.values())}")
    years_of = "|".join(sorted({re.escape(year) for year, _ in found}))
    places = {"year": f"({years_of})", "quarter": "([1-4])"}
    parts = re.split(r"\{(year|quarter)\}", pattern)
    in_order = parts[1::2]
    fixed = [re.escape(part).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") for part in parts]
    named = "".join(places[part] if i % 2 else fixed[i] for i, part in enumerate(parts))
    # Paths are escaped as in a URL; a plus sign is not.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    year, quarter = (F.regexp_extract(path, named, in_order.index(part) + 1) for part in ("year", "quarter"))
    tables = [
        read_text_table(spark, paths, sep, encoding, names).withColumns(
            {
                "ano_particao": year,
                "trimestre_particao": quarter.cast("int"),
                "ano_trimestre": F.concat_ws("_", year, quarter),
            }
        )
        for names, paths in alike.items()
    ]
    return union_by_name(tables)


def stamp_period(df: DataFrame, year: str | int, quarter: int) -> DataFrame:
    """Constant period columns: year as text, quarter as int, and both as ``yyyy_q``."""
    return with_constants(
        df,
        ano_particao=str(year),
        trimestre_particao=quarter,
        ano_trimestre=f"{year}_{quarter}",
    )


def period_of(day: Column) -> dict[str, Column]:
    """The same period columns, taken from a date instead of a file name."""
    year, quarter = F.year(day), F.quarter(day)
    return {
        "ano_particao": year.cast("string"),
        "trimestre_particao": quarter,
        "ano_trimestre": F.concat_ws("_", year, quarter),
    }


def read_census(
    spark: SparkSession, level: str | Level, paths: Mapping[str, Mapping[str, str]]
) -> dict[str, DataFrame]:
    """The three raw census tables of a level, from ``paths[level name][table name]``."""
    at_level = paths[level_named(level).name]
    return {name: read_text_table(spark, at_level[name], sep=";") for name in CENSUS_TABLES}


def read_periods(
    spark: SparkSession,
    path: str,
    first_year: int | None = None,
    last_year: int | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Curated table partitioned by ``ano_trimestre``, with ``ano`` as int.

    Either bound may be left open. The year range is an expression of the partition column, so other folders are never listed
    into the scan. Folders may differ in columns. The schema over all of them is the one given, partition column
    included, or the one that the writer keeps beside the table; only without either is it merged from every footer.
    """
    schema = schema or stored_schema(spark, path)
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    year = F.regexp_extract(F.col("ano_trimestre"), r"(\d{4})", 1).try_cast("int")
    table = table.withColumn("ano", year)
    if first_year is not None:
        table = table.where(F.col("ano") >= first_year)
    if last_year is not None:
        table = table.where(F.col("ano") <= last_year)
    return table


SCHEMA_FOLDER = "_schema"  # hidden from readers of the table


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that ``save_partitioned`` keeps beside a table, or None."""
    folder = f"{path.rstrip('/')}/{SCHEMA_FOLDER}"
    if not exists(spark, folder):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(folder).first().value))
