"""The registry and the shared helpers of the query modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder, and the adapters over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(adapters.SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def adapter(self, name: str) -> DataFrame:
        text = adapters.SQL[name]
        used = {field for _, field, _, _ in Formatter().parse(text) if field}
        return self.spark.sql(text, **{table: self.table(table) for table in used})


def query(name: str, oracle: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name`` with its DuckDB counterpart."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def with_adapters(*names: str, then: str = "") -> str:
    """``WITH a AS (…), b AS (…)`` over the adapters, plus further common tables."""
    parts = [f"{name} AS ({adapters.SQL[name].format_map(_SameName())})" for name in names]
    return "WITH " + ",\n".join([*parts, *([then] if then else [])]) + "\n"


class _SameName(dict):
    def __missing__(self, key: str) -> str:
        return key


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def sql_rounded(names: Sequence[str], digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)
