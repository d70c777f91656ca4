"""Raw census tables to one feature table per geographic level."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.casts import census_bigint, census_double
from arealis.functions.rules import categorize
from arealis.levels import DISTRICT, SECTOR, Level, level_named
from arealis.operators import area_features as features
from arealis.operators.combine import left_chain
from arealis.operators.schema import project
from arealis.presets import census


def sector_type(code: Column) -> Column:
    return categorize(code.try_cast("int"), census.SECTOR_TYPE, "OUTROS")


CONVERTERS = {
    "text": lambda value: value,
    "bigint": census_bigint,
    "double": census_double,
    "sector_type": sector_type,
}
BASIC = {SECTOR.name: census.BASIC_SECTOR, DISTRICT.name: census.BASIC_DISTRICT}


def basic_table(
    raw: DataFrame, level: str | Level, municipality: str | None = census.MUNICIPALITY
) -> DataFrame:
    """Identity, area, people and dwellings of one municipality's units (None keeps all)."""
    mapping = BASIC[level_named(level).name]
    kept = raw if municipality is None else raw.where(F.col("nm_mun") == municipality)
    return project(kept, mapping, CONVERTERS)


def surroundings_table(raw: DataFrame, level: str | Level) -> DataFrame:
    """The key and the 35 counters of what dwellings face."""
    key = level_named(level).key
    counters = [(code, name, "bigint") for code, name in census.SURROUNDINGS]
    return project(raw, [(key, key, "text"), *counters], CONVERTERS)


def income_table(raw: DataFrame, level: str | Level) -> DataFrame:
    key = level_named(level).key
    return project(raw, [(key, key, "text"), *census.INCOME], CONVERTERS)


def add_unit_features(df: DataFrame) -> DataFrame:
    """Everything that is computed from a unit's own columns."""
    steps = (
        features.add_demographics,
        features.add_yes_shares,
        features.add_tree_indices,
        features.add_income_features,
        features.add_composites,
    )
    for step in steps:
        df = df.transform(step)
    return df


def final_columns(df: DataFrame, level: str | Level) -> DataFrame:
    return df.select(*level_named(level).geo_columns, *census.FINAL_MEASURES)


def build_units(
    raw: dict[str, DataFrame],
    level: str | Level,
    municipality: str | None = census.MUNICIPALITY,
) -> dict[str, DataFrame]:
    """Typed ``basico``, ``entorno`` and ``rendimento`` tables and the joined ``final`` one."""
    level = level_named(level)
    tables = {
        "basico": basic_table(raw["basico"], level, municipality),
        "entorno": surroundings_table(raw["entorno"], level),
        "rendimento": income_table(raw["rendimento"], level),
    }
    basic, *others = tables.values()
    joined = left_chain(basic, others, level.key)
    tables["final"] = joined.transform(add_unit_features).transform(
        partial(final_columns, level=level)
    )
    return tables
