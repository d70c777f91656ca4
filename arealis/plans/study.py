"""Rate bases and the published analyses over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.operators import regression
from arealis.operators.cleaning import cast_flags
from arealis.operators.correlation import correlate
from arealis.operators.rates import population_floor, rates_by_unit, rates_by_unit_period
from arealis.operators.schema import present
from arealis.presets import analysis
from arealis.sources.scratch import materialize


def located(events: DataFrame, key: str = "SJ_CD_SETOR", unit_key: str = "cd_setor") -> DataFrame:
    """Events placed in a unit, with real boolean flags whatever they were stored as."""
    placed = events.where(F.col(key).isNotNull()).withColumnRenamed(key, unit_key)
    return cast_flags(placed, analysis.EVENT_FLAGS.values())


def rate_base(events: DataFrame, units: DataFrame, key: str = "cd_setor") -> DataFrame:
    """One row per unit and period with events, with the unit's features and rates."""
    return rates_by_unit_period(events, units, key)


def spatial_base(
    events: DataFrame,
    units: DataFrame,
    key: str = "cd_setor",
    floor: int = analysis.POPULATION_FLOOR_MODEL,
    columns: tuple[str, ...] = analysis.SPATIAL_COLUMNS,
) -> DataFrame:
    """One row per populated unit, zero-filled, with the columns that spatial tools need."""
    base = rates_by_unit(events, population_floor(units, floor), key)
    return base.select(*present(base, columns))


def scatter_base(df: DataFrame, *names: str, below: float = analysis.TOP_RATE) -> DataFrame:
    """Named columns and the rate, complete rows only, extreme rates left out."""
    wanted = [*names, analysis.TARGET_RATE]
    return df.select(*wanted).where(F.col(analysis.TARGET_RATE) < below).na.drop(subset=wanted)


def main_correlations(base: DataFrame) -> DataFrame:
    populated = population_floor(base, analysis.POPULATION_FLOOR_MODEL)
    return correlate(populated, analysis.TARGET_RATE, analysis.MAIN_VARIABLES)


@dataclass(frozen=True)
class RegressionStudy:
    """The three nested models and their tables."""

    fits: dict[str, regression.OlsFit]
    coefficients: DataFrame
    p_values: DataFrame
    fit: DataFrame
    final: DataFrame
    vif: DataFrame
    diagnostics: DataFrame


def model_table_of(base: DataFrame) -> DataFrame:
    """The columns of the models for populated units, as a written table."""
    columns = {analysis.LOG_RATE, *(name for names in analysis.MODELS.values() for name in names)}
    populated = population_floor(base, analysis.POPULATION_FLOOR_MODEL)
    return materialize(populated.select(*sorted(columns)))


def regression_study(base: DataFrame) -> RegressionStudy:
    """All models and tables. The base is computed once: its model columns are written out, then
    read for the fits and again for the residual moments.
    """
    spark = base.sparkSession
    populated = model_table_of(base)
    fits = regression.fit_models(populated, analysis.LOG_RATE, analysis.MODELS)
    main = list(fits)[-1]
    return RegressionStudy(
        fits=fits,
        coefficients=regression.compare_models(spark, fits, "coef"),
        p_values=regression.compare_models(spark, fits, "p_value"),
        fit=regression.fit_table(spark, fits, analysis.MODEL_TITLES),
        final=regression.model_table(spark, fits, analysis.MODEL_ROWS),
        vif=regression.vif_table(spark, fits[main]),
        diagnostics=regression.diagnostics(populated, fits),
    )
