"""Ratios, shares and indices of census units: column arithmetic only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.ratios import (
    complement,
    composite_mean,
    log1p_or_null,
    safe_ratio,
    weighted_share,
    yes_share,
)
from arealis.presets.census import COMPOSITES, TREE_CLASSES, YES_SHARES

MEAN_INCOME = "vl_rendimento_nominal_medio_responsavel"
MEDIAN_INCOME = "vl_rendimento_nominal_mediano_responsavel"
MEAN_RESIDENTS = "avg_moradores_domiciliosparticularesocupados"

# Ratio column, numerator, denominator.
DEMOGRAPHIC_RATIOS = (
    ("densidade_populacional", "qt_pessoas", "area_km2"),
    ("densidade_domicilios", "qt_domicilios", "area_km2"),
    ("tx_domicilios_ocupados", "qt_domicilios_particularesocupados", "qt_domicilios"),
    ("tx_domicilios_vagos", "qt_domicilios_particulares_vagos", "qt_domicilios"),
)
INCOME_RATIOS = (
    ("vl_renda_media_por_morador", MEAN_INCOME, MEAN_RESIDENTS),
    ("vl_renda_mediana_por_morador", MEDIAN_INCOME, MEAN_RESIDENTS),
    ("densidade_renda_media_km2", MEAN_INCOME, "area_km2"),
    ("densidade_renda_mediana_km2", MEDIAN_INCOME, "area_km2"),
)


def add_ratios(df: DataFrame, table: tuple[tuple[str, str, str], ...]) -> DataFrame:
    return df.withColumns(
        {target: safe_ratio(F.col(above), F.col(below)) for target, above, below in table}
    )


def add_demographics(df: DataFrame) -> DataFrame:
    """Densities per square kilometre and dwelling occupancy shares."""
    return add_ratios(df, DEMOGRAPHIC_RATIOS)


def add_yes_shares(
    df: DataFrame, table: tuple[tuple[str, str], ...] = YES_SHARES
) -> DataFrame:
    """Share of yes among declared answers, from each stem's ``_sim`` and ``_nao`` counters."""
    return df.withColumns(
        {
            target: yes_share(F.col(f"{stem}_sim"), F.col(f"{stem}_nao"))
            for target, stem in table
        }
    )


def add_tree_indices(df: DataFrame, classes: tuple[str, ...] = TREE_CLASSES) -> DataFrame:
    """Share of frontages with trees, and the mean tree class (0 none … 3 five or more)."""
    return df.withColumns(
        {
            "tx_arborizacao": weighted_share(dict.fromkeys(classes[1:], 1), classes),
            "indice_arborizacao_ponderado": weighted_share(
                {name: weight for weight, name in enumerate(classes) if weight}, classes
            ),
        }
    )


def add_income_features(df: DataFrame) -> DataFrame:
    """Log incomes, income per resident and per square kilometre."""
    logs = {
        "log_renda_media": log1p_or_null(F.col(MEAN_INCOME)),
        "log_renda_mediana": log1p_or_null(F.col(MEDIAN_INCOME)),
    }
    return add_ratios(df.withColumns(logs), INCOME_RATIOS)


def add_composites(
    df: DataFrame,
    table: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = COMPOSITES,
) -> DataFrame:
    """Plain means of shares; lowering parts enter as one minus the share."""
    return df.withColumns(
        {
            target: composite_mean([*map(F.col, raising), *map(complement, lowering)])
            for target, raising, lowering in table
        }
    )
