"""Summaries, quantiles, histograms, box plots and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import correlation, distribution, quantiles
from arealis.operators.rates import add_rates, count_events, population_floor
from arealis.plans import study, views
from arealis.presets import analysis
from catalog.rates import BASE, FULL, FULL_BASE, OCC_UNITS, full_rate_base, rate_base
from catalog.registry import query, rounded, with_adapters
from catalog.units import unit_tables

LEVELS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
SUMMARY = ("mean", "stddev", "min", "p25", "p50", "p75", "max")


def _summary_sql(name: str, source: str) -> str:
    quartiles = ", ".join(f"round(quantile_cont({name}, {p}), 6) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return (
        f"SELECT '{name}' AS variable, count({name}) AS count, round(avg({name}), 6) AS mean, "
        f"round(stddev_samp({name}), 6) AS stddev, round(CAST(min({name}) AS DOUBLE), 6) AS min, {quartiles}, "
        f"round(CAST(max({name}) AS DOUBLE), 6) AS max FROM {source}"
    )


@query(
    "summary_stats",
    with_adapters(*OCC_UNITS, then=BASE)
    + _summary_sql("tx_crimes_1000_hab", "base")
    + " UNION ALL "
    + _summary_sql("qt_pessoas", "base"),
)
def summary_stats(t):
    described = ["tx_crimes_1000_hab", "qt_pessoas"]
    return rounded(distribution.summary_stats(rate_base(t), described), SUMMARY)


@query(
    "quantiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS probability, round(quantile_cont(value, {p}), 6) AS value FROM events"
        for p in LEVELS
    ),
)
def quantile_query(t):
    return rounded(quantiles.quantile_table(t.table("events"), "value", LEVELS), ["value"])


@query(
    "quantiles_refined",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS probability, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem"
        for p in LEVELS
    ),
)
def quantiles_refined(t):
    """The largest table, where brackets need more than one round."""
    return rounded(quantiles.quantile_table(t.table("lineitem"), "l_extendedprice", LEVELS), ["value"])


def _histogram_sql(source: str, bins: int = 50) -> str:
    step = f"((hi - lo) / {bins})"
    return f"""
    , span AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                      CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {source}),
    guessed AS (SELECT v, lo, hi, least(CAST(floor((v - lo) / {step}) AS INTEGER), {bins - 1}) AS g FROM {source}, span),
    binned AS (SELECT CASE WHEN v < lo + g * {step} THEN g - 1
                           WHEN g < {bins - 1} AND v >= (CASE WHEN g + 1 = {bins} THEN hi ELSE lo + (g + 1) * {step} END)
                           THEN g + 1 ELSE g END AS bin FROM guessed),
    counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * {step}, 6) AS lower,
           round(CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * {step} END, 6) AS upper,
           coalesce(n, 0) AS count, CAST(0 AS BIGINT) AS not_finite
    FROM range({bins}) r(i) CROSS JOIN span LEFT JOIN counted ON bin = i"""


VALUES = "WITH v AS (SELECT value AS v FROM events WHERE value IS NOT NULL)"
P99_VALUES = VALUES + ", cut AS (SELECT v FROM v WHERE v <= (SELECT quantile_cont(v, 0.99) FROM v))"


@query("histogram_50", VALUES + _histogram_sql("v"))
def histogram_50(t):
    return rounded(distribution.histogram(t.table("events"), "value"), ["lower", "upper"])


@query("histogram_p99", P99_VALUES + _histogram_sql("cut"))
def histogram_p99(t):
    return rounded(distribution.histogram(t.table("events"), "value", up_to=0.99), ["lower", "upper"])


def _box_sql(source: str) -> str:
    return f"""
    , q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM {source}),
    fences AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT count(*) AS count, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
      round(least(min(CASE WHEN v >= lo THEN v END), max(q1)), 6) AS whisker_low,
      round(greatest(max(CASE WHEN v <= hi THEN v END), max(q3)), 6) AS whisker_high,
      count(*) FILTER (v < lo) AS outliers_low, count(*) FILTER (v > hi) AS outliers_high
    FROM {source}, fences"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("boxplot_stats", VALUES + _box_sql("v"))
def boxplot_stats(t):
    return rounded(distribution.box_stats(t.table("events"), "value"), BOX)


@query("boxplot_p99", P99_VALUES + _box_sql("cut"))
def boxplot_p99(t):
    return rounded(distribution.box_stats(t.table("events"), "value", up_to=0.99), BOX)


def _corr_sql(variables, where: str = "TRUE", source: str = "base") -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{name}' AS variable, CASE WHEN count(*) > 1 AND min({name}) < max({name}) THEN "
        f"round(corr({name}, tx_crimes_1000_hab), 6) END AS correlation FROM {source} "
        f"WHERE ({where}) AND {name} IS NOT NULL AND tx_crimes_1000_hab IS NOT NULL"
        for name in variables
    )
    return f"SELECT * FROM ({lines}) r WHERE correlation IS NOT NULL"


@query(
    "corr_vector",
    with_adapters(*FULL, then=FULL_BASE) + _corr_sql(analysis.MAIN_VARIABLES, "qt_pessoas >= 100"),
)
def corr_vector(t):
    return rounded(study.main_correlations(full_rate_base(t)), ["correlation"])


def _groups_sql(where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{group}' AS variable_group, variable, correlation FROM ({_corr_sql(names, where)}) g{i}"
        for i, (group, names) in enumerate(analysis.GROUPS.items())
    )


@query("corr_groups", with_adapters(*FULL, then=FULL_BASE) + _groups_sql("qt_pessoas >= 100"))
def corr_groups(t):
    populated = population_floor(full_rate_base(t), analysis.POPULATION_FLOOR_MODEL)
    found = correlation.correlate_groups(populated, analysis.TARGET_RATE, analysis.GROUPS)
    return rounded(found, ["correlation"])


@query(
    "corr_urban_full",
    with_adapters(*FULL, then=FULL_BASE) + _corr_sql(analysis.URBAN_RATIOS, "tx_crimes_1000_hab < 1500"),
)
def corr_urban_full(t):
    below = F.col(analysis.TARGET_RATE) < analysis.TOP_RATE
    found = correlation.correlate(full_rate_base(t), analysis.TARGET_RATE, analysis.URBAN_RATIOS, below)
    return rounded(found, ["correlation"])


FILTER = "ds_situacao = 'Urbana' AND cd_tipo <> '0' AND tx_crimes_1000_hab < 1500"


@query("corr_filtered", with_adapters(*FULL, then=FULL_BASE) + _corr_sql(analysis.URBAN_VARIABLES, FILTER))
def corr_filtered(t):
    return rounded(views.filtered_correlations(full_rate_base(t), FILTER), ["correlation"])


THEFT_BASE = (
    FULL_BASE
    + """, thefts AS (SELECT cd_setor, count(*) AS total_crimes FROM occ WHERE is_furto GROUP BY cd_setor),
    subset AS (SELECT final.*, CASE WHEN qt_pessoas > 0 THEN CAST(total_crimes AS DOUBLE) / qt_pessoas * 1000 END
        AS tx_crimes_1000_hab FROM final JOIN thefts USING (cd_setor))"""
)


@query(
    "corr_subset",
    with_adapters(*FULL, then=THEFT_BASE)
    + _corr_sql(analysis.URBAN_RATIOS, "tx_crimes_1000_hab < 1500", "subset"),
)
def corr_subset(t):
    thefts = count_events(t.adapter("occ"), "cd_setor", flags={"qt_furtos": "is_furto"})
    base = add_rates(thefts.join(unit_tables(t)["final"], "cd_setor"))
    below = F.col(analysis.TARGET_RATE) < analysis.TOP_RATE
    found = correlation.correlate(base, analysis.TARGET_RATE, analysis.URBAN_RATIOS, below)
    return rounded(found, ["correlation"])


@query(
    "summary_populated",
    with_adapters(*OCC_UNITS, then=BASE + ", populated AS (SELECT * FROM base WHERE qt_pessoas >= 50)")
    + _summary_sql("log_tx_crimes_1000_hab", "populated"),
)
def summary_populated(t):
    populated = population_floor(rate_base(t), analysis.POPULATION_FLOOR_DESCRIPTIVE)
    return rounded(distribution.summary_stats(populated, [analysis.LOG_RATE]), SUMMARY)
