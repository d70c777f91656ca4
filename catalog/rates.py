"""Event counts, rates, district tables, rankings and the SQL surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import combine, quality, rates, tables
from arealis.plans import study, views
from arealis.presets import analysis
from catalog.registry import query, rounded, sql_rounded, with_adapters
from catalog.units import FINAL_CTES, RAW, log1p_sql, ratio_sql, unit_tables

OCC_UNITS = ("occ", "units")
COUNTS = (
    "count(*) AS qt_crimes, count(CASE WHEN is_roubo THEN 1 END) AS qt_roubos, "
    "count(CASE WHEN is_furto THEN 1 END) AS qt_furtos"
)
PER_PERIOD = (
    f"counted AS (SELECT cd_setor, ano, trimestre, {COUNTS} FROM occ "
    "WHERE (is_roubo OR is_furto) AND cd_setor IS NOT NULL GROUP BY cd_setor, ano, trimestre)"
)
PER_UNIT = (
    f"counted AS (SELECT cd_setor, {COUNTS} FROM occ "
    "WHERE (is_roubo OR is_furto) AND cd_setor IS NOT NULL GROUP BY cd_setor)"
)


def per_1000(count: str) -> str:
    return f"CASE WHEN qt_pessoas > 0 THEN CAST({count} AS DOUBLE) / qt_pessoas * 1000 END"


RATES_SQL = (
    f"{per_1000('qt_crimes')} AS tx_crimes_1000_hab, {per_1000('qt_roubos')} AS tx_roubos_1000_hab, "
    f"{per_1000('qt_furtos')} AS tx_furtos_1000_hab, {ratio_sql('qt_crimes', 'area_km2')} AS tx_crimes_km2"
)
BASE = (
    f"{PER_PERIOD}, rated AS (SELECT *, {RATES_SQL} FROM counted JOIN units USING (cd_setor)), "
    f"base AS (SELECT *, {log1p_sql('tx_crimes_1000_hab')} AS log_tx_crimes_1000_hab FROM rated)"
)
# The rate base over the full unit features, for correlations and models.
FULL_BASE = (
    f"{FINAL_CTES}, {PER_PERIOD}, rated AS (SELECT *, {RATES_SQL} FROM counted JOIN final USING (cd_setor)), "
    f"base AS (SELECT *, {log1p_sql('tx_crimes_1000_hab')} AS log_tx_crimes_1000_hab FROM rated)"
)
FULL = ("occ", *RAW)
RATE_COLUMNS = (
    "tx_crimes_1000_hab", "tx_roubos_1000_hab", "tx_furtos_1000_hab", "tx_crimes_km2", "log_tx_crimes_1000_hab",
)
KEYS_AND_COUNTS = "cd_setor, ano, trimestre, nm_dist, nm_mun, qt_pessoas, qt_crimes, qt_roubos, qt_furtos"


def rate_base(t):
    return study.rate_base(t.adapter("occ"), t.adapter("units"))


def full_rate_base(t):
    return study.rate_base(t.adapter("occ"), unit_tables(t)["final"])


@query(
    "rates_by_unit_period",
    with_adapters(*OCC_UNITS, then=BASE)
    + f"SELECT {KEYS_AND_COUNTS}, {sql_rounded(RATE_COLUMNS)} FROM base WHERE nm_mun IS NOT NULL",
)
def rates_by_unit_period(t):
    base = rates.rates_by_unit_period(t.adapter("occ"), t.adapter("units"), "cd_setor", how="left")
    kept = base.where(F.col("nm_mun").isNotNull())
    return rounded(kept.select(*KEYS_AND_COUNTS.split(", "), *RATE_COLUMNS), RATE_COLUMNS)


@query(
    "rates_inner",
    with_adapters(*OCC_UNITS)
    + """, counted AS (SELECT cd_setor, count(*) AS total_crimes FROM occ WHERE is_furto GROUP BY cd_setor)
    SELECT units.cd_setor, nm_dist, qt_pessoas, total_crimes,
      round(CASE WHEN qt_pessoas > 0 THEN CAST(total_crimes AS DOUBLE) / qt_pessoas * 1000 END, 6) AS tx_crimes_1000_hab
    FROM counted JOIN units ON counted.cd_setor = units.cd_setor""",
)
def rates_inner(t):
    occurrences = t.adapter("occ").withColumnRenamed("cd_setor", "SJ_CD_SETOR")
    rated = views.rates_of_thefts(occurrences, t.adapter("units"))
    return rounded(
        rated.select("cd_setor", "nm_dist", "qt_pessoas", "total_crimes", "tx_crimes_1000_hab"),
        ["tx_crimes_1000_hab"],
    )


ZERO_FILLED = (
    f"{PER_UNIT}, filled AS (SELECT cd_setor, nm_dist, qt_pessoas, area_km2, coalesce(qt_crimes, 0) AS qt_crimes, "
    "coalesce(qt_roubos, 0) AS qt_roubos, coalesce(qt_furtos, 0) AS qt_furtos "
    "FROM units LEFT JOIN counted USING (cd_setor))"
)


@query(
    "zero_fill_join",
    with_adapters(*OCC_UNITS, then=ZERO_FILLED)
    + "SELECT cd_setor, nm_dist, qt_pessoas, qt_crimes, qt_roubos, qt_furtos FROM filled",
)
def zero_fill_join(t):
    counts = rates.count_events(t.adapter("occ"), "cd_setor")
    filled = combine.zero_fill_join(
        t.adapter("units").select("cd_setor", "nm_dist", "qt_pessoas"),
        counts,
        "cd_setor",
        ["qt_crimes", "qt_roubos", "qt_furtos"],
    )
    return filled


SPATIAL_ROUNDED = (
    "tx_crimes_1000_hab", "tx_roubos_1000_hab", "tx_furtos_1000_hab", "log_tx_crimes_1000_hab",
    "indice_infraestrutura_urbana", "indice_mobilidade_urbana", "indice_caminhabilidade",
    "indice_vulnerabilidade_urbana", "log_renda_media", "densidade_populacional",
)


@query(
    "spatial_base",
    with_adapters(
        *FULL,
        then=f"""{FINAL_CTES}, {PER_UNIT}, filled AS (SELECT final.*, coalesce(c.qt_crimes, 0) AS qt_crimes,
            coalesce(c.qt_roubos, 0) AS qt_roubos, coalesce(c.qt_furtos, 0) AS qt_furtos
            FROM final LEFT JOIN counted c ON final.cd_setor = c.cd_setor WHERE qt_pessoas >= 100),
        rated AS (SELECT *, {RATES_SQL} FROM filled),
        logged AS (SELECT *, {log1p_sql('tx_crimes_1000_hab')} AS log_tx_crimes_1000_hab FROM rated)""",
    )
    + "SELECT cd_setor, nm_dist, nm_mun, qt_pessoas, area_km2, qt_crimes, qt_roubos, qt_furtos, "
    + f"{sql_rounded(SPATIAL_ROUNDED)} FROM logged",
)
def spatial_base(t):
    base = study.spatial_base(t.adapter("occ"), unit_tables(t)["final"])
    return rounded(base, SPATIAL_ROUNDED)


@query(
    "semi_join_top_n",
    with_adapters("occ")
    + """SELECT id, cd_setor FROM occ WHERE cd_setor IN (
        SELECT cd_setor FROM occ GROUP BY cd_setor ORDER BY count(*) DESC, cd_setor LIMIT 15)""",
)
def semi_join_top_n(t):
    return combine.semi_join_top(t.adapter("occ").select("id", "cd_setor"), "cd_setor", 15)


DISTRICTS = (
    "districts AS (SELECT nm_dist, CAST(sum(qt_crimes) AS BIGINT) AS qt_crimes, "
    "CAST(sum(qt_roubos) AS BIGINT) AS qt_roubos, CAST(sum(qt_furtos) AS BIGINT) AS qt_furtos "
    "FROM base WHERE nm_dist IS NOT NULL GROUP BY nm_dist)"
)


def districts(t):
    located = rate_base(t).where(F.col("nm_dist").isNotNull())
    return rates.sum_by(located, ["nm_dist"], ["qt_crimes", "qt_roubos", "qt_furtos"])


@query("rollup_district", with_adapters(*OCC_UNITS, then=f"{BASE}, {DISTRICTS}") + "SELECT * FROM districts")
def rollup_district(t):
    return districts(t)


@query(
    "share_of_total",
    with_adapters(*OCC_UNITS, then=f"{BASE}, {DISTRICTS}")
    + "SELECT *, round(100.0 * qt_crimes / (SELECT sum(qt_crimes) FROM districts), 6) AS participacao_pct FROM districts",
)
def share_of_total(t):
    return rounded(rates.share_of_total(districts(t), "qt_crimes"), ["participacao_pct"])


@query(
    "district_rate",
    with_adapters(*OCC_UNITS, then=BASE)
    + """SELECT nm_dist, CAST(sum(qt_crimes) AS BIGINT) AS qt_crimes, CAST(sum(qt_pessoas) AS BIGINT) AS qt_pessoas,
      round(CAST(sum(qt_crimes) AS DOUBLE) / sum(qt_pessoas) * 1000, 6) AS tx_crimes_1000_hab
    FROM base GROUP BY nm_dist""",
)
def district_rate(t):
    return rounded(rates.district_rate(rate_base(t)), ["tx_crimes_1000_hab"])


@query(
    "district_rate_fixed",
    with_adapters(*OCC_UNITS, then=BASE)
    + """, residents AS (SELECT nm_dist, sum(qt_pessoas) AS n FROM
        (SELECT DISTINCT cd_setor, nm_dist, qt_pessoas FROM base) u GROUP BY nm_dist)
    SELECT nm_dist, CAST(sum(qt_crimes) AS BIGINT) AS qt_crimes, CAST(max(n) AS BIGINT) AS qt_pessoas,
      round(CAST(sum(qt_crimes) AS DOUBLE) / max(n) * 1000, 6) AS tx_crimes_1000_hab
    FROM base JOIN residents USING (nm_dist) GROUP BY nm_dist""",
)
def district_rate_fixed(t):
    return rounded(rates.district_rate_per_resident(rate_base(t), "cd_setor"), ["tx_crimes_1000_hab"])


@query(
    "yearly_trend",
    with_adapters(*OCC_UNITS, then=BASE)
    + "SELECT ano, CAST(sum(qt_crimes) AS BIGINT) AS qt_crimes FROM base GROUP BY ano ORDER BY ano",
)
def yearly_trend(t):
    return rates.sum_by(rate_base(t), ["ano"], ["qt_crimes"]).orderBy("ano")


@query(
    "hourly_distribution",
    with_adapters("ev") + "SELECT hora, count(*) AS count FROM ev WHERE hora IS NOT NULL GROUP BY hora",
)
def hourly_distribution(t):
    return tables.hourly_counts(t.adapter("ev"), "hora")


@query(
    "top_units_by_rate",
    with_adapters(*OCC_UNITS, then=BASE)
    + """SELECT cd_setor, nm_dist, ano, trimestre, qt_pessoas, qt_crimes, round(tx_crimes_1000_hab, 6) AS tx_crimes_1000_hab
    FROM base ORDER BY base.tx_crimes_1000_hab DESC NULLS LAST, cd_setor, ano, trimestre LIMIT 20""",
)
def top_units_by_rate(t):
    columns = ["cd_setor", "nm_dist", "ano", "trimestre", "qt_pessoas", "qt_crimes", "tx_crimes_1000_hab"]
    top = rates.top_rows(
        rate_base(t).select(*columns), 20, "tx_crimes_1000_hab", "cd_setor", "ano", "trimestre"
    )
    return rounded(top, ["tx_crimes_1000_hab"])


@query(
    "top_n_counts",
    with_adapters(*OCC_UNITS, then=f"{BASE}, {DISTRICTS}")
    + "SELECT nm_dist, qt_crimes FROM districts ORDER BY qt_crimes DESC, nm_dist LIMIT 10",
)
def top_n_counts(t):
    return rates.top_rows(districts(t).select("nm_dist", "qt_crimes"), 10, "qt_crimes", "nm_dist")


@query(
    "population_floor",
    with_adapters("units") + "SELECT cd_setor, nm_dist, qt_pessoas FROM units WHERE qt_pessoas >= 100",
)
def population_floor(t):
    return rates.population_floor(t.adapter("units").select("cd_setor", "nm_dist", "qt_pessoas"), 100)


@query(
    "scatter_base",
    with_adapters(*FULL, then=FULL_BASE)
    + """SELECT round(indice_infraestrutura_urbana, 6) AS indice_infraestrutura_urbana, categoria_tipo_setor,
      round(tx_crimes_1000_hab, 6) AS tx_crimes_1000_hab
    FROM base WHERE indice_infraestrutura_urbana IS NOT NULL AND categoria_tipo_setor IS NOT NULL
      AND base.tx_crimes_1000_hab < 1500""",
)
def scatter_base(t):
    points = study.scatter_base(full_rate_base(t), "indice_infraestrutura_urbana", "categoria_tipo_setor")
    return rounded(points, ["indice_infraestrutura_urbana", "tx_crimes_1000_hab"])


@query(
    "filter_predicates",
    with_adapters(*OCC_UNITS, then=BASE)
    + """SELECT cd_setor, ano, trimestre, nm_mun FROM base
    WHERE tx_crimes_1000_hab IS NOT NULL AND ano BETWEEN 1996 AND 2000
      AND (nm_mun = 'ASIA' OR nm_dist IN ('NATION_1', 'NATION_7') OR regexp_matches(nm_mun, '^(eur|africa)', 'i'))
      AND base.tx_crimes_1000_hab < 1500""",
)
def filter_predicates(t):
    base = rate_base(t)
    place = (
        (F.col("nm_mun") == "ASIA")
        | F.col("nm_dist").isin("NATION_1", "NATION_7")
        | F.col("nm_mun").rlike("(?iu)^(eur|africa)")
    )
    kept = base.where(
        F.col(analysis.TARGET_RATE).isNotNull()
        & F.col("ano").between(1996, 2000)
        & place
        & (F.col(analysis.TARGET_RATE) < analysis.TOP_RATE)
    )
    return kept.select("cd_setor", "ano", "trimestre", "nm_mun")


@query(
    "sql_top_districts",
    with_adapters(*OCC_UNITS)
    + """SELECT nm_dist AS "SJ_NM_DIST", count(*) AS total_crimes FROM occ LEFT JOIN units USING (cd_setor)
    WHERE cd_setor IS NOT NULL AND (is_roubo OR is_furto) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def sql_top_districts(t):
    occurrences = t.adapter("occ").withColumnRenamed("cd_setor", "SJ_CD_SETOR")
    return views.top_districts(occurrences, t.adapter("units"))


@query("sql_events_per_year", with_adapters("occ") + "SELECT ano, count(*) AS qt FROM occ GROUP BY 1")
def sql_events_per_year(t):
    return views.events_per_year(t.adapter("occ"))


@query(
    "key_parity",
    with_adapters(*OCC_UNITS, then=ZERO_FILLED)
    + """, a AS (SELECT count(DISTINCT cd_setor) AS base_keys FROM units WHERE qt_pessoas >= 100),
    b AS (SELECT count(DISTINCT cd_setor) AS export_keys FROM filled WHERE qt_pessoas >= 100)
    SELECT base_keys, export_keys, base_keys = export_keys AS equal FROM a, b""",
)
def key_parity(t):
    units = t.adapter("units")
    exported = study.spatial_base(t.adapter("occ"), units)
    return quality.key_parity(rates.population_floor(units, 100), exported, "cd_setor")
