"""Census tables and unit features."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.ratios import log1p_or_null, safe_ratio
from arealis.operators import area_features as features
from arealis.operators.combine import left_chain
from arealis.plans import units as unit_plans
from arealis.presets import census
from catalog.cleaning import category_sql, census_bigint_sql, census_double_sql
from catalog.registry import query, rounded, sql_rounded, with_adapters

_SQL_CONVERTERS = {
    "text": lambda name: name,
    "bigint": census_bigint_sql,
    "double": census_double_sql,
    "sector_type": lambda name: category_sql("categoria_tipo_setor", name),
}


def _projection(mapping) -> str:
    return ", ".join(f"{_SQL_CONVERTERS[kind](source)} AS {target}" for source, target, kind in mapping)


BASIC_SQL = f"SELECT {_projection(census.BASIC_SECTOR)} FROM basico_raw"
DISTRICT_SQL = f"SELECT {_projection(census.BASIC_DISTRICT)} FROM basico_distrito_raw"
KEY = ("cd_setor", "cd_setor", "text")
COUNTERS_SQL = (
    f"SELECT {_projection([KEY, *[(code, name, 'bigint') for code, name in census.SURROUNDINGS]])} FROM entorno_raw"
)
INCOME_SQL = f"SELECT {_projection([KEY, *census.INCOME])} FROM rendimento_raw"

RAW = ("basico_raw", "entorno_raw", "rendimento_raw")
JOINED = f"""basico AS ({BASIC_SQL}), entorno AS ({COUNTERS_SQL}), rendimento AS ({INCOME_SQL}),
joined AS (SELECT * FROM basico LEFT JOIN entorno USING (cd_setor) LEFT JOIN rendimento USING (cd_setor))"""


def ratio_sql(above: str, below: str) -> str:
    return f"CASE WHEN ({below}) <> 0 THEN CAST({above} AS DOUBLE) / ({below}) END"


def log1p_sql(name: str) -> str:
    return f"CASE WHEN {name} > -1 THEN ln(1 + {name}) END"


FACE = "qt_domicilios_face_"
TREES = [f"{FACE}arborizacao_{kind}" for kind in ("sem_arvores", "1_2_arvores", "3_4_arvores", "5_mais_arvores")]
DEMOGRAPHICS_SQL = {
    "densidade_populacional": ratio_sql("qt_pessoas", "area_km2"),
    "densidade_domicilios": ratio_sql("qt_domicilios", "area_km2"),
    "tx_domicilios_ocupados": ratio_sql("qt_domicilios_particularesocupados", "qt_domicilios"),
    "tx_domicilios_vagos": ratio_sql("qt_domicilios_particulares_vagos", "qt_domicilios"),
}
SHARES_SQL = {
    f"tx_{name}": ratio_sql(f"{FACE}{stem}_sim", f"{FACE}{stem}_sim + {FACE}{stem}_nao")
    for name, stem in (
        ("via_pavimentada", "via_pavimentada"),
        ("bueiro", "bueiro"),
        ("iluminacao_publica", "iluminacao_publica"),
        ("ponto_onibus", "ponto_onibus"),
        ("ciclovia", "via_sinalizada_bicicleta"),
        ("calcada", "calcada"),
        ("obstaculo_calcada", "obstaculo_calcada"),
        ("rampa_cadeirante", "rampa_cadeirante"),
    )
}
TREES_SQL = {
    "tx_arborizacao": ratio_sql(f"({TREES[1]} + {TREES[2]} + {TREES[3]})", " + ".join(TREES)),
    "indice_arborizacao_ponderado": ratio_sql(
        f"({TREES[1]} + 2 * {TREES[2]} + 3 * {TREES[3]})", " + ".join(TREES)
    ),
}
MEAN, MEDIAN = "vl_rendimento_nominal_medio_responsavel", "vl_rendimento_nominal_mediano_responsavel"
RESIDENTS = "avg_moradores_domiciliosparticularesocupados"
INCOME_FEATURES_SQL = {
    "log_renda_media": log1p_sql(MEAN),
    "log_renda_mediana": log1p_sql(MEDIAN),
    "vl_renda_media_por_morador": ratio_sql(MEAN, RESIDENTS),
    "vl_renda_mediana_por_morador": ratio_sql(MEDIAN, RESIDENTS),
    "densidade_renda_media_km2": ratio_sql(MEAN, "area_km2"),
    "densidade_renda_mediana_km2": ratio_sql(MEDIAN, "area_km2"),
}
COMPOSITES_SQL = {
    "indice_infraestrutura_urbana": "(tx_via_pavimentada + tx_bueiro + tx_iluminacao_publica + tx_calcada "
    "+ tx_rampa_cadeirante + tx_arborizacao) / 6",
    "indice_mobilidade_urbana": "(tx_ponto_onibus + tx_ciclovia) / 2",
    "indice_caminhabilidade": "(tx_calcada + tx_rampa_cadeirante + (1 - tx_obstaculo_calcada)) / 3",
    "indice_vulnerabilidade_urbana": "(tx_domicilios_vagos + (1 - tx_iluminacao_publica) "
    "+ (1 - tx_via_pavimentada) + (1 - tx_calcada) + (1 - tx_bueiro)) / 5",
}


def named(expressions: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in expressions.items())


ALL_FEATURES = {**DEMOGRAPHICS_SQL, **SHARES_SQL, **TREES_SQL, **INCOME_FEATURES_SQL}
# Common tables up to ``final``: the feature table of all units.
FINAL_CTES = f"""{JOINED},
featured AS (SELECT *, {named(ALL_FEATURES)} FROM joined),
final AS (SELECT *, {named(COMPOSITES_SQL)} FROM featured)"""
FINAL_COLUMNS = (
    "cd_setor", "cd_dist", "nm_dist", "cd_subdist", "ds_situacao", "cd_situacao", "cd_tipo",
    "categoria_tipo_setor", *census.FINAL_MEASURES,
)
COMPUTED = [*ALL_FEATURES, *COMPOSITES_SQL]


def raw_tables(t):
    return {name: t.adapter(f"{name}_raw") for name in ("basico", "entorno", "rendimento")}


def unit_tables(t):
    """All units of all municipalities: typed tables and the final one."""
    return unit_plans.build_units(raw_tables(t), "setor", municipality=None)


def joined_units(t):
    tables = unit_tables(t)
    return left_chain(tables["basico"], [tables["entorno"], tables["rendimento"]], "cd_setor")


@query("census_basic_sector", with_adapters("basico_raw") + BASIC_SQL)
def census_basic_sector(t):
    return unit_plans.basic_table(t.adapter("basico_raw"), "setor", municipality=None)


@query("census_basic_district", with_adapters("basico_distrito_raw") + DISTRICT_SQL)
def census_basic_district(t):
    return unit_plans.basic_table(t.adapter("basico_distrito_raw"), "distrito", municipality=None)


@query("census_counters", with_adapters("entorno_raw") + COUNTERS_SQL)
def census_counters(t):
    return unit_plans.surroundings_table(t.adapter("entorno_raw"), "setor")


@query("census_income", with_adapters("rendimento_raw") + INCOME_SQL)
def census_income(t):
    return unit_plans.income_table(t.adapter("rendimento_raw"), "setor")


@query("join_left_chain", with_adapters(*RAW, then=JOINED) + "SELECT * FROM joined")
def join_left_chain(t):
    return joined_units(t)


def _features(name: str, add, expressions: dict[str, str], then: str = JOINED, source: str = "joined"):
    """Register one feature group over the joined unit tables."""
    computed = list(expressions)

    @query(
        name,
        with_adapters(*RAW, then=f"{then}, result AS (SELECT cd_setor, {named(expressions)} FROM {source})")
        + f"SELECT cd_setor, {sql_rounded(computed)} FROM result",
    )
    def build(t):
        return rounded(add(joined_units(t)).select("cd_setor", *computed), computed)


_features("unit_demographics", features.add_demographics, DEMOGRAPHICS_SQL)
_features("yes_share_ratios", features.add_yes_shares, SHARES_SQL)
_features("tree_indices", features.add_tree_indices, TREES_SQL)
_features("income_features", features.add_income_features, INCOME_FEATURES_SQL)
_features(
    "composite_indices",
    unit_plans.add_unit_features,
    COMPOSITES_SQL,
    then=FINAL_CTES,
    source="featured",
)


@query(
    "census_final",
    with_adapters(*RAW, then=FINAL_CTES)
    + "SELECT "
    + ", ".join(f"round({c}, 6) AS {c}" if c in COMPUTED else c for c in FINAL_COLUMNS)
    + " FROM final",
)
def census_final(t):
    return rounded(unit_tables(t)["final"], COMPUTED)


# The municipality that the analyses keep; region names stand for municipalities.
ONE_MUNICIPALITY = "EUROPE"


@query(
    "census_final_municipality",
    with_adapters(*RAW, then=FINAL_CTES.replace("FROM basico_raw", f"FROM basico_raw WHERE nm_mun = '{ONE_MUNICIPALITY}'"))
    + "SELECT "
    + ", ".join(f"round({c}, 6) AS {c}" if c in COMPUTED else c for c in FINAL_COLUMNS)
    + " FROM final",
)
def census_final_municipality(t):
    found = unit_plans.build_units(raw_tables(t), "setor", municipality=ONE_MUNICIPALITY)
    return rounded(found["final"], COMPUTED)


DISTRICT_RAW = ("basico_distrito_raw", "entorno_distrito_raw", "rendimento_distrito_raw")
DISTRICT_CTES = (
    FINAL_CTES.replace(BASIC_SQL, DISTRICT_SQL)
    .replace(COUNTERS_SQL, COUNTERS_SQL.replace("cd_setor", "cd_dist").replace("entorno_raw", "entorno_distrito_raw"))
    .replace(INCOME_SQL, INCOME_SQL.replace("cd_setor", "cd_dist").replace("rendimento_raw", "rendimento_distrito_raw"))
    .replace("USING (cd_setor)", "USING (cd_dist)")
)
DISTRICT_COLUMNS = ("cd_dist", "nm_dist", "cd_regiao", "nm_regiao", *census.FINAL_MEASURES)


@query(
    "census_final_district",
    with_adapters(*DISTRICT_RAW, then=DISTRICT_CTES)
    + "SELECT "
    + ", ".join(f"round({c}, 6) AS {c}" if c in COMPUTED else c for c in DISTRICT_COLUMNS)
    + " FROM final",
)
def census_final_district(t):
    raw = {name: t.adapter(f"{name}_distrito_raw") for name in ("basico", "entorno", "rendimento")}
    return rounded(unit_plans.build_units(raw, "distrito", municipality=None)["final"], COMPUTED)


@query(
    "safe_divide",
    with_adapters("units")
    + f"SELECT cd_setor, round({ratio_sql('qt_domicilios_particulares_vagos', 'qt_domicilios')}, 6) AS vagos FROM units",
)
def safe_divide(t):
    vacant = safe_ratio(F.col("qt_domicilios_particulares_vagos"), F.col("qt_domicilios"))
    return t.adapter("units").select("cd_setor", F.round(vacant, 6).alias("vagos"))


@query(
    "log_transform",
    with_adapters("units") + f"SELECT cd_setor, round({log1p_sql('qt_pessoas')}, 6) AS log_pessoas FROM units",
)
def log_transform(t):
    log = log1p_or_null(F.col("qt_pessoas"))
    return t.adapter("units").select("cd_setor", F.round(log, 6).alias("log_pessoas"))
