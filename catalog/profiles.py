"""Data quality, frequency tables and category grids."""

from __future__ import annotations

from arealis.operators import cleaning, combine, quality, tables
from arealis.presets import vehicle
from catalog.cleaning import category_sql
from catalog.registry import query, with_adapters

PROFILED = ("id", "data_txt", "ts_txt", "int_txt", "hora_txt", "coord_txt", "num_txt", "rubrica", "flag_txt")
MISSING = "lower(trim(CAST({0} AS VARCHAR))) IN ('', 'nan') OR {0} IS NULL"


@query(
    "null_profile",
    with_adapters("occ_dirty")
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({MISSING.format(name)}) AS missing, "
        f"round(count(*) FILTER ({MISSING.format(name)}) * 100.0 / count(*), 2) AS missing_pct FROM occ_dirty"
        for name in PROFILED
    ),
)
def null_profile(t):
    return quality.null_profile(t.adapter("occ_dirty").select(*PROFILED))


@query(
    "validate_nulls",
    with_adapters("occ_dirty")
    + """SELECT substr(ts_txt, 1, 4) AS ano, count(*) AS total, count(*) FILTER (data_txt IS NULL) AS total_null,
      count(*) FILTER (data_txt = '') AS total_empty FROM occ_dirty GROUP BY 1""",
)
def validate_nulls(t):
    dirty = t.adapter("occ_dirty").selectExpr("substr(ts_txt, 1, 4) AS ano", "data_txt")
    return quality.missing_by(dirty, ["ano"], "data_txt")


@query(
    "geo_coverage",
    with_adapters("occ_dirty")
    + """SELECT count(lat) AS with_value, count(*) AS total, round(count(lat) * 100.0 / count(*), 1) AS coverage_pct
    FROM (SELECT CASE WHEN regexp_matches(replace(trim(coord_txt), ',', '.'), '^-?[0-9]+([.][0-9]+)?$')
                      THEN 1 END AS lat FROM occ_dirty) c""",
)
def geo_coverage(t):
    located = cleaning.cast_coordinates(t.adapter("occ_dirty").select("coord_txt"), ["coord_txt"])
    return quality.coverage(located, "coord_txt")


@query(
    "frequency_table",
    with_adapters("sheet") + "SELECT descr_tipo_veiculo, count(*) AS count FROM sheet GROUP BY 1",
)
def frequency_table(t):
    return tables.frequency_table(t.adapter("sheet"), "descr_tipo_veiculo")


SHEET_CATEGORIES = ("descr_conduta", "rubrica", "descr_ocorrencia_veiculo", "descr_tipo_veiculo", "descr_tipolocal")


@query(
    "frequency_multi",
    with_adapters("sheet")
    + " UNION ALL ".join(
        f"SELECT '{name}' AS variable, {name} AS value, count(*) AS count FROM sheet GROUP BY {name}"
        for name in SHEET_CATEGORIES
    ),
)
def frequency_multi(t):
    return tables.frequency_tables(t.adapter("sheet"), SHEET_CATEGORIES)


def _grid_sql(row: str, across: str, values) -> str:
    cells = ", ".join(f"count(*) FILTER ({across} = '{value}') AS \"{value}\"" for value in values)
    listed = ", ".join(f"'{value}'" for value in values)
    return f"SELECT {row}, {cells} FROM labelled WHERE {across} IN ({listed}) GROUP BY {row}"


LABELLED = "labelled AS (SELECT bairro, {0} AS categoria_tipo_veiculo, {1} AS categoria_rubrica FROM sheet)".format(
    category_sql("categoria_tipo_veiculo"),
    category_sql("categoria_rubrica"),
)
OFFENCES = [*dict.fromkeys(rule.label for rule in vehicle.OFFENCE), "OUTROS"]
MAIN_OFFENCES = ["FURTO", "ROUBO", "RECUPERACAO"]


def labelled(t):
    sheet = t.adapter("sheet").select("bairro", "descr_tipo_veiculo", "rubrica")
    return cleaning.add_categories(sheet, vehicle.CATEGORIES)


@query(
    "pair_counts",
    with_adapters("sheet", then=LABELLED)
    + "SELECT categoria_tipo_veiculo, categoria_rubrica, count(*) AS count FROM labelled GROUP BY 1, 2",
)
def pair_counts(t):
    return tables.pair_counts(labelled(t), "categoria_tipo_veiculo", "categoria_rubrica")


@query(
    "pivot_heatmap",
    with_adapters("sheet", then=LABELLED) + _grid_sql("categoria_tipo_veiculo", "categoria_rubrica", OFFENCES),
)
def pivot_heatmap(t):
    return tables.category_grid(labelled(t), "categoria_tipo_veiculo", "categoria_rubrica", OFFENCES)


@query(
    "pivot_filtered",
    with_adapters("sheet", then=LABELLED) + _grid_sql("bairro", "categoria_rubrica", MAIN_OFFENCES),
)
def pivot_filtered(t):
    return tables.category_grid(labelled(t), "bairro", "categoria_rubrica", MAIN_OFFENCES)


TOP_BAIRROS = (
    "top AS (SELECT bairro FROM (SELECT bairro, count(*) AS n FROM sheet GROUP BY bairro) c "
    "ORDER BY n DESC, bairro ASC NULLS LAST LIMIT 15)"
)


@query(
    "pivot_top",
    with_adapters("sheet", then=f"{LABELLED}, {TOP_BAIRROS}")
    + f"SELECT * FROM ({_grid_sql('bairro', 'categoria_rubrica', MAIN_OFFENCES)}) g WHERE bairro IN (SELECT bairro FROM top)",
)
def pivot_top(t):
    """The grid of the fifteen neighbourhoods with most rows; the keys are found before anything is derived."""
    busiest = combine.semi_join_top(t.adapter("sheet").select("bairro", "descr_tipo_veiculo", "rubrica"), "bairro", 15)
    derived = cleaning.add_categories(busiest, vehicle.CATEGORIES)
    return tables.category_grid(derived, "bairro", "categoria_rubrica", MAIN_OFFENCES)
