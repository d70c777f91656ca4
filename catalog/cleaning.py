"""Names, cleaning, casts, categories and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import casts
from arealis.functions.rules import categorize
from arealis.operators import cleaning, combine, quality, schema
from arealis.plans.occurrences import clean_occurrences
from arealis.plans.units import sector_type
from arealis.presets import vehicle
from arealis.sources.readers import as_text
from catalog.registry import query, with_adapters

DIRTY = with_adapters("occ_dirty")
SHEET = with_adapters("sheet")


def null_tokens_sql(name: str) -> str:
    return (
        f"CASE WHEN trim({name}) IN ('', 'nan', 'NaN', 'NAN', 'null', 'NULL', 'None') "
        f"THEN NULL ELSE {name} END"
    )


def date_sql(name: str) -> str:
    text = f"trim({name})"
    return (
        f"CASE WHEN regexp_matches({text}, '^20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime(substr({text}, 1, 10), '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_matches({text}, '^[0-9]{{2}}/[0-9]{{2}}/20[0-9]{{2}}') "
        f"THEN CAST(try_strptime(substr({text}, 1, 10), '%d/%m/%Y') AS DATE) END"
    )


def timestamp_sql(name: str) -> str:
    formats = ("%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y")
    return "coalesce(" + ", ".join(f"try_strptime({name}, '{form}')" for form in formats) + ")"


def integer_sql(name: str) -> str:
    return f"CASE WHEN regexp_matches(trim({name}), '^[0-9]+$') THEN try_cast(trim({name}) AS INTEGER) END"


def clock_sql(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({name}), '^[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') "
        f"THEN substr(trim({name}), 1, 8) END"
    )


def hour_sql(clock: str) -> str:
    return f"CAST(hour(try_strptime({clock}, '%H:%M:%S')) AS INTEGER)"


def coordinate_sql(name: str) -> str:
    text = f"replace(trim({name}), ',', '.')"
    return f"CASE WHEN regexp_matches({text}, '^-?[0-9]+([.][0-9]+)?$') THEN CAST({text} AS DOUBLE) END"


# The published category rules, written out apart from the presets so that a changed preset shows.
CATEGORY_SQL = {
    "periodo_dia": """CASE WHEN {0} BETWEEN 0 AND 5 THEN 'MADRUGADA' WHEN {0} BETWEEN 6 AND 11 THEN 'MANHA'
        WHEN {0} BETWEEN 12 AND 17 THEN 'TARDE' WHEN {0} BETWEEN 18 AND 23 THEN 'NOITE' END""",
    "categoria_conduta": """CASE WHEN {0} IN ('VEÍCULO', 'INTERIOR DE VEÍCULO') THEN 'VEICULO'
        WHEN {0} IN ('TRANSEUNTE', 'PESSOA') THEN 'PESSOA'
        WHEN {0} IN ('RESIDÊNCIA', 'CONDOMÍNIO RESIDÊNCIAL') THEN 'RESIDENCIAL'
        WHEN {0} IN ('ESTABELECIMENTO COMERCIAL', 'INTERIOR ESTABELECIMENTO', 'ESTABELECIMENTO-OUTROS')
            THEN 'COMERCIAL'
        WHEN {0} = 'CARGA' THEN 'CARGA'
        WHEN {0} IN ('COLETIVO', 'APLICATIVO DE MOBILIDADE URBANA') THEN 'TRANSPORTE'
        WHEN {0} IN ('OUTROS', 'FIOS E CABOS') THEN 'OUTROS' ELSE 'NAO_INFORMADO' END""",
    "categoria_rubrica": """CASE WHEN regexp_matches({0}, '^FURTO', 'i') THEN 'FURTO'
        WHEN regexp_matches({0}, '^ROUBO', 'i') THEN 'ROUBO'
        WHEN regexp_matches({0}, 'LOCALIZAÇÃO|APREENSÃO|ENTREGA', 'i') THEN 'RECUPERACAO'
        WHEN regexp_matches({0}, 'RECEPTAÇÃO', 'i') THEN 'RECEPTACAO'
        WHEN regexp_matches({0}, 'ADULTERAÇÃO', 'i') THEN 'ADULTERACAO'
        WHEN regexp_matches({0}, 'ESTELIONATO|APROPRIAÇÃO INDÉBITA', 'i') THEN 'FRAUDE'
        WHEN regexp_matches({0}, 'COLISÃO|CHOQUE|ABALROAMENTO|TOMBAMENTO', 'i') THEN 'ACIDENTE'
        WHEN regexp_matches({0}, 'HOMICÍDIO|LESÃO CORPORAL|AMEAÇA|VIOLÊNCIA', 'i') THEN 'VIOLENCIA'
        WHEN regexp_matches({0}, 'TRÁFICO|DROGAS', 'i') THEN 'DROGAS'
        WHEN regexp_matches({0}, 'ARMA DE FOGO|ARMA', 'i') THEN 'ARMAS' ELSE 'OUTROS' END""",
    "categoria_ocorrencia_veiculo": """CASE {0} WHEN 'Localizado / Entregue' THEN 'RECUPERADO'
        WHEN 'Furtado' THEN 'FURTADO' WHEN 'Roubado' THEN 'ROUBADO' ELSE 'OUTROS' END""",
    "categoria_tipo_veiculo": """CASE WHEN {0} IN ('AUTOMOVEL', 'CAMINHONETE', 'CAMIONETA', 'UTILITÁRIO') THEN 'LEVE'
        WHEN {0} IN ('MOTOCICLO', 'MOTONETA', 'CICLOMOTO') THEN 'MOTOCICLETA'
        WHEN {0} IN ('CAMINHÃO', 'CAMINHÃO TRATOR', 'SEMI-REBOQUE', 'REBOQUE') THEN 'PESADO'
        WHEN {0} IN ('ONIBUS', 'MICRO-ONIBUS') THEN 'TRANSPORTE_PUBLICO'
        WHEN regexp_matches({0}, 'TRATOR', 'i') THEN 'MAQUINARIO'
        WHEN {0} = 'BICICLETA' THEN 'BICICLETA' ELSE 'OUTROS' END""",
    "categoria_tipolocal": """CASE WHEN {0} = 'Via Pública' THEN 'VIA_PUBLICA'
        WHEN {0} IN ('Residência', 'Condomínio Residencial', 'Favela') THEN 'RESIDENCIAL'
        WHEN {0} IN ('Comércio e Serviços', 'Centro Comercial/Empresarial', 'Shopping Center', 'Escritório',
            'Estabelecimento Bancário', 'Restaurante e Afins', 'Condomínio Comercial') THEN 'COMERCIAL'
        WHEN {0} = 'Estacionamento/Garagem' THEN 'ESTACIONAMENTO'
        WHEN {0} = 'Rodovia/Estrada' THEN 'RODOVIA'
        WHEN {0} IN ('Repartição Pública', 'Serviços e Bens Públicos', 'Saúde', 'Terminal/Estação',
            'Estabelecimento de Ensino', 'Entidade Assistencial') THEN 'PUBLICO'
        WHEN {0} IN ('Area não Ocupada', 'Unidade Rural') THEN 'AREA_ABERTA' ELSE 'OUTROS' END""",
    "categoria_tipo_setor": """CASE try_cast({0} AS INTEGER) WHEN 0 THEN 'NAO_ESPECIAL'
        WHEN 1 THEN 'FAVELA_COMUNIDADE_URBANA' WHEN 2 THEN 'QUARTEL_BASE_MILITAR'
        WHEN 3 THEN 'ALOJAMENTO_ACAMPAMENTO' WHEN 4 THEN 'SETOR_BAIXO_PATAMAR_DOMICILIAR'
        WHEN 5 THEN 'AGRUPAMENTO_INDIGENA' WHEN 6 THEN 'UNIDADE_PRISIONAL'
        WHEN 7 THEN 'CONVENTO_HOSPITAL_ILPI_IACA' WHEN 8 THEN 'AGROVILA_PA'
        WHEN 9 THEN 'AGRUPAMENTO_QUILOMBOLA' ELSE 'OUTROS' END""",
}
CATEGORY_SOURCES = {
    "periodo_dia": "hora_ocorrencia_num",
    "categoria_conduta": "descr_conduta",
    "categoria_rubrica": "rubrica",
    "categoria_ocorrencia_veiculo": "descr_ocorrencia_veiculo",
    "categoria_tipo_veiculo": "descr_tipo_veiculo",
    "categoria_tipolocal": "descr_tipolocal",
}


def category_sql(target: str, source: str | None = None) -> str:
    return CATEGORY_SQL[target].format(source or CATEGORY_SOURCES[target])


@query(
    "src_all_string",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, "
    "CAST(p_size AS VARCHAR) AS p_size FROM part",
)
def src_all_string(t):
    part = t.table("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return as_text(part)


@query("preview", "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey LIMIT 10")
def preview(t):
    return schema.preview(t.table("customer").select("c_custkey", "c_name", "c_nationkey"), 10, "c_custkey")


@query(
    "normalize_names",
    "SELECT o_orderkey AS orgao_no_bo, o_custkey AS a_b, o_orderstatus AS situacao_2 FROM orders",
)
def normalize_names(t):
    messy = (" Órgão  Nº (BO) ", "__A--B__", "SITUAÇÃO.2")
    return schema.normalize_names(t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus").toDF(*messy))


@query("drop_present", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_present(t):
    return schema.drop_present(t.table("customer"), ["c_name", "c_acctbal", "not_there"])


@query("clean_trim", DIRTY + "SELECT id, trim(data_txt) AS data_txt, trim(num_txt) AS num_txt, trim(rubrica) AS rubrica FROM occ_dirty")
def clean_trim(t):
    return cleaning.trim_text(t.adapter("occ_dirty").select("id", "data_txt", "num_txt", "rubrica"))


@query(
    "clean_null_tokens",
    DIRTY
    + "SELECT id, "
    + ", ".join(f"{null_tokens_sql(c)} AS {c}" for c in ("data_txt", "int_txt", "coord_txt", "num_txt"))
    + " FROM occ_dirty",
)
def clean_null_tokens(t):
    return cleaning.blank_tokens(t.adapter("occ_dirty").select("id", "data_txt", "int_txt", "coord_txt", "num_txt"))


@query("clean_upper", DIRTY + "SELECT id, upper(rubrica) AS rubrica, ts_txt FROM occ_dirty")
def clean_upper(t):
    return cleaning.upper_text(t.adapter("occ_dirty").select("id", "rubrica", "ts_txt"), ["rubrica", "cidade"])


@query("cast_date", DIRTY + f"SELECT id, {date_sql('data_txt')} AS data_txt FROM occ_dirty")
def cast_date(t):
    return cleaning.cast_dates(t.adapter("occ_dirty").select("id", "data_txt"), ["data_txt", "absent"])


@query("cast_timestamp", DIRTY + f"SELECT id, {timestamp_sql('ts_txt')} AS ts_txt FROM occ_dirty")
def cast_timestamp(t):
    parsed = cleaning.cast_timestamps(t.adapter("occ_dirty").select("id", "ts_txt"), ["ts_txt"])
    return parsed.withColumn("ts_txt", F.col("ts_txt").cast("timestamp_ntz"))


@query("cast_integer", DIRTY + f"SELECT id, {integer_sql('int_txt')} AS int_txt FROM occ_dirty")
def cast_integer(t):
    return cleaning.cast_integers(t.adapter("occ_dirty").select("id", "int_txt"), ["int_txt"])


@query("cast_time", DIRTY + f"SELECT id, {clock_sql('hora_txt')} AS hora_txt FROM occ_dirty")
def cast_time(t):
    return cleaning.cast_clocks(t.adapter("occ_dirty").select("id", "hora_txt"), ["hora_txt"])


@query("cast_coordinate", DIRTY + f"SELECT id, {coordinate_sql('coord_txt')} AS coord_txt FROM occ_dirty")
def cast_coordinate(t):
    return cleaning.cast_coordinates(t.adapter("occ_dirty").select("id", "coord_txt"), ["coord_txt"])


def census_text_sql(name: str) -> str:
    return f"CASE WHEN trim({name}) IN ('X', 'x', '.', '-', '') THEN NULL ELSE trim({name}) END"


def census_double_sql(name: str) -> str:
    return f"try_cast(replace({census_text_sql(name)}, ',', '.') AS DOUBLE)"


def census_bigint_sql(name: str) -> str:
    return f"CAST(trunc(try_cast({census_text_sql(name)} AS DOUBLE)) AS BIGINT)"


@query("census_null_marks", DIRTY + f"SELECT id, {census_text_sql('num_txt')} AS num_txt FROM occ_dirty")
def census_null_marks(t):
    return t.adapter("occ_dirty").select("id", casts.census_text(F.col("num_txt")).alias("num_txt"))


@query(
    "br_numbers",
    DIRTY
    + f"SELECT id, {census_bigint_sql('num_txt')} AS whole, {census_double_sql('num_txt')} AS decimal FROM occ_dirty",
)
def br_numbers(t):
    number = F.col("num_txt")
    return t.adapter("occ_dirty").select(
        "id", casts.census_bigint(number).alias("whole"), casts.census_double(number).alias("decimal")
    )


@query(
    "flag_filter",
    DIRTY + "SELECT id, try_cast(flag_txt AS BOOLEAN) AS flag_txt FROM occ_dirty WHERE try_cast(flag_txt AS BOOLEAN)",
)
def flag_filter(t):
    return cleaning.cast_flags(t.adapter("occ_dirty").select("id", "flag_txt"), ["flag_txt"]).where("flag_txt")


@query("hour_feature", DIRTY + f"SELECT id, hora_txt, {hour_sql(clock_sql('hora_txt'))} AS hora FROM occ_dirty")
def hour_feature(t):
    """The hour is taken from the cleaned clock, as in the whole cleaning; the raw text is kept."""
    dirty = t.adapter("occ_dirty").select("id", "hora_txt", F.col("hora_txt").alias("relogio"))
    clocks = cleaning.cast_clocks(dirty, ["relogio"])
    return cleaning.add_hour(clocks, "relogio", "hora").drop("relogio")


@query(
    "cat_period_of_day",
    with_adapters("ev") + f"SELECT event_id, hora, {category_sql('periodo_dia', 'hora')} AS periodo_dia FROM ev",
)
def cat_period_of_day(t):
    table = [("periodo_dia", "hora", vehicle.PERIOD_OF_DAY, None)]
    return cleaning.add_categories(t.adapter("ev").select("event_id", "hora"), table)


def _category(name: str, *targets: str):
    """Register category columns over the sheet, with their source columns."""
    table = [row for row in vehicle.CATEGORIES if row[0] in targets]
    sources = [source for _, source, _, _ in table]
    columns = ", ".join([*sources, *[f"{category_sql(row[0])} AS {row[0]}" for row in table]])

    @query(name, SHEET + f"SELECT {columns} FROM sheet")
    def build(t):
        return cleaning.add_categories(t.adapter("sheet").select(*sources), table)


_category("cat_in_rules", "categoria_conduta", "categoria_tipolocal")
_category("cat_regex_rules", "categoria_rubrica")
_category("cat_equals_rules", "categoria_ocorrencia_veiculo")
_category("cat_mixed_rules", "categoria_tipo_veiculo")


@query(
    "cat_code_rules",
    with_adapters("basico_raw")
    + "SELECT cd_setor, cd_tipo, CASE CAST(cd_tipo AS INTEGER) WHEN 0 THEN 'NAO_ESPECIAL' "
    "WHEN 1 THEN 'FAVELA_COMUNIDADE_URBANA' WHEN 2 THEN 'QUARTEL_BASE_MILITAR' "
    "WHEN 3 THEN 'ALOJAMENTO_ACAMPAMENTO' WHEN 4 THEN 'SETOR_BAIXO_PATAMAR_DOMICILIAR' "
    "WHEN 5 THEN 'AGRUPAMENTO_INDIGENA' WHEN 6 THEN 'UNIDADE_PRISIONAL' "
    "WHEN 7 THEN 'CONVENTO_HOSPITAL_ILPI_IACA' WHEN 8 THEN 'AGROVILA_PA' "
    "WHEN 9 THEN 'AGRUPAMENTO_QUILOMBOLA' ELSE 'OUTROS' END AS categoria_tipo_setor FROM basico_raw",
)
def cat_code_rules(t):
    return t.adapter("basico_raw").select(
        "cd_setor", "cd_tipo", sector_type(F.col("cd_tipo")).alias("categoria_tipo_setor")
    )


@query(
    "flags",
    SHEET
    + f"""SELECT rubrica, descr_ocorrencia_veiculo,
      CAST(coalesce({category_sql('categoria_ocorrencia_veiculo')} = 'RECUPERADO', FALSE) AS INTEGER) AS is_recuperado,
      CAST({category_sql('categoria_rubrica')} = 'FURTO' AS INTEGER) AS is_furto,
      CAST({category_sql('categoria_rubrica')} = 'ROUBO' AS INTEGER) AS is_roubo,
      CAST({category_sql('categoria_rubrica')} IN ('ROUBO', 'VIOLENCIA') AS INTEGER) AS is_violento
    FROM sheet""",
)
def flags(t):
    sheet = t.adapter("sheet").select("rubrica", "descr_ocorrencia_veiculo")
    flagged = sheet.transform(cleaning.add_categories, vehicle.CATEGORIES).transform(
        cleaning.add_indicators, vehicle.FLAGS
    )
    return flagged.select("rubrica", "descr_ocorrencia_veiculo", *[name for name, _, _ in vehicle.FLAGS])


def _cleaned_text(name: str, upper: bool = False) -> str:
    cleaned = null_tokens_sql(f"trim({name})")
    return f"upper({cleaned})" if upper else cleaned


@query(
    "clean_occurrences",
    with_adapters(
        "sheet",
        then=f"""texts AS (SELECT {', '.join(
            f'{_cleaned_text(name, name in vehicle.UPPERCASED)} AS {name}'
            for name in ('data_ocorrencia_bo', 'datahora_registro_bo', 'id_delegacia', 'hora_ocorrencia',
                         'latitude', 'longitude', 'rubrica', 'descr_conduta', 'descr_ocorrencia_veiculo',
                         'descr_tipo_veiculo', 'descr_tipolocal', 'bairro'))} FROM sheet),
        typed AS (SELECT {date_sql('data_ocorrencia_bo')} AS data_ocorrencia_bo,
            {timestamp_sql('datahora_registro_bo')} AS datahora_registro_bo,
            {integer_sql('id_delegacia')} AS id_delegacia, {clock_sql('hora_ocorrencia')} AS hora_ocorrencia,
            {coordinate_sql('latitude')} AS latitude, {coordinate_sql('longitude')} AS longitude,
            rubrica, descr_conduta, descr_ocorrencia_veiculo, descr_tipo_veiculo, descr_tipolocal, bairro,
            {hour_sql('hora_ocorrencia')} AS hora_ocorrencia_num FROM texts),
        labelled AS (SELECT *, {', '.join(f'{category_sql(target)} AS {target}' for target in CATEGORY_SOURCES)} FROM typed)""",
    )
    + """SELECT DISTINCT *,
        CAST(categoria_ocorrencia_veiculo = 'RECUPERADO' AS INTEGER) AS is_recuperado,
        CAST(categoria_rubrica = 'FURTO' AS INTEGER) AS is_furto,
        CAST(categoria_rubrica = 'ROUBO' AS INTEGER) AS is_roubo,
        CAST(categoria_rubrica IN ('ROUBO', 'VIOLENCIA') AS INTEGER) AS is_violento
    FROM labelled""",
)
def clean_occurrences_query(t):
    sheet = t.adapter("sheet")
    messy = [f" {name.upper()}  " for name in sheet.columns]
    cleaned = clean_occurrences(sheet.toDF(*messy))
    return cleaned.withColumn("datahora_registro_bo", F.col("datahora_registro_bo").cast("timestamp_ntz"))


@query("dedup_full_row", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_full_row(t):
    return combine.drop_duplicate_rows(t.table("lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "dedup_report",
    "SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber "
    "FROM lineitem) d) AS rows_after FROM lineitem",
)
def dedup_report(t):
    return quality.duplicate_report(t.table("lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "union_by_name",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier",
)
def union_by_name(t):
    customers = t.table("customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = t.table("supplier").selectExpr("s_name AS name", "s_suppkey AS id", "s_acctbal AS balance")
    return combine.union_by_name([customers, suppliers])
