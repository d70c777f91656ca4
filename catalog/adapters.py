"""The test tables in the shape of occurrence, unit and census tables.

One SQL text serves Spark and DuckDB; ``{table}`` marks a source table. Every adapter covers its
whole source. Money is summed as whole cents, and doubles are never printed as text, because the
engines differ in both.
"""

from __future__ import annotations

from collections.abc import Sequence


def pick(selector: str, values: Sequence[str | None]) -> str:
    """A text chosen by the remainder of a number."""
    cases = " ".join(
        f"WHEN {i} THEN " + ("NULL" if value is None else f"'{value}'")
        for i, value in enumerate(values)
    )
    return f"CASE ({selector}) % {len(values)} {cases} END"


def _money(cents: str) -> str:
    """Whole cents as text with a decimal comma."""
    whole = f"CAST(CAST(floor(({cents}) / 100) AS BIGINT) AS STRING)"
    text = f"concat({whole}, ',', lpad(CAST(({cents}) % 100 AS STRING), 2, '0'))"
    return f"CASE WHEN ({cents}) IS NOT NULL THEN {text} END"  # concat of NULL differs between the engines


def _people(per: int) -> str:
    return f"CAST(floor(greatest(c_acctbal, CAST(0 AS DOUBLE)) / {per}) AS BIGINT)"


OCC = """
SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS cd_setor,
       CAST(o_orderdate AS DATE) AS data_ocorrencia,
       CAST(year(o_orderdate) AS INT) AS ano, CAST(quarter(o_orderdate) AS INT) AS trimestre,
       o_orderpriority AS prioridade,
       o_orderpriority = '1-URGENT' AS is_roubo, o_orderpriority = '2-HIGH' AS is_furto
FROM {orders}
"""

UNITS = f"""
SELECT CAST(c_custkey AS STRING) AS cd_setor, n_name AS nm_dist, r_name AS nm_mun,
       CAST(c_custkey % 12 AS INT) AS cd_tipo,
       {_people(10)} AS qt_pessoas, {_people(30)} AS qt_domicilios,
       {_people(40)} AS qt_domicilios_particularesocupados,
       {_people(200)} AS qt_domicilios_particulares_vagos,
       CAST(c_custkey % 50 AS DOUBLE) / 10 AS area_km2
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
     JOIN {{region}} ON n_regionkey = r_regionkey
"""

# What each of the 35 frontage counters counts among a customer's order lines.
COUNTED = (
    "l_quantity > 0",
    "l_quantity > 45",
    "l_quantity > 30",
    "l_quantity > 15",
    "l_quantity > 48",
    "l_quantity < 2",
    "l_returnflag = 'A'",
    "l_returnflag = 'R'",
    "l_returnflag = 'N'",
    "l_linestatus = 'F'",
    "l_linestatus = 'O'",
    "l_quantity > 49",
    "l_quantity > 10",
    "l_quantity <= 10",
    "l_discount > 0.095",
    "l_discount > 0.035",
    "l_discount <= 0.035",
    "l_discount > 0.085",
    "l_tax > 0.065",
    "l_tax <= 0.065",
    "l_tax > 0.075",
    "l_extendedprice > 30000",
    "l_extendedprice <= 30000",
    "l_extendedprice > 90000",
    "l_suppkey % 3 = 0",
    "l_suppkey % 3 <> 0",
    "l_suppkey % 5 = 0",
    "l_partkey % 4 = 0",
    "l_partkey % 4 <> 0",
    "l_partkey % 9 = 0",
    "l_linenumber <= 2",
    "l_linenumber IN (3, 4)",
    "l_linenumber IN (5, 6)",
    "l_linenumber = 7",
    "l_linenumber = 1",
)

# Lines are counted per order before the join, so an order with very many lines is one row there.
ENTORNO_RAW = (
    "SELECT CAST(o_custkey AS STRING) AS cd_setor, "
    + ", ".join(
        f"CAST(CAST(sum(k{i}) AS BIGINT) AS STRING) AS v{5000 + i:05d}" for i in range(len(COUNTED))
    )
    + " FROM {orders} JOIN (SELECT l_orderkey, "
    + ", ".join(f"count(CASE WHEN {test} THEN 1 END) AS k{i}" for i, test in enumerate(COUNTED))
    + " FROM {lineitem} GROUP BY l_orderkey) lines ON o_orderkey = l_orderkey GROUP BY o_custkey"
)

ENTORNO_DISTRITO_RAW = (
    ENTORNO_RAW.replace("CAST(o_custkey AS STRING) AS cd_setor", "CAST(c_nationkey AS STRING) AS cd_dist")
    .replace("GROUP BY o_custkey", "JOIN {customer} ON o_custkey = c_custkey GROUP BY c_nationkey")
)

BASICO_RAW = f"""
SELECT CAST(c_custkey AS STRING) AS cd_setor,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Rural' ELSE 'Urbana' END AS situacao,
       CAST(c_nationkey % 9 AS STRING) AS cd_sit, CAST(c_custkey % 12 AS STRING) AS cd_tipo,
       CASE WHEN c_acctbal < -950 THEN ' . '
            ELSE concat(CAST(c_custkey % 50 AS STRING), ',', CAST(c_custkey % 10 AS STRING))
       END AS area_km2,
       r_name AS nm_uf, CAST(r_regionkey AS STRING) AS cd_mun, r_name AS nm_mun,
       CAST(n_nationkey AS STRING) AS cd_dist, n_name AS nm_dist, c_mktsegment AS cd_subdist,
       CASE WHEN c_acctbal < -900 THEN 'X' ELSE CAST({_people(10)} AS STRING) END AS v0001,
       CAST({_people(30)} AS STRING) AS v0002,
       concat(CAST(1 + c_custkey % 4 AS STRING), ',', CAST(c_custkey % 10 AS STRING)) AS v0005,
       concat(' ', CAST({_people(40)} AS STRING)) AS v0007,
       CAST({_people(300)} AS STRING) AS v0008,
       concat(CAST({_people(200)} AS STRING), '.7') AS v0009
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
     JOIN {{region}} ON n_regionkey = r_regionkey
"""

BASICO_DISTRITO_RAW = f"""
SELECT CAST(n_nationkey AS STRING) AS CD_DIST, n_name AS NM_DIST,
       CAST(r_regionkey AS STRING) AS CD_REGIAO, r_name AS NM_REGIAO, '35' AS CD_UF,
       'UF' AS NM_UF, CAST(r_regionkey AS STRING) AS CD_MUN, r_name AS NM_MUN,
       concat(CAST(sum(c_custkey % 50) AS STRING), ',5') AS AREA_KM2,
       CAST(CAST(sum({_people(10)}) AS BIGINT) AS STRING) AS v0001,
       CAST(CAST(sum({_people(30)}) AS BIGINT) AS STRING) AS v0002,
       CAST(CAST(sum({_people(35)}) AS BIGINT) AS STRING) AS v0003,
       'X' AS v0004, '2,7' AS v0005, concat(CAST(count(*) % 10 AS STRING), ',25') AS v0006,
       CAST(CAST(sum({_people(40)}) AS BIGINT) AS STRING) AS v0007,
       CAST(CAST(sum({_people(300)}) AS BIGINT) AS STRING) AS v0008,
       CAST(CAST(sum({_people(200)}) AS BIGINT) AS STRING) AS v0009
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
     JOIN {{region}} ON n_regionkey = r_regionkey
GROUP BY n_nationkey, n_name, r_regionkey, r_name
"""

# Only shipped orders declare income, so some customers have none. Mid-range stands for the median.
RENDIMENTO_RAW = f"""
SELECT CAST(o_custkey AS STRING) AS cd_setor, CAST(n AS STRING) AS v06001,
       CAST(n * 3 AS STRING) AS v06002, CASE WHEN n > 0 THEN concat('0,', CAST(n AS STRING)) END AS v06003,
       {_money('CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT)')} AS v06004,
       {_money('high - low')} AS v06005,
       {_money('CAST(floor(CAST(low + high AS DOUBLE) / 2) AS BIGINT)')} AS v06006
FROM (SELECT o_custkey, nullif(count(price), 0) AS n,
             CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT) AS total,
             min(CAST(round(price * 100) AS BIGINT)) AS low,
             max(CAST(round(price * 100) AS BIGINT)) AS high
      FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price FROM {{orders}}) o
      GROUP BY o_custkey) t
"""

RENDIMENTO_DISTRITO_RAW = (
    RENDIMENTO_RAW.replace("CAST(o_custkey AS STRING) AS cd_setor", "CAST(c_nationkey AS STRING) AS cd_dist")
    .replace("SELECT o_custkey, CASE", "SELECT c_nationkey, CASE")
    .replace("FROM {orders}) o", "FROM {orders} JOIN {customer} ON o_custkey = c_custkey) o")
    .replace("SELECT o_custkey, nullif", "SELECT c_nationkey, nullif")
    .replace("GROUP BY o_custkey", "GROUP BY c_nationkey")
)

OCC_DIRTY = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 7
    WHEN 0 THEN concat(d, ' 00:00:00')
    WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    WHEN 2 THEN concat('  ', d, ' ') WHEN 3 THEN 'nan' WHEN 4 THEN concat(substr(d, 1, 4), '-13-45')
    WHEN 5 THEN '' ELSE NULL END AS data_txt,
  CASE o_orderkey % 6
    WHEN 0 THEN concat(d, ' 12:34:56')
    WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4), ' 01:02:03')
    WHEN 2 THEN d
    WHEN 3 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    WHEN 4 THEN 'abc' ELSE NULL END AS ts_txt,
  CASE o_orderkey % 5
    WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN concat(' ', CAST(o_custkey AS STRING), ' ')
    WHEN 2 THEN '-5' WHEN 3 THEN '99999999999' ELSE 'NULL' END AS int_txt,
  CASE o_orderkey % 4
    WHEN 0 THEN concat(lpad(CAST(o_custkey % 24 AS STRING), 2, '0'), ':15:00')
    WHEN 1 THEN concat(lpad(CAST(o_custkey % 24 AS STRING), 2, '0'), ':15:00.000')
    WHEN 2 THEN '99:00:00' ELSE '1:2:3' END AS hora_txt,
  CASE o_orderkey % 5
    WHEN 0 THEN concat('-23,', CAST(o_custkey AS STRING)) WHEN 1 THEN '-46.6333'
    WHEN 2 THEN '1.234,5' WHEN 3 THEN 'None' ELSE '0' END AS coord_txt,
  CASE o_orderkey % 8
    WHEN 0 THEN 'X' WHEN 1 THEN '.' WHEN 2 THEN ' - ' WHEN 3 THEN '' WHEN 4 THEN '12.7'
    WHEN 5 THEN '1.234,56' WHEN 6 THEN concat(' ', CAST(o_custkey AS STRING), ',25')
    ELSE CAST(o_custkey AS STRING) END AS num_txt,
  CASE o_orderkey % 3 WHEN 0 THEN ' furto de veículo ' WHEN 1 THEN 'Roubo (art. 157)'
    ELSE 'localização/apreensão' END AS rubrica,
  CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'true' WHEN 2 THEN '0' ELSE 'x' END AS flag_txt
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) t
"""

# A raw sheet. Order and line numbers repeat in the source, so whole rows do too.
_DAY = "CAST(DATE '1999-06-01' + CAST(l_orderkey % 1500 AS INT) AS STRING)"
SHEET = f"""
SELECT
  CASE l_orderkey % 4 WHEN 0 THEN concat(d, ' 00:00:00')
    WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    WHEN 2 THEN concat(' ', d) ELSE 'nan' END AS data_ocorrencia_bo,
  CASE l_orderkey % 3 WHEN 0 THEN concat(d, ' 12:34:56')
    WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    ELSE 'null' END AS datahora_registro_bo,
  concat(CAST(l_orderkey AS STRING), ' ') AS id_delegacia,
  CASE l_linenumber % 3 WHEN 0 THEN concat(lpad(CAST(l_orderkey % 24 AS STRING), 2, '0'), ':15:00')
    WHEN 1 THEN '99:00:00' ELSE '7h' END AS hora_ocorrencia,
  concat('-23,', CAST(l_orderkey % 1000 AS STRING)) AS latitude,
  CASE l_linenumber % 2 WHEN 0 THEN '-46.5' ELSE '1.234,5' END AS longitude,
  {pick('l_orderkey', ['Furto (art. 155)', ' roubo (art. 157)', 'LOCALIZAÇÃO/APREENSÃO de veículo',
      'receptação', 'Adulteração de sinal', 'ESTELIONATO', 'colisão', 'Lesão corporal', 'Drogas',
      'Porte de ARMA', 'TENTATIVA DE ROUBO', 'Outros', None])} AS rubrica,
  {pick('l_orderkey', ['Veículo', 'INTERIOR DE VEÍCULO', 'transeunte', 'RESIDÊNCIA', 'Carga',
      'ESTABELECIMENTO COMERCIAL', 'COLETIVO', 'FIOS E CABOS', 'Praia', 'None', None])}
    AS descr_conduta,
  {pick('l_orderkey', ['Localizado / Entregue', 'Furtado', 'Roubado', 'roubado', None])}
    AS descr_ocorrencia_veiculo,
  {pick('l_orderkey', ['AUTOMOVEL', 'Utilitário', 'MOTONETA', 'CAMINHÃO TRATOR', 'TRATOR DE RODAS',
      'ONIBUS', 'Bicicleta', 'Barco', None])} AS descr_tipo_veiculo,
  {pick('l_orderkey', ['Via Pública', 'Residência', 'Shopping Center', 'Estacionamento/Garagem',
      'Rodovia/Estrada', 'Saúde', 'Unidade Rural', 'via pública', None])} AS descr_tipolocal,
  CAST(l_linenumber AS STRING) AS bairro,
  'dropped' AS desc_lei
FROM (SELECT l_orderkey, l_linenumber, {_DAY} AS d FROM {{lineitem}}) t
"""

EV = "SELECT event_id, user_id, event_type, value, CAST(hour(ts) AS INT) AS hora FROM {events}"

# Given to the reader, so that building a query opens no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

SQL = {
    "occ": OCC,
    "units": UNITS,
    "basico_raw": BASICO_RAW,
    "basico_distrito_raw": BASICO_DISTRITO_RAW,
    "entorno_raw": ENTORNO_RAW,
    "rendimento_raw": RENDIMENTO_RAW,
    "entorno_distrito_raw": ENTORNO_DISTRITO_RAW,
    "rendimento_distrito_raw": RENDIMENTO_DISTRITO_RAW,
    "occ_dirty": OCC_DIRTY,
    "sheet": SHEET,
    "ev": EV,
}
