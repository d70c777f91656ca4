"""Batch runs from raw sheets to the curated table, over all years of the orders."""

from __future__ import annotations

from arealis.plans import batch, units as unit_plans
from arealis.sources import readers, scratch, writers
from catalog.registry import query, rounded, with_adapters
from catalog.units import COMPUTED, FINAL_COLUMNS, FINAL_CTES, RAW, raw_tables

# Dates must lie in this century to be read, so the years of the orders move on by twelve: leap years stay leap years.
LATER = 12
YEARS = [year + LATER for year in range(1995, 2002)]
BROKEN = 2014  # a year without a sheet


def write_sheets(t) -> str:
    """A raw sheet per year, every row twice with differences that cleaning removes; returns the pattern of their paths."""
    folder = scratch.shared_folder(t.spark)
    sheets = t.spark.sql(
        f"""SELECT concat(' ', o_orderkey) AS `NUM BO`, CASE o_orderkey % 7 WHEN 0 THEN 'nan' WHEN 1 THEN ''
              ELSE date_format(o_orderdate + make_interval({LATER}), 'yyyy-MM-dd') END AS DATA_OCORRENCIA_BO,
            CASE o_orderkey % 3 WHEN 0 THEN 'furto de veículo ' WHEN 1 THEN 'Roubo (art. 157)' ELSE 'outro' END AS RUBRICA,
            year(o_orderdate) + {LATER} AS ano_bo FROM {{orders}}""",
        orders=t.table("orders"),
    )
    writers.save_partitioned(sheets.union(sheets.selectExpr("`NUM BO`", "DATA_OCORRENCIA_BO", "upper(RUBRICA)", "ano_bo")), folder, "ano_bo", "csv")
    return folder + "/ano_bo={year}"


COUNTS = "total long, total_null long, total_empty long"


@query(
    "batch_outcomes",
    f"""SELECT CAST(CAST(year(o_orderdate) + {LATER} AS INTEGER) AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS error,
      count(*) AS total, count(*) FILTER (o_orderkey % 7 IN (0, 1)) AS total_null, CAST(0 AS BIGINT) AS total_empty
    FROM orders GROUP BY ALL UNION ALL SELECT '{BROKEN}', 'PATH_NOT_FOUND', NULL, NULL, NULL""",
)
def batch_outcomes(t):
    """Cleaning of all years side by side, one of them broken; the counts are observed on the writes."""
    clean = scratch.shared_folder(t.spark) + "/{year}"
    outcomes = batch.clean_and_count(t.spark, [*YEARS, BROKEN], write_sheets(t), clean)
    return batch.outcome_table(t.spark, outcomes, COUNTS)


@query(
    "batch_curated",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS num_bo, CASE o_orderkey % 3 WHEN 0 THEN 'FURTO' WHEN 1 THEN 'ROUBO' ELSE 'OUTROS' END
      AS categoria_rubrica, CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS is_furto,
      concat(CAST(CAST(year(o_orderdate) + {LATER} AS INTEGER) AS VARCHAR), '_', CAST(quarter(o_orderdate) AS VARCHAR)) AS ano_trimestre,
      CAST(year(o_orderdate) + {LATER} AS INTEGER) AS ano
    FROM orders WHERE o_orderkey % 7 NOT IN (0, 1)""",
)
def batch_curated(t):
    """Sheets cleaned, split by quarter, gathered into the partitioned table and read back; the broken year is left out."""
    clean, split, target = (scratch.shared_folder(t.spark) for _ in range(3))
    clean, split = clean + "/{year}", split + "/{year}"
    outcomes = batch.clean_and_count(t.spark, [*YEARS, BROKEN], write_sheets(t), clean)
    done = [outcome.item for outcome in outcomes if outcome.error is None]
    batch.split_years(t.spark, done, clean, split)
    batch.curate(t.spark, split + "/trimestre={quarter}", done, target)
    table = readers.read_periods(t.spark, target)
    return table.select("num_bo", "categoria_rubrica", "is_furto", "ano_trimestre", "ano")


CHANGED, GONE = (1996, 2), (1998, 3)


@query(
    "incremental_quarters",
    f"""WITH q AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS cliente,
      concat(CAST(y AS VARCHAR), '_', CAST(q AS VARCHAR)) AS ano_trimestre, y = {CHANGED[0]} AND q = {CHANGED[1]} AS rewritten
    FROM q WHERE NOT (y = {GONE[0]} AND q = {GONE[1]}) AND NOT (y = {CHANGED[0]} AND q = {CHANGED[1]} AND o_orderkey % 2 = 0)""",
)
def incremental_quarters(t):
    """All quarters curated; then one file changes, one goes, and a second run rewrites what that touches."""
    files, target = (scratch.shared_folder(t.spark) for _ in range(2))
    orders = t.table("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id", "CAST(o_custkey AS STRING) AS cliente",
        "concat_ws('_', year(o_orderdate), quarter(o_orderdate)) AS arquivo",
    )
    writers.save_partitioned(orders, files, "arquivo", "csv")
    pattern, years = files + "/arquivo={year}_{quarter}", range(1995, 2002)
    batch.curate_changed(t.spark, pattern, years, target)
    year, quarter = CHANGED
    part = orders.where(f"arquivo = '{year}_{quarter}' AND CAST(id AS BIGINT) % 2 = 1").drop("arquivo")
    writers.save(part, pattern.format(year=year, quarter=quarter), "csv")
    scratch.remove(t.spark, pattern.format(year=GONE[0], quarter=GONE[1]))
    changed, _ = batch.curate_changed(t.spark, pattern, years, target)
    table = readers.read_periods(t.spark, target)
    return table.select("id", "cliente", "ano_trimestre", table.ano_trimestre.isin(changed).alias("rewritten"))


@query(
    "census_from_files",
    with_adapters(*RAW, then=FINAL_CTES)
    + "SELECT "
    + ", ".join(f"round({c}, 6) AS {c}" if c in COMPUTED else c for c in FINAL_COLUMNS)
    + " FROM final",
)
def census_from_files(t):
    """The census tables as published, semicolons and Latin-1, read by level and built."""
    folder = scratch.shared_folder(t.spark)
    paths = {name: f"{folder}/{name}" for name in readers.CENSUS_TABLES}
    for name, table in raw_tables(t).items():
        table.write.option("header", True).option("sep", ";").option("encoding", readers.LATIN_1).csv(paths[name])
    raw = readers.read_census(t.spark, "setor", {"setor": paths})
    return rounded(unit_plans.build_units(raw, "setor", municipality=None)["final"], COMPUTED)
