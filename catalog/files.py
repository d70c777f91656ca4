"""Partitioned tables: written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import combine, schema
from arealis.sources import readers, scratch, writers
from catalog.registry import query, with_adapters

PERIODS = (
    "CAST(ano AS VARCHAR) AS ano_particao, trimestre AS trimestre_particao, "
    "concat(CAST(ano AS VARCHAR), '_', CAST(trimestre AS VARCHAR)) AS ano_trimestre"
)


def stamped(t):
    occ = t.adapter("occ").select("id", "data_ocorrencia")
    return occ.withColumns(readers.period_of(F.col("data_ocorrencia")))


@query("period_columns", with_adapters("occ") + f"SELECT id, data_ocorrencia, {PERIODS} FROM occ")
def period_columns(t):
    return stamped(t)


@query(
    "split_quarter",
    with_adapters("occ_dirty")
    + """, dated AS (SELECT id, CAST(CASE WHEN regexp_matches(data_txt, '^[0-9]{4}-[0-9]{2}-[0-9]{2} ')
          THEN try_strptime(substr(data_txt, 1, 10), '%Y-%m-%d')
          ELSE try_strptime(trim(data_txt), '%Y-%m-%d') END AS DATE) AS day FROM occ_dirty)
    SELECT id, CAST(quarter(day) AS INTEGER) AS trimestre FROM dated WHERE day IS NOT NULL""",
)
def split_quarter(t):
    folder = scratch.shared_folder(t.spark)
    writers.split_by_quarter(t.adapter("occ_dirty").select("id", "data_txt"), folder, "data_txt")
    back = readers.read_text_table(t.spark, folder)
    return back.select(F.col("id").cast("bigint").alias("id"), "trimestre")


@query(
    "partition_prune",
    with_adapters("occ") + f"SELECT id, data_ocorrencia, {PERIODS}, ano FROM occ WHERE ano BETWEEN 1997 AND 1999",
)
def partition_prune(t):
    folder = scratch.shared_folder(t.spark)
    table = stamped(t)
    writers.save_partitioned(table, folder, "ano_trimestre")
    return readers.read_periods(t.spark, folder, 1997, 1999, schema=table.schema)


@query(
    "periods_since",
    with_adapters("occ") + f"SELECT id, data_ocorrencia, {PERIODS}, ano FROM occ WHERE ano >= 1997",
)
def periods_since(t):
    folder = scratch.shared_folder(t.spark)
    table = stamped(t)
    writers.save_partitioned(table, folder, "ano_trimestre")
    return readers.read_periods(t.spark, folder, first_year=1997, schema=table.schema)


# Names with letters beyond ASCII, so a wrong encoding shows.
SUPPLIERS = "SELECT CAST(s_suppkey AS VARCHAR) AS id, concat('Ação ', s_name) AS nome, CAST(s_nationkey AS VARCHAR) AS pais FROM supplier"


def suppliers(t):
    return t.table("supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "concat('Ação ', s_name) AS nome", "CAST(s_nationkey AS STRING) AS pais"
    )


@query("csv_round_trip", SUPPLIERS)
def csv_round_trip(t):
    folder = scratch.shared_folder(t.spark)
    writers.save(suppliers(t), folder, "csv")
    return readers.read_text_table(t.spark, folder)


@query("csv_single_file", SUPPLIERS)
def csv_single_file(t):
    folder = scratch.shared_folder(t.spark)
    writers.save(suppliers(t), folder, "csv", single_file=True)
    return readers.read_text_table(t.spark, folder)


@query("json_round_trip", SUPPLIERS)
def json_round_trip(t):
    folder = scratch.shared_folder(t.spark)
    writers.save(suppliers(t), folder, "json")
    return t.spark.read.schema("id string, nome string, pais string").json(folder)


@query("gis_round_trip", SUPPLIERS)
def gis_round_trip(t):
    folder = scratch.shared_folder(t.spark)
    writers.export_gis(suppliers(t), folder)
    back = readers.read_text_table(t.spark, folder, sep=";", encoding="UTF-8")
    return back.toDF("id", "nome", "pais")


@query(
    "bundle_round_trip",
    SUPPLIERS + " UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR) FROM nation",
)
def bundle_round_trip(t):
    nations = t.table("nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS id", "n_name AS nome", "CAST(n_regionkey AS STRING) AS pais"
    )
    bundle = {"suppliers": suppliers(t), "nations": nations}
    targets = writers.save_bundle(bundle, scratch.shared_folder(t.spark), "setor")
    return combine.union_by_name([t.spark.read.parquet(targets[name]) for name in bundle])


@query(
    "quarter_files",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(year(o_orderdate) AS VARCHAR) AS ano,
      CAST(quarter(o_orderdate) AS VARCHAR) AS trimestre FROM orders
      WHERE year(o_orderdate) IN (1995, 1996) AND NOT (year(o_orderdate) = 1996 AND quarter(o_orderdate) = 2)""",
)
def quarter_files(t):
    """Quarter folders of two years, one of them missing, read back and stamped."""
    folder = scratch.shared_folder(t.spark)
    orders = t.table("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id", "year(o_orderdate) AS y", "quarter(o_orderdate) AS q"
    )
    for year in (1995, 1996):
        part = orders.where(f"y = {year} AND NOT (y = 1996 AND q = 2)").drop("y")
        writers.save_partitioned(part, f"{folder}/{year}", "q", "csv")
    found = readers.read_quarter_files(t.spark, folder + "/{year}/q={quarter}", [1995, 1996])
    return found.selectExpr("id", "CAST(ano_particao AS STRING) AS ano", "CAST(trimestre_particao AS STRING) AS trimestre")


@query("constant_stamp", "SELECT r_regionkey, r_name, 'censo' AS origem, '2022' AS ano FROM region")
def constant_stamp(t):
    return schema.with_constants(t.table("region").select("r_regionkey", "r_name"), origem="censo", ano="2022")


@query(
    "quarter_files_all",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN year(o_orderdate) % 2 = 1 THEN CAST(o_custkey AS VARCHAR) END AS cliente,
      CAST(year(o_orderdate) AS VARCHAR) AS ano, CAST(quarter(o_orderdate) AS VARCHAR) AS trimestre FROM orders
      WHERE NOT (year(o_orderdate) = 1998 AND quarter(o_orderdate) = 3)""",
)
def quarter_files_all(t):
    """Quarter folders of all years, one missing, with two different headers: two scans, however many files."""
    folder = scratch.shared_folder(t.spark)
    orders = t.table("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id", "CAST(o_custkey AS STRING) AS cliente",
        "concat_ws('_', year(o_orderdate), quarter(o_orderdate)) AS arquivo", "year(o_orderdate) % 2 = 1 AS odd",
    ).where("arquivo != '1998_3'")
    writers.save_partitioned(orders.where("odd").select("cliente", "id", "arquivo"), f"{folder}/a", "arquivo", "csv")
    writers.save_partitioned(orders.where("not odd").select("id", "arquivo"), f"{folder}/b", "arquivo", "csv")
    found = readers.read_quarter_files(t.spark, folder + "/*/arquivo={year}_{quarter}", range(1995, 2002))
    return found.selectExpr("id", "cliente", "ano_particao AS ano", "CAST(trimestre_particao AS STRING) AS trimestre")


@query("constant_stamp_customers", "SELECT c_custkey, c_name, 'censo' AS origem, '2022' AS ano FROM customer")
def constant_stamp_customers(t):
    return schema.with_constants(t.table("customer").select("c_custkey", "c_name"), origem="censo", ano="2022")


@query(
    "periods_stored_schema",
    with_adapters("occ")
    + f"SELECT id, data_ocorrencia, {PERIODS}, CASE WHEN ano > 1997 THEN 'nova' END AS origem, ano FROM occ",
)
def periods_stored_schema(t):
    """Later periods have one column more; the schema kept beside the table covers both, and no footer is opened for it."""
    folder = scratch.shared_folder(t.spark)
    table = stamped(t)
    writers.save_partitioned(table.where("year(data_ocorrencia) <= 1997"), folder, "ano_trimestre")
    later = table.where("year(data_ocorrencia) > 1997").withColumn("origem", F.lit("nova"))
    writers.save_partitioned(later, folder, "ano_trimestre", only_touched=True)
    return readers.read_periods(t.spark, folder)


@query(
    "dedup_on_write",
    """SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)) AS rows_after,
      (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)) AS rows_read FROM lineitem""",
)
def dedup_on_write(t):
    """Rows before and after deduplication, from the write itself, beside what can be read back."""
    folder = scratch.shared_folder(t.spark)
    before, after = writers.save_distinct(t.table("lineitem").select("l_orderkey", "l_returnflag"), folder)
    back = t.spark.read.schema("l_orderkey long, l_returnflag string").parquet(folder)
    known = F.lit(before).cast("long").alias("rows_before"), F.lit(after).cast("long").alias("rows_after")
    return back.agg(F.count("*").alias("rows_read")).select(*known, "rows_read")
