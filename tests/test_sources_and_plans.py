from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from arealis.levels import DISTRICT, SECTOR
from arealis.plans import batch, study, units, views
from arealis.presets import analysis, census
from arealis.sources import readers, scratch, writers


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("1", "São Paulo"), ("2", "Itaú")], "id string, nome string")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_formats_round_trip(spark, folder, people, fmt):
    writers.save(people, f"{folder}/x", fmt)
    back = readers.read_text_table(spark, f"{folder}/x") if fmt == "csv" else spark.read.format(fmt).load(f"{folder}/x")
    assert rows(back.select("id", "nome"), "id") == rows(people, "id")


def test_csv_is_latin_1_in_one_file(folder, people, tmp_path):
    writers.save(people.repartition(3), f"{folder}/x", "csv", single_file=True)
    (part,) = (tmp_path / "x").glob("part-*")
    assert "São" in part.read_bytes().decode("latin-1")


def test_unknown_format_is_raised(folder, people):
    with pytest.raises(ValueError, match="unsupported"):
        writers.save(people, f"{folder}/x", "xls")


def test_semicolon_text_and_given_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Código;Área\n001;1,5\n".encode("latin-1"))
    assert rows(readers.read_text_table(spark, str(tmp_path / "a.csv"), sep=";"), "Código") == [("001", "1,5")]
    named = readers.read_text_table(spark, str(tmp_path / "a.csv"), sep=";", columns=["c", "a"])
    assert named.dtypes == [("c", "string"), ("a", "string")]


def write_quarter(tmp_path, year, quarter, text):
    (tmp_path / f"v_{year}_{quarter}.csv").write_bytes(text.encode("latin-1"))


def test_quarter_files_align_by_name_and_skip_missing(spark, tmp_path):
    write_quarter(tmp_path, 2020, 1, "a,b\n1,2\n")
    write_quarter(tmp_path, 2021, 4, "b,a,c\n3,4,ç\n")
    found = readers.read_quarter_files(spark, f"{tmp_path}/v_{{year}}_{{quarter}}.csv", ["2020", "2021"])
    assert rows(found.select("a", "b", "c", "ano_particao", "trimestre_particao", "ano_trimestre"), "a") == [
        ("1", "2", None, "2020", 1, "2020_1"),
        ("4", "3", "ç", "2021", 4, "2021_4"),
    ]
    with pytest.raises(FileNotFoundError, match="no file"):
        readers.read_quarter_files(spark, f"{tmp_path}/w_{{year}}_{{quarter}}.csv", [2020])


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        readers.read_if_exists(spark, str(tmp_path / "empty"), columns=["a", "a"])


@pytest.fixture
def periods(spark):
    data = [(1, "2019_4"), (2, "2020_1"), (3, "2021_2"), (4, "2026_1")]
    return spark.createDataFrame(data, "id int, ano_trimestre string")


def test_partitioned_table_reads_only_its_years(spark, folder, periods):
    writers.save_partitioned(periods, f"{folder}/t", "ano_trimestre")
    table = readers.read_periods(spark, f"{folder}/t", *analysis.STUDY_YEARS)
    assert rows(table.select("id", "ano"), "id") == [(2, 2020), (3, 2021)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "regexp_extract" in plan.split("PartitionFilters")[1]
    given = readers.read_periods(spark, f"{folder}/t", schema="id int, ano_trimestre string")
    assert given.count() == 4


def test_only_touched_partitions_are_replaced(spark, folder, periods):
    writers.save_partitioned(periods, f"{folder}/t", "ano_trimestre")
    again = spark.createDataFrame([(20, "2020_1")], "id int, ano_trimestre string")
    writers.save_partitioned(again, f"{folder}/t", "ano_trimestre", only_touched=True)
    assert [r.id for r in spark.read.parquet(f"{folder}/t").orderBy("id").collect()] == [1, 3, 4, 20]


def test_hot_partition_is_written_by_several_tasks(spark, folder):
    """Half of the rows share a partition; rebalancing must not give them to one task."""
    skewed = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("filler"), F.when(F.col("id") % 2 == 0, "2020_1").otherwise(F.concat(F.lit("2021_"), F.col("id") % 4)).alias("ano_trimestre"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        writers.save_partitioned(skewed, f"{folder}/t", "ano_trimestre")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot_files = spark.read.parquet(f"{folder}/t/ano_trimestre=2020_1").inputFiles()
    assert len(hot_files) > 1
    assert spark.read.parquet(f"{folder}/t").count() == 200_000


def test_split_by_quarter_drops_rows_without_a_date(either_mode, folder):
    df = either_mode.createDataFrame([(1, "2024-02-01"), (2, "2024-12-31"), (3, None), (4, "x")], "id int, d string")
    writers.split_by_quarter(df, f"{folder}/q", "d")
    back = readers.read_text_table(either_mode, f"{folder}/q")
    assert rows(back.select("id", "trimestre"), "id") == [("1", 1), ("2", 4)]


def test_period_of_a_date(spark):
    df = spark.createDataFrame([(date(2024, 5, 1),), (None,)], "d date")
    got = df.select(*[c.alias(n) for n, c in readers.period_of(F.col("d")).items()]).collect()
    assert tuple(got[0]) == ("2024", 2, "2024_2")


def test_gis_export_opens_with_a_mark(people, tmp_path):
    writers.export_gis(people, str(tmp_path / "gis"), single_file=True)
    (part,) = (tmp_path / "gis").glob("part-*")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid;nome\n")


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch.shared_folder(spark)
    assert root is None or folder.startswith(root.rstrip("/") + "/arealis-")
    assert scratch.shared_folder(spark) != folder
    stored = scratch.materialize(spark.range(5))
    assert stored.count() == 5
    assert root is None or all(root in path for path in stored.inputFiles())


def census_rows(level):
    key = "001"
    basic = {code: "10" for code, _, kind in units.BASIC[level] if kind in ("bigint", "double")}
    basic |= {code: "t" for code, _, kind in units.BASIC[level] if kind == "text"}
    basic |= {"nm_mun": census.MUNICIPALITY, "area_km2": "2,5", "v0001": "1000", "v0009": "X", "cd_tipo": "1"}
    basic[units.level_named(level).key] = key
    if level == "distrito":
        del basic["cd_tipo"]
    around = {code: "4" for code, _ in census.SURROUNDINGS} | {"v05007": "12", units.level_named(level).key: key}
    income = {code: "100,5" for code, *_ in census.INCOME} | {units.level_named(level).key: key}
    return basic, around, income


@pytest.mark.parametrize("level", [SECTOR, DISTRICT])
def test_census_build_from_files(either_mode, level, tmp_path):
    spark = either_mode
    paths = {}
    for table, row in zip(readers.CENSUS_TABLES, census_rows(level.name), strict=True):
        header = [name.upper() if level is DISTRICT else name for name in row]
        lines = [header, list(row.values())]
        if table == "basico":
            lines.append(["Outra" if name == "nm_mun" else "002" for name in row])
        path = tmp_path / f"{table}.csv"
        path.write_bytes("\n".join(";".join(line) for line in lines).encode("latin-1"))
        paths[table] = str(path)
    results = batch.build_levels(spark, [level.name], {level.name: paths}, f"{tmp_path}/censo")
    assert set(results[level.name]) == {"basico", "entorno", "rendimento", "final"}
    final = spark.read.parquet(f"{tmp_path}/censo/final/processed/{level.name}")
    assert len(final.columns) == len(level.geo_columns) + 36
    row = final.collect()
    assert len(row) == 1
    (row,) = row
    assert row.qt_pessoas == 1000
    assert row.densidade_populacional == 400.0
    assert row.tx_via_pavimentada == 0.25
    assert row.tx_bueiro == 0.5
    assert row.tx_arborizacao == 0.75
    assert row.indice_arborizacao_ponderado == 1.5
    assert row.tx_domicilios_vagos is None
    assert row.indice_vulnerabilidade_urbana is None
    assert row.indice_infraestrutura_urbana == pytest.approx((0.25 + 0.5 * 4 + 0.75) / 6)
    assert row.vl_renda_media_por_morador == pytest.approx(10.05)
    if level is SECTOR:
        assert row.categoria_tipo_setor == "FAVELA_COMUNIDADE_URBANA"


def test_unknown_level_is_raised(spark, people):
    with pytest.raises(ValueError, match="unknown level"):
        units.income_table(people, "bairro")
    with pytest.raises(ValueError, match="unknown level"):
        readers.read_census(spark, "bairro", {})


def test_published_shapes():
    assert len(census.SURROUNDINGS) == 35
    assert len(census.BASIC_SECTOR) == len(census.BASIC_DISTRICT) == 18
    assert len(census.FINAL_MEASURES) == 36
    assert len(analysis.SPATIAL_COLUMNS) == 18
    groups = (analysis.INFRASTRUCTURE, analysis.MOBILITY, analysis.INCOME, analysis.DEMOGRAPHIC, analysis.MAIN_VARIABLES, analysis.URBAN_RATIOS, analysis.URBAN_VARIABLES)
    assert [len(group) for group in groups] == [8, 4, 6, 5, 8, 9, 10]
    known = set(census.FINAL_MEASURES)
    assert all(set(group) <= known for group in groups)


def test_batch_from_raw_sheets_to_curated_table(spark, tmp_path):
    header = " DATA_OCORRENCIA_BO,RUBRICA,HORA_OCORRENCIA\n"
    for year in (2020, 2021):
        body = f"{year}-02-03,Furto,10:00:00\n{year}-02-03,Furto ,10:00:00\n{year}-11-01,Roubo,99:00:00\n,Outro,\n"
        (tmp_path / f"raw_{year}.csv").write_bytes((header + body).encode("latin-1"))
    raw, clean, split = (f"{tmp_path}/{name}" for name in ("raw_{year}.csv", "clean_{year}", "split_{year}"))
    batch.clean_years(spark, [2020, 2021], raw, clean)
    tables = {year: spark.read.parquet(clean.format(year=year)) for year in (2020, 2021)}
    assert rows(batch.missing_dates(tables), "ano") == [("2020", 3, 1, 0), ("2021", 3, 1, 0)]
    batch.split_years(spark, [2020, 2021], clean, split)
    pattern = f"{tmp_path}/split_{{year}}/trimestre={{quarter}}"
    curated = batch.curate(spark, pattern, [2020, 2021], f"{tmp_path}/curated")
    table = readers.read_periods(spark, curated, 2021, 2021)
    got = rows(table.select("ano_trimestre", "categoria_rubrica", "is_furto"), "ano_trimestre")
    assert got == [("2021_1", "FURTO", "1"), ("2021_4", "ROUBO", "0")]


def test_batch_reports_every_failure_after_the_rest_ran(spark, tmp_path):
    (tmp_path / "raw_2021.csv").write_text("rubrica\nFurto\n")
    with pytest.raises(ExceptionGroup) as failed:
        batch.clean_years(spark, [2020, 2021, 2022], f"{tmp_path}/raw_{{year}}.csv", f"{tmp_path}/clean_{{year}}")
    assert len(failed.value.exceptions) == 2
    assert spark.read.parquet(f"{tmp_path}/clean_2021").count() == 1


def test_views(spark):
    crimes = spark.createDataFrame(
        [("s1", True, False, 2020), ("s1", False, True, 2021), ("s2", False, True, 2021), (None, True, True, 2021), ("s2", False, False, 2021)],
        "SJ_CD_SETOR string, is_roubo boolean, is_furto boolean, ano int",
    )
    censo = spark.createDataFrame([("s1", "A", 0), ("s2", "B", 500)], "cd_setor string, nm_dist string, qt_pessoas int")
    assert [tuple(r) for r in views.top_districts(crimes, censo).collect()] == [("A", 2), ("B", 1)]
    rated = views.rates_of_thefts(crimes, censo).select("cd_setor", "tx_crimes_1000_hab")
    assert rows(rated, "cd_setor") == [("s1", None), ("s2", 2.0)]
    assert [tuple(r) for r in views.events_per_year(crimes).collect()] == [(2021, 4), (2020, 1)]
    views.register_views(crimes=crimes)
    assert spark.sql("SELECT count(*) FROM crimes").first()[0] == 5


def test_top_districts_counts_before_it_joins(spark):
    crimes = spark.createDataFrame([], "SJ_CD_SETOR string, is_roubo boolean, is_furto boolean")
    censo = spark.createDataFrame([], "cd_setor string, nm_dist string")
    plan = views.top_districts(crimes, censo)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert "count(1)" in plan[join:] and "count(1)" not in plan[:join]


@pytest.mark.parametrize("first,last,years", [(2020, None, [2020, 2024]), (None, 2020, [2019, 2020]), (None, None, [2019, 2020, 2024])])
def test_periods_with_open_bounds(spark, tmp_path, first, last, years):
    table = spark.createDataFrame([(y, f"{y}_1") for y in (2019, 2020, 2024)], "id int, ano_trimestre string")
    writers.save_partitioned(table, str(tmp_path / "t"), "ano_trimestre")
    got = readers.read_periods(spark, str(tmp_path / "t"), first, last)
    assert sorted(r.ano for r in got.collect()) == years


def test_no_machine_local_folder_is_used():
    from pathlib import Path

    sources = Path(writers.__file__).resolve().parents[1].rglob("*.py")
    assert not [p for p in sources if "tempfile" in p.read_text(encoding="utf-8")]


def test_quarter_files_with_equal_headers_are_one_scan(spark, tmp_path):
    place = tmp_path / "a b+c"
    place.mkdir()
    for i, year in enumerate(range(2015, 2022)):
        for quarter in (1, 2, 3, 4):
            write_quarter(place, year, quarter, f"a,b\n{i},{quarter}\n" if quarter < 4 else f'b,"a, é",b\n{i},{quarter},x\n')
    write_quarter(place, 2020, 2, "")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    found = readers.read_quarter_files(spark, f"{tmp_path}/?*/v_{{year}}_{{quarter}}.csv", range(2010, 2022))
    spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs.getJobIdsForGroup("headers")) <= 2  # one query, whose shuffle may be a job of its own
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2
    got = rows(found, "ano_particao", "trimestre_particao")
    assert len(got) == 27 and found.columns == ["a", "b", "ano_particao", "trimestre_particao", "ano_trimestre", "b0", "a, é", "b2"]
    assert [tuple(r) for r in found.where("trimestre_particao = 4").select("b0", "`a, é`", "b2", "ano_trimestre").orderBy("ano_trimestre").collect()][0] == ("0", "4", "x", "2015_4")


def test_headers_of_folders_and_empty_files(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    for i in range(3):
        (tmp_path / "folder" / f"part-{i}.csv").write_bytes(b"x;;x\r\n1;2;3\r\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    paths = [str(tmp_path / "folder"), str(tmp_path / "empty.csv")]
    assert readers.headers(spark, paths, sep=";") == {paths[0]: ("x0", "_c1", "x2")}
    assert readers.headers(spark, []) == {}


def test_stored_schema_covers_all_folders(spark, folder, periods):
    writers.save_partitioned(periods, f"{folder}/t", "ano_trimestre")
    more = spark.createDataFrame([(5, "x", "2026_2")], "id int, novo string, ano_trimestre string")
    writers.save_partitioned(more, f"{folder}/t", "ano_trimestre", only_touched=True)
    assert readers.stored_schema(spark, f"{folder}/t").names == ["id", "ano_trimestre", "novo"]
    got = rows(readers.read_periods(spark, f"{folder}/t").select("id", "novo", "ano"), "id")
    assert got[0] == (1, None, 2019) and got[-1] == (5, "x", 2026)
    other = spark.createDataFrame([("5", "2026_2")], "id string, ano_trimestre string")
    with pytest.raises(ValueError, match="another type"):
        writers.save_partitioned(other, f"{folder}/t", "ano_trimestre", only_touched=True)
    writers.save_partitioned(periods, f"{folder}/t", "ano_trimestre")
    assert readers.stored_schema(spark, f"{folder}/t").names == ["id", "ano_trimestre"]


def test_tables_of_others_have_their_footers_merged(spark, folder, periods):
    periods.write.partitionBy("ano_trimestre").parquet(f"{folder}/t")
    more = spark.createDataFrame([(5, "x", "2026_2")], "id int, novo string, ano_trimestre string")
    writers.save_partitioned(more, f"{folder}/t", "ano_trimestre", only_touched=True)
    assert readers.stored_schema(spark, f"{folder}/t") is None
    assert rows(readers.read_periods(spark, f"{folder}/t").select("id", "novo"), "id")[-1] == (5, "x")


def test_distinct_rows_are_counted_on_the_write(spark, folder):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "b")], "a int, `b.c` string")
    assert writers.save_distinct(df, f"{folder}/d") == (5, 3)
    assert spark.read.parquet(f"{folder}/d").count() == 3
    assert writers.save_distinct(df.limit(0), f"{folder}/e", "csv") == (0, 0)


def test_only_changed_quarters_are_rewritten(spark, tmp_path):
    pattern, target = f"{tmp_path}/v_{{year}}_{{quarter}}.csv", f"{tmp_path}/curated"
    for quarter in (1, 2, 3):
        write_quarter(tmp_path, 2020, quarter, f"a\n{quarter}\n")
    assert batch.curate_changed(spark, pattern, [2020, 2021], target) == (["2020_1", "2020_2", "2020_3"], [])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "curated").glob("ano*/*.parquet")}
    assert batch.curate_changed(spark, pattern, [2020, 2021], target) == ([], [])
    write_quarter(tmp_path, 2020, 2, "a,b\n20,x\n21,y\n")
    write_quarter(tmp_path, 2021, 4, "a\n4\n")
    (tmp_path / "v_2020_3.csv").unlink()
    assert batch.curate_changed(spark, pattern, [2020, 2021], target) == (["2020_2", "2021_4"], ["2020_3"])
    got = rows(readers.read_periods(spark, target).select("a", "b", "ano_trimestre"), "ano_trimestre", "a")
    assert got == [("1", None, "2020_1"), ("20", "x", "2020_2"), ("21", "y", "2020_2"), ("4", None, "2021_4")]
    (kept,) = (p for p in before if "2020_1" in str(p))
    assert kept.stat().st_mtime_ns == before[kept]


def test_dates_are_counted_on_the_write_and_failures_are_rows(spark, tmp_path):
    header = "DATA_OCORRENCIA_BO,RUBRICA\n"
    (tmp_path / "raw_2020.csv").write_bytes((header + "2020-02-03,Furto\n2020-02-03,FURTO \n,Outro\nnan,Roubo\n").encode("latin-1"))
    (tmp_path / "raw_2021.csv").write_bytes((header + "2021-05-01,Furto\n").encode("latin-1"))
    (tmp_path / "raw_2023.csv").write_text("RUBRICA\nFurto\n")
    raw, clean = f"{tmp_path}/raw_{{year}}.csv", f"{tmp_path}/clean_{{year}}"
    outcomes = batch.clean_and_count(spark, [2020, 2021, 2022, 2023], raw, clean)
    table = batch.outcome_table(spark, outcomes, "total long, total_null long, total_empty long")
    got = rows(table, "item")
    assert got[:3] == [("2020", None, 3, 2, 0), ("2021", None, 1, 0, 0), ("2022", "PATH_NOT_FOUND", None, None, None)]
    assert got[3][0] == "2023" and got[3][1].startswith("UNRESOLVED_COLUMN")
    assert "while processing 2022" in outcomes[2].error.__notes__[0]
    tables = {year: spark.read.parquet(clean.format(year=year)) for year in (2020, 2021)}
    assert rows(batch.missing_dates(tables), "ano") == [("2020", 3, 2, 0), ("2021", 1, 0, 0)]


def test_items_run_side_by_side_with_tables_of_their_own(spark):
    from threading import Barrier

    together, kept = Barrier(3, timeout=60), {}

    def work(item):
        together.wait()  # all three are open at once
        mine = scratch.materialize(spark.range(item))
        kept[item] = scratch.shared_folder(spark).rsplit("/", 1)[0]
        together.wait()
        if item == 2:
            raise ValueError("broken")
        return mine.count()

    outside = scratch.materialize(spark.range(7))
    outcomes = batch.run_all(spark, [1, 2, 3], work)
    assert [(o.item, o.result, type(o.error)) for o in outcomes] == [(1, 1, type(None)), (2, None, ValueError), (3, 3, type(None))]
    assert len(set(kept.values())) == 3 and not any(readers.exists(spark, place) for place in kept.values())
    assert outside.count() == 7
    with pytest.raises(ExceptionGroup):
        batch.run_each(spark, [0], lambda _: 1 / 0)
