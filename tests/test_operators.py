import pytest
from pyspark.sql import functions as F

from arealis import level_named
from arealis.operators import cleaning, combine, quality, rates, schema, tables
from arealis.plans.occurrences import clean_occurrences
from arealis.plans.study import located, scatter_base, spatial_base
from arealis.presets import vehicle


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


def test_names_collide(spark):
    df = spark.createDataFrame([(1, 2)], ["Nº", "n_o"])
    assert schema.normalize_names(df).columns == ["no", "n_o"]
    with pytest.raises(ValueError, match="same name"):
        schema.normalize_names(df.toDF("A b", "a-b"))


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert schema.drop_present(df, ["y", "z"]).columns == ["x"]
    assert rows(cleaning.upper_text(df, ["x", "z"])) == [("A", 1)]
    assert cleaning.cast_dates(df, ["z"]).columns == ["x", "y"]
    assert cleaning.add_categories(df, vehicle.CATEGORIES).columns == ["x", "y"]
    assert cleaning.add_indicators(df, vehicle.FLAGS).columns == ["x", "y"]


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(" a ", None)], "`x.y z` string, b string")
    assert rows(cleaning.blank_tokens(cleaning.trim_text(df))) == [("a", None)]
    assert rows(quality.null_profile(df), "column_name") == [("b", 1, 100.0), ("x.y z", 0, 0.0)]


def test_schema_table_and_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert rows(schema.schema_table(df), "position") == [(0, "k", "int"), (1, "v", "string")]
    assert rows(schema.preview(df, 1, "k")) == [(1, "a")]


SHEET = [
    # data, hora, rubrica, tipo, evento, latitude, id
    (" 2024-03-01 00:00:00", "13:05:00", " Furto (art. 155)", "automovel", "Furtado", "-23,5", "12"),
    ("01/03/2024", "13:05:00.0", "furto (art. 155) ", "AUTOMOVEL", "Furtado", "-23.5", " 12"),
    ("nan", "99:00:00", "ROUBO", "TRATOR", "Localizado / Entregue", "None", "x"),
    (None, None, None, None, None, None, None),
]
HEADERS = [" DATA_OCORRENCIA_BO", "HORA_OCORRENCIA ", "Rubrica", "DESCR_TIPO_VEICULO", "DESCR_OCORRENCIA_VEICULO", "LATITUDE", "ID_DELEGACIA"]


def test_clean_occurrences(either_mode):
    from datetime import date

    raw = either_mode.createDataFrame(SHEET, ", ".join(f"c{i} string" for i in range(7))).toDF(*HEADERS)
    cleaned = clean_occurrences(raw.withColumn("DESC_LEI", F.lit("x")))
    got = {row.id_delegacia: row.asDict() for row in cleaned.where("rubrica IS NOT NULL").collect()}
    assert "desc_lei" not in cleaned.columns
    assert cleaned.count() == 3  # the first two rows become equal
    theft, robbery = got[12], got[None]
    assert theft["data_ocorrencia_bo"] == date(2024, 3, 1)
    assert (theft["hora_ocorrencia_num"], theft["periodo_dia"]) == (13, "TARDE")
    assert (theft["categoria_rubrica"], theft["categoria_tipo_veiculo"]) == ("FURTO", "LEVE")
    assert (theft["is_furto"], theft["is_roubo"], theft["is_violento"], theft["is_recuperado"]) == (1, 0, 0, 0)
    assert (robbery["hora_ocorrencia"], robbery["hora_ocorrencia_num"]) == ("99:00:00", None)
    assert (robbery["is_roubo"], robbery["is_violento"], robbery["is_recuperado"]) == (1, 1, 1)
    assert robbery["latitude"] is None
    empty = cleaned.where("rubrica IS NULL").first()
    assert (empty.categoria_rubrica, empty.is_furto, empty.periodo_dia) == ("OUTROS", 0, None)


def test_cleaning_is_idempotent(spark):
    texts = spark.createDataFrame(SHEET, ", ".join(f"c{i} string" for i in range(7)))
    once = cleaning.blank_tokens(cleaning.trim_text(texts))
    assert rows(cleaning.blank_tokens(cleaning.trim_text(once))) == rows(once)
    distinct = combine.drop_duplicate_rows(once)
    assert combine.drop_duplicate_rows(distinct).count() == distinct.count()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(combine.union_by_name([a, b]), "k") == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError, match="nothing"):
        combine.union_by_name([])


def test_left_chain_keeps_the_base(spark):
    base = spark.createDataFrame([("1",), ("2",)], "k string")
    a = spark.createDataFrame([("1", 5)], "k string, a int")
    b = spark.createDataFrame([("2", 7)], "k string, b int")
    assert rows(combine.left_chain(base, [a, b], "k"), "k") == [("1", 5, None), ("2", None, 7)]


def test_semi_join_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbbccd"], "k string")
    assert rows(combine.semi_join_top(df, "k", 1).distinct()) == [("a",)]
    assert combine.semi_join_top(df, "k", 2).count() == 6


EVENTS = "cd_setor string, ano int, trimestre int, is_roubo boolean, is_furto boolean"


@pytest.fixture
def events(spark):
    data = [
        ("a", 2020, 1, True, False),
        ("a", 2020, 1, False, True),
        ("a", 2020, 1, True, True),
        ("a", 2020, 2, False, False),
        ("a", 2021, 1, None, True),
        ("b", 2020, 1, False, True),
        (None, 2020, 1, True, False),
        ("z", 2020, 1, True, False),
    ]
    return spark.createDataFrame(data, EVENTS)


@pytest.fixture
def units(spark):
    data = [("a", "d1", 1000, 2.0), ("b", "d1", 0, 0.0), ("c", "d2", 500, 1.0)]
    return spark.createDataFrame(data, "cd_setor string, nm_dist string, qt_pessoas bigint, area_km2 double")


def test_counts_per_unit_and_period(events):
    counts = rates.count_events(events, "cd_setor", ["ano", "trimestre"])
    assert rows(counts, "cd_setor", "ano") == [
        ("a", 2020, 1, 3, 2, 2),
        ("a", 2021, 1, 1, 0, 1),
        ("b", 2020, 1, 1, 0, 1),
        ("z", 2020, 1, 1, 1, 0),
    ]


def test_rates_guard_zero_population_and_area(either_mode, events, units):
    base = rates.rates_by_unit_period(events, units, "cd_setor")
    got = {(r.cd_setor, r.ano): r for r in base.collect()}
    assert set(got) == {("a", 2020), ("a", 2021), ("b", 2020)}
    assert got["a", 2020].tx_crimes_1000_hab == pytest.approx(3.0)
    assert got["a", 2020].tx_crimes_km2 == pytest.approx(1.5)
    assert got["b", 2020].tx_crimes_1000_hab is None
    assert got["b", 2020].tx_crimes_km2 is None
    assert got["b", 2020].log_tx_crimes_1000_hab is None


def test_zero_fill_keeps_every_unit(events, units):
    base = rates.rates_by_unit(events, units, "cd_setor")
    got = {r.cd_setor: (r.qt_crimes, r.tx_crimes_1000_hab) for r in base.collect()}
    assert got == {"a": (4, 4.0), "b": (1, None), "c": (0, 0.0)}
    parity = quality.key_parity(units, base, "cd_setor").first()
    assert tuple(parity) == (3, 3, True)


def test_spatial_base_has_the_floor(events, units):
    base = spatial_base(events, units, floor=500)
    assert sorted(r.cd_setor for r in base.collect()) == ["a", "c"]


def test_stored_flags_are_parsed(spark, units):
    stored = [("a", "true", "0"), ("a", "false", "false"), (None, "1", "1"), ("c", "0", "1")]
    raw = spark.createDataFrame(stored, "SJ_CD_SETOR string, is_roubo string, is_furto string")
    counts = rates.count_events(located(raw), "cd_setor")
    assert rows(counts, "cd_setor") == [("a", 1, 1, 0), ("c", 1, 0, 1)]


def test_district_rates_differ_in_population(events, units):
    base = rates.rates_by_unit_period(events, units, "cd_setor")
    as_published = rates.district_rate(base).first()
    per_resident = rates.district_rate_per_resident(base, "cd_setor").first()
    assert (as_published.qt_crimes, as_published.qt_pessoas) == (5, 2000)
    assert (per_resident.qt_crimes, per_resident.qt_pessoas) == (5, 1000)


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4)], "k string, n int")
    shares = [r.participacao_pct for r in rates.share_of_total(df, "n").collect()]
    assert sum(shares) == pytest.approx(100)


def test_top_rows_are_stable(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)], "k string, v double")
    assert [r.k for r in rates.top_rows(df, 3, "v", "k").collect()] == ["b", "c", "a"]


def test_frequencies(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 1)], "a string, b int")
    assert rows(tables.frequency_table(df, "a")) == [("x", 2), (None, 1)]
    multi = rows(tables.frequency_tables(df, ["a", "b"]), "variable", "value")
    assert multi == [("a", None, 1), ("a", "x", 2), ("b", "1", 2), ("b", "2", 1)]


def test_category_grid(spark):
    df = spark.createDataFrame([("r", "A"), ("r", "A"), ("s", "B"), ("t", "C"), ("u", None)], "row string, cat string")
    assert rows(tables.category_grid(df, "row", "cat", ["A", "B"]), "row") == [("r", 2, 0), ("s", 0, 1)]


def test_categories_partition_the_rows(spark):
    df = spark.createDataFrame([(r,) for r in ("FURTO", "x", None, "ARMA")], "rubrica string")
    counted = cleaning.add_categories(df, vehicle.CATEGORIES).groupBy("categoria_rubrica").count()
    assert sum(r["count"] for r in counted.collect()) == 4


def test_quality_reports(spark):
    df = spark.createDataFrame([("2020", " "), ("2020", "NaN"), ("2020", None), ("2021", "v"), ("2021", "")], "y string, v string")
    profile = {r.column_name: (r.missing, r.missing_pct) for r in quality.null_profile(df).collect()}
    assert profile == {"y": (0, 0.0), "v": (4, 80.0)}
    assert rows(quality.missing_by(df, ["y"], "v"), "y") == [("2020", 3, 1, 0), ("2021", 2, 0, 1)]
    assert tuple(quality.coverage(df, "v").first()) == (4, 5, 80.0)


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert tuple(quality.duplicate_report(df).first()) == (3, 2)
    assert tuple(quality.duplicate_report(df.limit(0)).first()) == (0, 0)


def test_scatter_base(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, 1500.0), (1.0, None)], "x double, tx_crimes_1000_hab double")
    assert rows(scatter_base(df, "x")) == [(1.0, 2.0)]


def test_levels():
    assert level_named("setor").key == "cd_setor"
    assert level_named("distrito").key == "cd_dist"
    with pytest.raises(ValueError, match="unknown level"):
        level_named("bairro")
