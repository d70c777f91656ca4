from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from arealis.functions import (
    census_bigint,
    census_double,
    census_text,
    clock_hour,
    composite_mean,
    log1p_or_null,
    normalize_name,
    null_tokens_to_null,
    parse_clock,
    parse_coordinate,
    parse_date,
    parse_flag,
    parse_integer,
    parse_number,
    parse_timestamp,
    rate_per,
    safe_ratio,
    tidy,
    weighted_share,
    yes_share,
)
from arealis.functions.rules import Rule, categorize
from arealis.plans.units import sector_type
from arealis.presets import vehicle

pytestmark = pytest.mark.usefixtures("either_mode")


def check(apply, function, cases, type_="string"):
    assert apply(function, list(cases), type_) == list(cases.values())


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        (" Órgão  Nº (BO) ", "orgao_no_bo"),
        ("__A--B__", "a_b"),
        ("DATA OCORRENCIA BO ", "data_ocorrencia_bo"),
        ("já_limpo", "ja_limpo"),
    ],
)
def test_normalize_name(raw, name):
    assert normalize_name(raw) == name
    assert normalize_name(name) == name


def test_null_tokens(apply):
    gone = ["", "  ", "nan", " NaN ", "NAN", "null", "NULL", "None", None]
    assert apply(null_tokens_to_null, gone) == [None] * len(gone)
    kept = ["none", "Nan", "Null", " x ", "0"]
    assert apply(null_tokens_to_null, kept) == kept


def test_null_tokens_keep_type(apply):
    assert apply(null_tokens_to_null, [1, 0, None], "int") == [1, 0, None]


def test_trim_takes_spaces_only_unless_asked(apply):
    assert apply(tidy, ["  a ", "\ta\n"]) == ["a", "\ta\n"]
    assert apply(lambda x: tidy(x, "all"), [" \ta\n", "a b"]) == ["a", "a b"]


def test_dates(apply):
    check(
        apply,
        parse_date,
        {
            "2024-02-29 10:00": date(2024, 2, 29),
            "  2024-01-02": date(2024, 1, 2),
            "01/02/2024x": date(2024, 2, 1),
            "2023-02-29": None,
            "2024-13-45": None,
            "31/04/2024": None,
            "1999-01-01": None,
            "01/02/1999": None,
            "1/2/2024": None,
            "": None,
            None: None,
        },
    )


def test_timestamps(apply):
    check(
        apply,
        parse_timestamp,
        {
            "2024-01-02 03:04:05": datetime(2024, 1, 2, 3, 4, 5),
            "02/01/2024 03:04:05": datetime(2024, 1, 2, 3, 4, 5),
            "2024-01-02": datetime(2024, 1, 2),
            "02/01/2024": datetime(2024, 1, 2),
            "1999-12-31": datetime(1999, 12, 31),
            "2024-01-01T00:00:00": None,
            "2024-01-01 24:00:00": None,
            "31/02/2024": None,
            " 2024-01-02": None,
            "x": None,
            None: None,
        },
    )


def test_integers(apply):
    check(
        apply,
        parse_integer,
        {"007": 7, " 12 ": 12, "2147483647": 2147483647, "2147483648": None, "-1": None, "1.0": None, "": None, None: None},
    )


def test_clock_and_hour(apply):
    texts = {"23:59:59.9": "23:59:59", " 01:02:03": "01:02:03", "99:00:00": "99:00:00", "9:00:00": None, None: None}
    check(apply, parse_clock, texts)
    check(apply, clock_hour, {"23:59:59": 23, "00:00:00": 0, "99:00:00": None, "12:60:00": None, None: None})


def test_coordinates(apply):
    check(
        apply,
        parse_coordinate,
        {"-23,5": -23.5, " 46.25 ": 46.25, "0": 0.0, "1.234,5": None, "+1": None, "1e3": None, "-": None, None: None},
    )


def test_numbers(apply):
    check(apply, parse_number, {"1e3": 1000.0, "-2.5": -2.5, "12d": None, "NaN": None, "Infinity": None, None: None})


def test_census_numbers(apply):
    check(apply, census_text, {"X": None, "x": None, ".": None, " - ": None, "": None, " 7 ": "7", None: None})
    check(apply, census_bigint, {"X": None, " 12 ": 12, "12.7": 12, "-0.5": 0, "1.234,56": None, "12,5": None, ".": None, "9" * 19: None, None: None})
    check(apply, census_double, {"x": None, "12,5": 12.5, " 3.25": 3.25, "1.234,56": None, "-": None, None: None})


def test_flags(apply):
    check(apply, parse_flag, {"true": True, "1": True, "0": False, "FALSE": False, "x": None, None: None})
    assert apply(parse_flag, [1, 0, None], "int") == [True, False, None]
    assert apply(parse_flag, [1.0, 0.0, None], "double") == [True, False, None]
    check(apply, parse_flag, {"1.0": True, "0.0": False, " 1.00 ": True, "nan": None})
    from decimal import Decimal

    assert apply(parse_flag, [Decimal("1.0"), Decimal("0.0")], "decimal(3,1)") == [True, False]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 1), (0, 5), (3, 4)], "a int, b int")
    got = [tuple(row) for row in df.select(safe_ratio(F.col("a"), F.col("b")), rate_per(F.col("a"), F.col("b"))).collect()]
    assert got == [(None, None), (None, None), (None, None), (0.0, 0.0), (0.75, 750.0)]


def test_rate_needs_a_positive_base(spark):
    df = spark.createDataFrame([(2, -4)], "a int, b int")
    assert df.select(rate_per(F.col("a"), F.col("b"))).first()[0] is None


def test_shares(spark):
    df = spark.createDataFrame([(3, 1, 0, 2), (0, 0, 0, 0), (None, 1, 1, 1)], "a int, b int, c int, d int")
    got = df.select(
        yes_share(F.col("a"), F.col("b")),
        weighted_share({"b": 1, "c": 2, "d": 3}, ["a", "b", "c", "d"]),
        composite_mean([F.col("a"), 1 - F.col("b")]),
    ).collect()
    assert [tuple(row) for row in got] == [(0.75, 7 / 6, 1.5), (None, None, 0.5), (None, None, None)]


def test_log1p(apply):
    assert apply(log1p_or_null, [0.0, -1.0, -2.0, None], "double") == [0.0, None, None, None]


def rules(table, default):
    return lambda value: categorize(value, table, default)


def test_period_of_day(apply):
    check(
        apply,
        rules(vehicle.PERIOD_OF_DAY, None),
        {0: "MADRUGADA", 5: "MADRUGADA", 6: "MANHA", 11: "MANHA", 12: "TARDE", 17: "TARDE", 18: "NOITE", 23: "NOITE", 24: None, None: None},
        "int",
    )


def test_offences(apply):
    check(
        apply,
        rules(vehicle.OFFENCE, "OUTROS"),
        {
            "FURTO QUALIFICADO": "FURTO",
            "furto (art. 155)": "FURTO",
            "TENTATIVA DE ROUBO": "OUTROS",
            "ROUBO": "ROUBO",
            "localização/apreensão de veículo": "RECUPERACAO",
            "Entrega": "RECUPERACAO",
            "RECEPTAÇÃO": "RECEPTACAO",
            "ADULTERAÇÃO": "ADULTERACAO",
            "APROPRIAÇÃO INDÉBITA": "FRAUDE",
            "Choque": "ACIDENTE",
            "LESÃO CORPORAL": "VIOLENCIA",
            "TRÁFICO": "DROGAS",
            "PORTE DE ARMA DE FOGO": "ARMAS",
            "OUTRA": "OUTROS",
            None: "OUTROS",
        },
    )


def test_vehicle_types_first_match_wins(apply):
    check(
        apply,
        rules(vehicle.VEHICLE_TYPE, "OUTROS"),
        {
            "AUTOMOVEL": "LEVE",
            "MOTONETA": "MOTOCICLETA",
            "CAMINHÃO TRATOR": "PESADO",
            "TRATOR DE RODAS": "MAQUINARIO",
            "trator": "MAQUINARIO",
            "MICRO-ONIBUS": "TRANSPORTE_PUBLICO",
            "BICICLETA": "BICICLETA",
            "bicicleta": "OUTROS",
            None: "OUTROS",
        },
    )


def test_other_categories(apply):
    check(apply, rules(vehicle.CONDUCT, "NAO_INFORMADO"), {"CARGA": "CARGA", "FIOS E CABOS": "OUTROS", "?": "NAO_INFORMADO", None: "NAO_INFORMADO"})
    check(apply, rules(vehicle.VEHICLE_EVENT, "OUTROS"), {"Localizado / Entregue": "RECUPERADO", "Furtado": "FURTADO", "roubado": "OUTROS", None: "OUTROS"})
    check(apply, rules(vehicle.PLACE_TYPE, "OUTROS"), {"Via Pública": "VIA_PUBLICA", "Favela": "RESIDENCIAL", "Saúde": "PUBLICO", "Unidade Rural": "AREA_ABERTA", "x": "OUTROS"})
    check(apply, sector_type, {"0": "NAO_ESPECIAL", "9": "AGRUPAMENTO_QUILOMBOLA", "10": "OUTROS", "x": "OUTROS", None: "OUTROS"})


def test_regex_rule_ignores_case(apply):
    table = [Rule("A", "regex", ("^Ç[0-9]",))]
    check(apply, rules(table, "B"), {"ç1": "A", "Ç2x": "A", "xç1": "B", None: "B"})


def test_unknown_rule_kind():
    with pytest.raises(ValueError, match="unknown rule kind"):
        Rule("A", "like", ("x",)).test(F.lit("x"), F.lit("X"))
