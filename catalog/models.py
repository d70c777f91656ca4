"""Regression models and their tables.

The SQL side solves the normal equations with the sweep operator, one common table per predictor,
and integrates Student's density numerically, so it shares no method with the Spark side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import regression
from arealis.operators.combine import union_by_name
from arealis.operators.rates import population_floor
from arealis.plans import study
from arealis.presets import analysis
from catalog.rates import FULL, FULL_BASE, full_rate_base
from catalog.registry import query, rounded, with_adapters

POPULATED = f"{FULL_BASE}, populated AS (SELECT * FROM base WHERE qt_pessoas >= 100)"
START = with_adapters(*FULL, then=POPULATED)
SIMPSON = 2000


def _cell(i: int, j: int) -> str:
    return f"a{min(i, j)}_{max(i, j)}"


def sweep_sql(tag: str, predictors) -> str:
    """Common tables ending in ``{tag}_fit``: n, means and the swept matrix of one model."""
    names = [analysis.LOG_RATE, *predictors]
    size = len(names)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    complete = " AND ".join(f"{name} IS NOT NULL" for name in names)
    columns = ", ".join(f"CAST({name} AS DOUBLE) AS z{i}" for i, name in enumerate(names))
    means = ", ".join(f"avg(z{i}) AS m{i}" for i in range(size))
    start = ", ".join(f"count(*) * covar_pop(z{i}, z{j}) AS {_cell(i, j)}" for i, j in pairs)
    parts = [
        f"{tag}_z AS (SELECT {columns} FROM populated WHERE {complete})",
        f"{tag}_s0 AS (SELECT count(*) AS n, {means}, {start}, count(*) * covar_pop(z0, z0) AS tss FROM {tag}_z)",
    ]
    kept = ", ".join(["n", "tss", *[f"m{i}" for i in range(size)]])
    for p in range(1, size):
        pivot = _cell(p, p)
        swept = []
        for i, j in pairs:
            if i == p and j == p:
                value = f"-1 / {pivot}"
            elif p in (i, j):
                value = f"{_cell(i, j)} / {pivot}"
            else:
                value = f"{_cell(i, j)} - {_cell(i, p)} * {_cell(p, j)} / {pivot}"
            swept.append(f"{value} AS {_cell(i, j)}")
        parts.append(f"{tag}_s{p} AS (SELECT {kept}, {', '.join(swept)} FROM {tag}_s{p - 1})")
    parts.append(f"{tag}_fit AS (SELECT *, a0_0 AS rss, n - {size} AS df FROM {tag}_s{size - 1})")
    return ", ".join(parts)


def _leverage(size: int) -> str:
    return "(" + " + ".join(f"-{_cell(i, j)} * m{i} * m{j}" for i in range(1, size) for j in range(1, size)) + ")"


def terms_sql(tag: str, model: str, predictors) -> str:
    """One row per term: coefficient, standard error and variance inflation."""
    size = len(predictors) + 1
    intercept = "m0 - (" + " + ".join(f"a0_{i} * m{i}" for i in range(1, size)) + ")"
    rows = [
        f"SELECT '{model}' AS model, 'const' AS term, {intercept} AS coef, "
        f"sqrt(rss / df * (1.0 / n + {_leverage(size)})) AS std_err, df, 1 + n * {_leverage(size)} AS vif FROM {tag}_fit"
    ]
    for i, name in enumerate(predictors, 1):
        rows.append(
            f"SELECT '{model}', '{name}', a0_{i}, sqrt(rss / df * -{_cell(i, i)}), df, "
            f"-{_cell(i, i)} * (SELECT count(*) * var_pop(z{i}) FROM {tag}_z) FROM {tag}_fit"
        )
    return " UNION ALL ".join(rows)


def two_sided_sql(t: str, df: str) -> str:
    """P(|T| >= |t|) as one minus twice Simpson's integral of the density from 0 to |t|."""
    step = f"(abs({t}) / {SIMPSON})"
    weight = f"CASE WHEN i = 0 OR i = {SIMPSON} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = f"pow(1 + pow({step} * i, 2) / {df}, -({df} + 1) / 2.0)"
    constant = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt({df} * pi())"
    return (
        f"(1 - 2 * {constant} * {step} / 3 * "
        f"list_sum(list_transform(range({SIMPSON + 1}), lambda i: {weight} * {density})))"
    )


TAGS = {name: f"f{i}" for i, name in enumerate(analysis.MODELS, 1)}
ALL_FITS = ", ".join(sweep_sql(TAGS[name], predictors) for name, predictors in analysis.MODELS.items())
ALL_TERMS = "terms AS (" + " UNION ALL ".join(
    terms_sql(TAGS[name], name, predictors) for name, predictors in analysis.MODELS.items()
) + f"), tested AS (SELECT *, coef / std_err AS t, {two_sided_sql('(coef / std_err)', 'df')} AS p_value FROM terms)"
MODELS_SQL = f"{START}, {ALL_FITS}, {ALL_TERMS} "


def populated(t):
    return population_floor(full_rate_base(t), analysis.POPULATION_FLOOR_MODEL)


def fits(t, *names: str):
    models = {name: analysis.MODELS[name] for name in names or analysis.MODELS}
    return regression.fit_models(populated(t), analysis.LOG_RATE, models)


COEFFICIENTS = ("coef", "std_err", "t", "p_value")


def _model_query(key: str, name: str) -> None:
    """Coefficients, errors and significance of one model."""
    rounds = ", ".join(f"round({column}, 6) AS {column}" for column in COEFFICIENTS)
    tag, predictors = TAGS[name], analysis.MODELS[name]
    terms = (
        f"terms AS ({terms_sql(tag, name, predictors)}), "
        f"tested AS (SELECT *, coef / std_err AS t, {two_sided_sql('(coef / std_err)', 'df')} AS p_value FROM terms)"
    )

    @query(key, f"{START}, {sweep_sql(tag, predictors)}, {terms} SELECT model, term, {rounds} FROM tested")
    def build(t):
        table = regression.coefficient_table(t.spark, fits(t, name))
        return rounded(table.select("model", "term", *COEFFICIENTS), COEFFICIENTS)


_model_query("ols_1", "Modelo 1")
_model_query("ols_2", "Modelo 2")
_model_query("ols_4", "Modelo 3")


def _across(field: str) -> str:
    cells = ", ".join(
        f"round(max(CASE WHEN model = '{name}' THEN {field} END), 6) AS \"{name}\"" for name in analysis.MODELS
    )
    return MODELS_SQL + f"SELECT term, {cells} FROM tested GROUP BY term"


@query("model_coefficients", _across("coef"))
def model_coefficients(t):
    return rounded(regression.compare_models(t.spark, fits(t), "coef"), list(analysis.MODELS))


@query("model_pvalues", _across("p_value"))
def model_pvalues(t):
    return rounded(regression.compare_models(t.spark, fits(t), "p_value"), list(analysis.MODELS))


R2 = "(1 - rss / tss)"


@query(
    "model_fit",
    f"{START}, {ALL_FITS} "
    + " UNION ALL ".join(
        f"SELECT '{analysis.MODEL_TITLES[name]}' AS model, round({R2}, 6) AS r_squared, "
        f"round(1 - (rss / tss) * (n - 1) / df, 6) AS adj_r_squared, n AS observations FROM {tag}_fit"
        for name, tag in TAGS.items()
    ),
)
def model_fit(t):
    table = regression.fit_table(t.spark, fits(t), analysis.MODEL_TITLES)
    return rounded(table, ["r_squared", "adj_r_squared"])


def _model_table_sql() -> str:
    lines = []
    for position, (label, term, form) in enumerate(analysis.MODEL_ROWS):
        cells = ", ".join(
            f"coalesce(max(CASE WHEN model = '{name}' THEN printf('{form}', coef) END), '-') AS \"{name}\""
            for name in analysis.MODELS
        )
        lines.append(
            f"SELECT {position} AS position, '{label}' AS variable, {cells} FROM tested WHERE term = '{term}'"
        )
    cells = ", ".join(f"(SELECT printf('%.3f', {R2}) FROM {tag}_fit)" for tag in TAGS.values())
    lines.append(f"SELECT {len(analysis.MODEL_ROWS)}, 'R²', {cells}")
    return MODELS_SQL + " UNION ALL ".join(lines)


@query("model_table", _model_table_sql())
def model_table(t):
    return regression.model_table(t.spark, fits(t), analysis.MODEL_ROWS)


@query(
    "vif",
    MODELS_SQL + "SELECT term AS variable, round(vif, 6) AS vif FROM terms WHERE model = 'Modelo 3'",
)
def vif(t):
    return rounded(regression.vif_table(t.spark, fits(t, "Modelo 3")["Modelo 3"]), ["vif"])


def _omnibus_sql() -> str:
    """Squares of the two published z scores of skewness and kurtosis, written out."""
    y = "(sk * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))))"
    beta = "(3.0 * (n * n + 27.0 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)))"
    w2 = f"(sqrt(2 * ({beta} - 1)) - 1)"
    scaled = f"({y} / sqrt(2 / ({w2} - 1)))"
    z1 = f"(ln({scaled} + sqrt({scaled} * {scaled} + 1)) / sqrt(ln({w2}) / 2))"
    x = (
        "((ku - 3.0 * (n - 1) / (n + 1)) / "
        "sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) * (n + 1) * (n + 3) * (n + 5))))"
    )
    b = "(6.0 * (n * n - 5.0 * n + 2) / ((n + 7.0) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))))"
    a = f"(6 + 8 / {b} * (2 / {b} + sqrt(1 + 4 / ({b} * {b}))))"
    z2 = f"((1 - 2 / (9 * {a}) - cbrt((1 - 2 / {a}) / (1 + {x} * sqrt(2 / ({a} - 4))))) / sqrt(2 / (9 * {a})))"
    return f"({z1} * {z1} + {z2} * {z2})"


OMNIBUS = _omnibus_sql()


def _diagnostics_select() -> str:
    lines = []
    for name, predictors in analysis.MODELS.items():
        tag, k = TAGS[name], len(predictors)
        fitted = " + ".join(f"a0_{i} * (z{i} - m{i})" for i in range(1, k + 1))
        f = f"(((tss - rss) / {k}) / (rss / df))"
        x = f"(df / (df + {k} * {f}))"
        tail = {
            1: two_sided_sql(f"sqrt({f})", "df"),
            2: f"pow({x}, df / 2.0)",
            4: f"(pow({x}, df / 2.0) * (1 + df / 2.0 * (1 - {x})))",
        }[k]
        log_likelihood = "(-n / 2.0 * (ln(2 * pi()) + ln(rss / n) + 1))"
        lines.append(
            f"""SELECT '{name}' AS model, n AS observations, {k} AS df_model, df AS df_residual,
            round({R2}, 6) AS r_squared, round(1 - (rss / tss) * (n - 1) / df, 6) AS adj_r_squared,
            round({f}, 6) AS f_statistic, round({tail}, 6) AS f_p_value,
            round({log_likelihood}, 6) AS log_likelihood, round(2 * {k + 1} - 2 * {log_likelihood}, 6) AS aic,
            round(ln(n) * {k + 1} - 2 * {log_likelihood}, 6) AS bic,
            round(sk, 6) AS skewness, round(ku, 6) AS kurtosis,
            round(n / 6.0 * (sk * sk + (ku - 3) * (ku - 3) / 4), 6) AS jarque_bera,
            round(exp(-(n / 12.0 * (sk * sk + (ku - 3) * (ku - 3) / 4))), 6) AS jarque_bera_p,
            round({OMNIBUS}, 6) AS omnibus, round(exp(-{OMNIBUS} / 2), 6) AS omnibus_p
            FROM {tag}_fit, (SELECT avg(e * e * e) / pow(avg(e * e), 1.5) AS sk,
                avg(e * e * e * e) / pow(avg(e * e), 2) AS ku
                FROM (SELECT z0 - m0 - ({fitted}) AS e FROM {tag}_z, {tag}_fit) r) shape"""
        )
    return " UNION ALL ".join(lines)


DIAGNOSTICS = (
    "r_squared", "adj_r_squared", "f_statistic", "f_p_value", "log_likelihood", "aic", "bic", "skewness",
    "kurtosis", "jarque_bera", "jarque_bera_p", "omnibus", "omnibus_p",
)


@query("ols_diagnostics", f"{START}, {ALL_FITS} {_diagnostics_select()}")
def ols_diagnostics(t):
    base = study.model_table_of(full_rate_base(t))
    found = regression.fit_models(base, analysis.LOG_RATE, analysis.MODELS)
    return rounded(regression.diagnostics(base, found).drop("condition_number"), DIAGNOSTICS)


@query("regression_study", _model_table_sql())
def regression_study(t):
    """The whole study, with its base computed once; the formatted table stands for the rest."""
    return study.regression_study(full_rate_base(t)).final


def _critical_sql(df: str) -> str:
    """The 97.5 % point of Student's t from the normal one, by Fisher's expansion to the fourth power of 1 / df."""
    z = 1.959963984540054
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    return f"({z} + " + " + ".join(f"{term!r} / pow({df}, {k})" for k, term in enumerate(terms, 1)) + ")"


INTERVAL = ("ci_low", "ci_high")


@query(
    "ols_intervals",
    MODELS_SQL
    + f"SELECT model, term, round(coef - {_critical_sql('df')} * std_err, 5) AS ci_low, "
    + f"round(coef + {_critical_sql('df')} * std_err, 5) AS ci_high FROM tested",
)
def ols_intervals(t):
    table = regression.coefficient_table(t.spark, fits(t))
    return rounded(table.select("model", "term", *INTERVAL), INTERVAL, 5)


def _largest_sql(matrix: str, size: int) -> str:
    """Largest eigenvalue of a positive matrix, a list of lists: its Rayleigh quotient at a high power of it."""
    each = f"range(1, {size + 1})"

    def times(a: str, b: str) -> str:
        cell = f"list_sum(list_transform({each}, lambda l: {a}[i][l] * {b}[l][j]))"
        return f"list_transform({each}, lambda i: list_transform({each}, lambda j: {cell}))"

    def trace(m: str) -> str:
        return "(" + " + ".join(f"{m}[{i}][{i}]" for i in range(1, size + 1)) + ")"

    scaled = f"list_transform(p, lambda row: list_transform(row, lambda x: x / {trace('p')}))"
    return f"""(WITH RECURSIVE powers AS (SELECT 0 AS step, m, m AS p FROM (SELECT {matrix} AS m) start
        UNION ALL SELECT step + 1, m, {times("q", "q")} FROM (SELECT step, m, {scaled} AS q FROM powers WHERE step < 12) s),
        last AS (SELECT m, p FROM powers WHERE step = 12), product AS (SELECT p, {times("m", "p")} AS mp FROM last)
        SELECT {trace("mp")} / {trace("p")} FROM product)"""


def _condition_sql(tag: str, predictors) -> str:
    """Root of the ratio of the extreme eigenvalues of the design's Gram matrix; the least is that of its inverse."""
    size = len(predictors) + 1
    inside = range(1, size)

    def total(i: int, j: int) -> str:
        names = [f"z{k}" for k in (i, j) if k]
        return f"(SELECT sum({' * '.join(names) if names else '1.0'}) FROM {tag}_z)"

    gram = "[" + ", ".join("[" + ", ".join(total(i, j) for j in range(size)) + "]" for i in range(size)) + "]"
    leaned = {i: "(" + " + ".join(f"-{_cell(i, j)} * m{j}" for j in inside) + ")" for i in inside}

    def inverse(i: int, j: int) -> str:
        if i and j:
            return f"-{_cell(i, j)}"
        return f"-{leaned[i or j]}" if i or j else f"1.0 / n + {_leverage(size)}"

    rows = "[" + ", ".join("[" + ", ".join(inverse(i, j) for j in range(size)) + "]" for i in range(size)) + "]"
    least = f"(SELECT {rows} FROM {tag}_fit)"
    return f"sqrt({_largest_sql(gram, size)} * {_largest_sql(least, size)})"


def _conditions_select() -> str:
    lines = (f"SELECT '{name}' AS model, {_condition_sql(TAGS[name], p)} AS condition_number" for name, p in analysis.MODELS.items())
    return " UNION ALL ".join(lines)


@query("ols_condition", f"{START}, {ALL_FITS} SELECT model, round(condition_number, 4) AS condition_number FROM ({_conditions_select()}) c")
def ols_condition(t):
    base = study.model_table_of(full_rate_base(t))
    found = regression.fit_models(base, analysis.LOG_RATE, analysis.MODELS)
    return rounded(regression.diagnostics(base, found).select("model", "condition_number"), ["condition_number"], 4)


def _study_sql() -> str:
    """All tables of the study, one value a row."""
    lines = [f"SELECT 'coefficients' AS part, model, term, round(coef, 6) AS value FROM tested"]
    lines.append("SELECT 'p_values', model, term, round(p_value, 6) FROM tested")
    lines.append("SELECT 'vif', 'Modelo 3', term, round(vif, 6) FROM terms WHERE model = 'Modelo 3'")
    for name, tag in TAGS.items():
        title = analysis.MODEL_TITLES[name]
        lines.append(f"SELECT 'fit', '{title}', 'r_squared', round({R2}, 6) FROM {tag}_fit")
        lines.append(f"SELECT 'fit', '{title}', 'adj_r_squared', round(1 - (rss / tss) * (n - 1) / df, 6) FROM {tag}_fit")
        lines.append(f"SELECT 'fit', '{title}', 'observations', CAST(n AS DOUBLE) FROM {tag}_fit")
    lines += [f"SELECT 'diagnostics', model, '{name}', round({name}, 6) FROM diagnosed" for name in DIAGNOSTICS]
    return f"{MODELS_SQL}, diagnosed AS ({_diagnostics_select()}) " + " UNION ALL ".join(lines)


@query("regression_study_tables", _study_sql())
def regression_study_tables(t):
    """The tables of the study beside its formatted one: coefficients, p-values, fit, inflation and diagnostics."""
    found = study.regression_study(full_rate_base(t))

    def long(part: str, table, model: str, term: str, names) -> object:
        columns = [F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").cast("double").alias("value")) for name in names]
        rows = table.select("*", F.explode(F.array(*columns)).alias("_cell")).select("*", "_cell.name", "_cell.value")
        return rows.selectExpr(f"'{part}' AS part", f"{model} AS model", f"{term} AS term", "round(value, 6) AS value").where("value IS NOT NULL")

    parts = [
        long("coefficients", found.coefficients, "name", "term", analysis.MODELS),
        long("p_values", found.p_values, "name", "term", analysis.MODELS),
        long("vif", found.vif, f"'{list(found.fits)[-1]}'", "variable", ["vif"]),
        long("fit", found.fit, "model", "name", ["r_squared", "adj_r_squared", "observations"]),
        long("diagnostics", found.diagnostics, "model", "name", DIAGNOSTICS),
    ]
    return union_by_name(parts)


GRAM = ("l_quantity", "l_discount", "l_tax")


@query(
    "gram_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS \"column\", round(sum({a} * {b}), 4) AS value FROM lineitem"
        for i, a in enumerate(GRAM)
        for b in GRAM[i:]
    ),
)
def gram_matrix(t):
    return rounded(regression.gram_matrix(t.table("lineitem"), GRAM), ["value"], 4)
