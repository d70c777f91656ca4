"""Ordinary least squares from sufficient statistics.

All models are fitted from one aggregation: counts, means and co-moments over each model's complete
rows. These merge partition by partition, so the data is read once however many models there are,
and only a k-by-k matrix per model reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arealis.functions.text import column
from arealis.operators.schema import require
from arealis.operators.significance import chi2_upper, f_upper, omnibus, t_critical, t_two_sided

CONSTANT = "const"


@dataclass(frozen=True)
class OlsFit:
    """A fitted model. Vectors run over the intercept first, then the predictors."""

    name: str
    target: str
    predictors: tuple[str, ...]
    n: int
    coefficients: np.ndarray
    std_errors: np.ndarray
    residual_ss: float
    total_ss: float
    vif: np.ndarray
    condition_number: float

    @property
    def terms(self) -> tuple[str, ...]:
        return (CONSTANT, *self.predictors)

    @property
    def df_model(self) -> int:
        return len(self.predictors)

    @property
    def df_residual(self) -> int:
        return self.n - len(self.terms)

    @property
    def r_squared(self) -> float | None:
        """None for a constant target."""
        return 1 - self.residual_ss / self.total_ss if self.total_ss else None

    @property
    def adjusted_r_squared(self) -> float | None:
        if self.r_squared is None:
            return None
        return 1 - (1 - self.r_squared) * (self.n - 1) / self.df_residual

    @property
    def t_values(self) -> list[float | None]:
        """None where the fit is perfect and the standard error is zero."""
        pairs = zip(self.coefficients, self.std_errors, strict=True)
        return [float(coef / error) if error else None for coef, error in pairs]

    @property
    def p_values(self) -> list[float | None]:
        return [None if t is None else t_two_sided(t, self.df_residual) for t in self.t_values]

    @property
    def f_statistic(self) -> float | None:
        """None for a perfect fit, and so are the values below."""
        explained = (self.total_ss - self.residual_ss) / self.df_model
        if self.residual_ss == 0:
            return None
        return explained / (self.residual_ss / self.df_residual)

    @property
    def f_p_value(self) -> float | None:
        return None if self.f_statistic is None else f_upper(self.f_statistic, self.df_model, self.df_residual)

    @property
    def log_likelihood(self) -> float | None:
        if self.residual_ss == 0:
            return None
        return -self.n / 2 * (math.log(2 * math.pi) + math.log(self.residual_ss / self.n) + 1)

    @property
    def aic(self) -> float | None:
        return None if self.log_likelihood is None else 2 * len(self.terms) - 2 * self.log_likelihood

    @property
    def bic(self) -> float | None:
        return None if self.log_likelihood is None else math.log(self.n) * len(self.terms) - 2 * self.log_likelihood

    def prediction(self) -> Column:
        """The fitted value as a column expression."""
        slopes = zip(self.predictors, self.coefficients[1:], strict=True)
        parts = [column(name) * F.lit(float(slope)) for name, slope in slopes]
        return reduce(add, parts, F.lit(float(self.coefficients[0])))

    def residual(self) -> Column:
        return column(self.target) - self.prediction()


def fit_models(
    df: DataFrame, target: str, models: Mapping[str, Sequence[str]]
) -> dict[str, OlsFit]:
    """Fit every model in one pass; each uses the rows where its own columns are all present."""
    require(df, [target, *{name for predictors in models.values() for name in predictors}])
    moments = df.agg(
        *[_moments(target, predictors).alias(f"m{i}") for i, predictors in enumerate(models.values())]
    ).first()
    return {
        name: _solve(name, target, tuple(predictors), moments[f"m{i}"])
        for i, (name, predictors) in enumerate(models.items())
    }


def _complete(names: Sequence[str]) -> Column:
    return reduce(and_, [column(name).isNotNull() for name in names])


def _moments(target: str, predictors: Sequence[str]) -> Column:
    names = [target, *predictors]
    complete = _complete(names)
    masked = [F.when(complete, column(name).cast("double")) for name in names]
    pairs = combinations_with_replacement(range(len(names)), 2)
    return F.struct(
        F.count_if(complete).alias("n"),
        *[F.avg(value).alias(f"a{i}") for i, value in enumerate(masked)],
        *[F.covar_pop(masked[i], masked[j]).alias(f"c{i}_{j}") for i, j in pairs],
    )


def _solve(name: str, target: str, predictors: tuple[str, ...], moments: Row) -> OlsFit:
    size, n = len(predictors) + 1, moments["n"]
    if n <= size:
        raise ValueError(f"model {name!r}: {n} complete rows for {size} coefficients")
    means = np.array([moments[f"a{i}"] for i in range(size)])
    scatter = np.empty((size, size))
    for i, j in combinations_with_replacement(range(size), 2):
        scatter[i, j] = scatter[j, i] = moments[f"c{i}_{j}"] * n
    scale = np.sqrt(np.diag(scatter))
    if not scale[1:].all():
        raise ValueError(f"model {name!r}: a predictor is constant")
    correlation = scatter[1:, 1:] / np.outer(scale[1:], scale[1:])
    if np.linalg.cond(correlation) > 1 / np.finfo(float).eps:
        raise ValueError(f"model {name!r}: predictors are linearly dependent")
    inverse_correlation = np.linalg.inv(correlation)
    inverse = inverse_correlation / np.outer(scale[1:], scale[1:])
    slopes = inverse @ scatter[1:, 0]
    center = means[1:]
    residual_ss = max(0.0, float(scatter[0, 0] - slopes @ scatter[1:, 0]))
    variance = residual_ss / (n - size)
    mean_leverage = float(center @ inverse @ center)
    return OlsFit(
        name=name,
        target=target,
        predictors=predictors,
        n=n,
        coefficients=np.concatenate([[means[0] - slopes @ center], slopes]),
        std_errors=np.sqrt(variance * np.concatenate([[1 / n + mean_leverage], np.diag(inverse)])),
        residual_ss=residual_ss,
        total_ss=float(scatter[0, 0]),
        vif=np.concatenate([[1 + n * mean_leverage], np.diag(inverse_correlation)]),
        condition_number=_condition_number(n, center, scatter[1:, 1:]),
    )


def _condition_number(n: int, center: np.ndarray, scatter: np.ndarray) -> float:
    """Of the design matrix with its constant: root of the eigenvalue ratio of its Gram matrix."""
    crossed = np.concatenate([[n], n * center])
    gram = np.vstack([crossed, np.column_stack([n * center, scatter + n * np.outer(center, center)])])
    eigenvalues = np.linalg.eigvalsh(gram)
    return float(np.sqrt(eigenvalues[-1] / eigenvalues[0]))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small result table; its length is the number of models times the number of terms."""
    return spark.createDataFrame(rows, schema)


def coefficient_table(spark: SparkSession, fits: Mapping[str, OlsFit]) -> DataFrame:
    """One row per model and term, with significance and the 95 % interval."""
    rows = []
    for fit in fits.values():
        reach = t_critical(0.05, fit.df_residual)
        lines = zip(
            fit.terms, fit.coefficients, fit.std_errors, fit.t_values, fit.p_values, strict=True
        )
        for term, coef, error, t, p in lines:
            bounds = (coef - reach * error, coef + reach * error)
            rows.append((fit.name, term, float(coef), float(error), t, p, *map(float, bounds)))
    return _table(
        spark,
        rows,
        "model string, term string, coef double, std_err double, t double, p_value double, "
        "ci_low double, ci_high double",
    )


def compare_models(spark: SparkSession, fits: Mapping[str, OlsFit], field: str) -> DataFrame:
    """Terms against models; ``field`` is ``coef`` or ``p_value``, NULL where a term is absent."""
    long = coefficient_table(spark, fits)
    cells = [
        F.max(F.when(F.col("model") == name, F.col(field))).alias(name) for name in fits
    ]
    return long.groupBy("term").agg(*cells)


def fit_table(
    spark: SparkSession, fits: Mapping[str, OlsFit], titles: Mapping[str, str] | None = None
) -> DataFrame:
    """R², adjusted R² and number of observations per model."""
    rows = [
        ((titles or {}).get(name, name), fit.r_squared, fit.adjusted_r_squared, fit.n)
        for name, fit in fits.items()
    ]
    return _table(
        spark, rows, "model string, r_squared double, adj_r_squared double, observations bigint"
    )


def model_table(
    spark: SparkSession,
    fits: Mapping[str, OlsFit],
    rows: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Formatted coefficients, ``-`` where a model lacks the term, and R² in the last row.

    ``rows`` gives (label, term, printf format).
    """
    lines = []
    for position, (label, term, form) in enumerate(rows):
        cells = [
            form % fit.coefficients[fit.terms.index(term)] if term in fit.terms else "-"
            for fit in fits.values()
        ]
        lines.append((position, label, *cells))
    lines.append((len(rows), "R²", *["-" if fit.r_squared is None else "%.3f" % fit.r_squared for fit in fits.values()]))
    cells = ", ".join(f"`{name}` string" for name in fits)
    return _table(spark, lines, f"position int, variable string, {cells}")


def vif_table(spark: SparkSession, fit: OlsFit) -> DataFrame:
    """Variance inflation per term. The constant's value is against the uncentred total."""
    rows = [(term, float(value)) for term, value in zip(fit.terms, fit.vif, strict=True)]
    return _table(spark, rows, "variable string, vif double")


def diagnostics(df: DataFrame, fits: Mapping[str, OlsFit]) -> DataFrame:
    """One row per model: overall fit, information criteria and normality of the residuals.

    The residual moments of all models come from one further pass.
    """
    shapes = []
    for i, fit in enumerate(fits.values()):
        complete = _complete([fit.target, *fit.predictors])
        residual = F.when(complete, fit.residual())
        shapes += [F.skewness(residual).alias(f"s{i}"), F.kurtosis(residual).alias(f"k{i}")]
    shape = df.agg(*shapes).first()
    rows = []
    for i, fit in enumerate(fits.values()):
        skewness, excess = shape[f"s{i}"], shape[f"k{i}"]
        known = skewness is not None and excess is not None and not math.isnan(skewness + excess)
        skewness, kurtosis = (skewness, excess + 3) if known else (None, None)  # residuals without variance
        jarque_bera = fit.n / 6 * (skewness**2 + excess**2 / 4) if known else None
        together = omnibus(fit.n, skewness, kurtosis) if known else None
        rows.append(
            (
                fit.name,
                fit.n,
                fit.df_model,
                fit.df_residual,
                fit.r_squared,
                fit.adjusted_r_squared,
                fit.f_statistic,
                fit.f_p_value,
                fit.log_likelihood,
                fit.aic,
                fit.bic,
                skewness,
                kurtosis,
                jarque_bera,
                None if jarque_bera is None else chi2_upper(jarque_bera, 2),
                together,
                None if together is None else chi2_upper(together, 2),
                fit.condition_number,
            )
        )
    return _table(
        df.sparkSession,
        rows,
        "model string, observations bigint, df_model int, df_residual bigint, r_squared double, "
        "adj_r_squared double, f_statistic double, f_p_value double, log_likelihood double, "
        "aic double, bic double, skewness double, kurtosis double, jarque_bera double, "
        "jarque_bera_p double, omnibus double, omnibus_p double, condition_number double",
    )


def gram_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sums of products of column pairs over complete rows, as (row, column, value)."""
    complete = df.where(_complete(names))
    pairs = list(combinations_with_replacement(names, 2))
    sums = complete.agg(
        *[
            F.sum(column(a).cast("double") * column(b).cast("double")).alias(f"g{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    lines = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("column"), F.col(f"g{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)
    ]
    return sums.select(F.inline(F.array(*lines)))
