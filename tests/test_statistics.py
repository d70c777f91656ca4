import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.operators import correlation, distribution, quantiles, regression
from arealis.operators.significance import chi2_upper, f_upper, t_critical, t_two_sided

LEVELS = (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def hot(n):
    """A third of all rows hold one value; the rest are spread."""
    rng = random.Random(1)
    return [7.0 if i % 3 == 0 else round(rng.expovariate(0.05), 3) for i in range(n)]


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [2.0, 1.0],
        [5.0] * 500,
        [float(i) for i in range(1000)],
        [-1.5] * 400 + [0.0] * 400 + [float(i) for i in range(400)],
        hot(3000),
    ],
    ids=["one", "two", "constant", "distinct", "two-hot", "hot"],
)
def test_quantiles_match_numpy(spark, values, monkeypatch):
    df = frame(spark, [*values, None, math.nan, math.inf, -math.inf])
    expected = list(np.quantile(values, LEVELS))
    assert quantiles.exact_quantiles(df, "v", LEVELS) == pytest.approx(expected, abs=1e-9)
    monkeypatch.setattr(quantiles, "CAPACITY", 50)  # several rounds of brackets
    assert quantiles.exact_quantiles(df, "v", LEVELS) == pytest.approx(expected, abs=1e-9)


def test_quantiles_of_several_columns_share_the_passes(spark):
    df = spark.range(1000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "cast(null as double) c")
    got = quantiles.quantiles_of_columns(df, {"a": [0.5, 0.99], "b": [0.25], "c": [0.5]})
    a, b = np.arange(1000.0), np.arange(1000.0) % 7
    assert got == {"a": pytest.approx(list(np.quantile(a, [0.5, 0.99]))), "b": [np.quantile(b, 0.25)], "c": [None]}


def test_quantiles_of_nothing(spark):
    assert quantiles.exact_quantiles(frame(spark, [None]), "v", [0.5]) == [None]


def test_brackets_recover_from_a_bad_sketch(spark, monkeypatch):
    """Bounds on the wrong side of a rank are noticed and drawn again, wider."""
    honest, margins = quantiles.RankSearch._bounds, []

    def wrong_at_first(search, parts, margin):
        margins.append(margin)
        bounds = honest(search, parts, margin)
        return [(i, low + 1e6, high + 1e6, ranks) for i, low, high, ranks in bounds] if len(margins) == 1 else bounds

    monkeypatch.setattr(quantiles, "CAPACITY", 50)
    monkeypatch.setattr(quantiles.RankSearch, "_bounds", wrong_at_first)
    values = hot(2000)
    got = quantiles.exact_quantiles(frame(spark, values), "v", LEVELS)
    assert got == pytest.approx(list(np.quantile(values, LEVELS)), abs=1e-9)
    assert margins[:2] == [2.0, 4.0]


def counted(spark, df):
    """The frame, and a function that tells how often it was read whole."""
    read, n = spark.sparkContext.accumulator(0), df.count()

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), lambda: read.value / n


def test_scans(spark, monkeypatch):
    """One scan settles small columns, two those whose brackets are small; a cut at a quantile needs no other search."""
    values = hot(4000)
    small = spark.createDataFrame([(v, v * v) for v in values], "v double, w double")
    levels = [0.25, 0.5, 0.99]
    df, scans = counted(spark, small)
    got = quantiles.quantiles_of_columns(df, {"v": levels, "w": levels})
    assert got["w"] == pytest.approx(list(np.quantile(np.square(values), levels))) and scans() == 1
    df, scans = counted(spark, small)
    assert distribution.summary_stats(df, ["v", "w"]).count() == 2 and scans() == 1
    monkeypatch.setattr(quantiles, "CAPACITY", 1500)
    df, scans = counted(spark, small)
    assert quantiles.exact_quantiles(df, "v", levels) == pytest.approx(list(np.quantile(values, levels))) and scans() == 2
    df, scans = counted(spark, small)
    distribution.box_stats(df, "v", up_to=0.99).collect()
    assert scans() == 3  # the whiskers are looked for where the quartiles are known
    df, scans = counted(spark, small)
    distribution.histogram(df, "v", up_to=0.99).collect()
    assert scans() == 3
    monkeypatch.undo()
    df, scans = counted(spark, small)
    distribution.histogram(df, "v").collect()
    assert scans() == 2


@pytest.mark.parametrize(
    "values",
    [hot(3000), [1.0] * 10, [float(i) for i in range(101)], [1.0] * 50 + [2.0] * 300, [4.0], [3.0, 9.0], [0.0] * 98 + [5.0, 5.0]],
    ids=["hot", "constant", "distinct", "tied", "one", "two", "tied-at-the-end"],
)
def test_cut_at_a_quantile(spark, monkeypatch, values):
    """Quartiles and bins of the values up to P99, also where many equal it."""
    monkeypatch.setattr(quantiles, "CAPACITY", 50)
    df = frame(spark, [*values, None, math.nan])
    limit = np.quantile(values, 0.99)
    kept = [v for v in values if v <= limit]
    search = quantiles.RankSearch(df, ["v"])
    got_limit, size, quartiles = search.up_to_quantile("v", 0.99, distribution.QUARTILES)
    assert (got_limit, size) == (pytest.approx(limit), len(kept))
    assert quartiles == pytest.approx(list(np.quantile(kept, distribution.QUARTILES)))
    row = distribution.box_stats(df, "v", up_to=0.99).first()
    assert (row["count"], row.q1, row.q3) == (len(kept), pytest.approx(np.quantile(kept, 0.25)), pytest.approx(np.quantile(kept, 0.75)))
    counts, edges = np.histogram(kept, bins=50)
    bins = distribution.histogram(df, "v", up_to=0.99).orderBy("bin").collect()
    assert [r["count"] for r in bins] == list(counts)
    assert [r.lower for r in bins] + [bins[-1].upper] == pytest.approx(list(edges))


def test_cut_of_nothing(spark):
    df = frame(spark, [None])
    assert distribution.box_stats(df, "v", up_to=0.99).first()["count"] == 0
    bins = distribution.histogram(df, "v", up_to=0.99).collect()
    assert len(bins) == 50 and {(r.lower, r["count"]) for r in bins} == {(None, 0)}
    assert distribution.summary_stats(df, ["v"]).first()["count"] == 0


def test_approximate_quantiles_are_near(spark):
    values = [float(i) for i in range(1001)]
    got = {r.probability: r.value for r in quantiles.approximate_quantiles(frame(spark, values), "v", (0.25, 0.9)).collect()}
    assert got[0.25] == pytest.approx(250, abs=2)
    assert got[0.9] == pytest.approx(900, abs=2)


def test_summary(either_mode):
    values = hot(900)
    row = distribution.summary_stats(frame(either_mode, [*values, None]), ["v"]).first()
    assert row.variable == "v"
    assert row["count"] == 900
    assert (row.min, row.max) == (min(values), max(values))
    assert row.mean == pytest.approx(np.mean(values))
    assert row.stddev == pytest.approx(np.std(values, ddof=1))
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_summary_of_one_value(either_mode):
    row = distribution.summary_stats(frame(either_mode, [4.0]), ["v"]).first()
    assert (row["count"], row.mean, row.stddev, row.p50) == (1, 4.0, None, 4.0)


@pytest.mark.parametrize("values", [hot(500), [0.1 * i for i in range(101)], [1.0, 2.0], [3.0] * 9])
def test_histogram_matches_numpy(either_mode, values):
    got = distribution.histogram(frame(either_mode, [*values, None]), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["count"] for r in got] == list(counts)
    assert [r.lower for r in got] + [got[-1].upper] == pytest.approx(list(edges))


def test_histogram_counts_what_is_not_finite_beside_its_bins(spark):
    values = [float(i) for i in range(997)] + [math.inf, -math.inf, math.nan]
    got = distribution.histogram(frame(spark, [*values, None]), "v").collect()
    assert sum(r["count"] for r in got) + got[0].not_finite == 1000
    assert {r.not_finite for r in got} == {3}
    assert min(r.lower for r in got) == 0.0 and max(r.upper for r in got) == 996.0


def t_by_integration(t, df):
    """The two tails of Student's t from its density, by Simpson's rule over the middle."""
    x = np.linspace(0, t, 20_001)
    log_scale = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) if df < 1e6 else 0.5 * math.log(df / 2) - 1 / (4 * df)
    density = np.exp(log_scale - 0.5 * math.log(df * math.pi) - (df + 1) / 2 * np.log1p(x * x / df))
    weights = np.ones(20_001)
    weights[1:-1:2], weights[2:-1:2] = 4, 2
    return 1 - 2 * float(weights @ density) * (x[1] - x[0]) / 3


@pytest.mark.parametrize("df", [10, 1e4, 1e8, 1e12])
def test_tails_at_any_degrees_of_freedom(df):
    for t in (0.01, 1.0, 1.96, 4.0):
        assert t_two_sided(t, df) == pytest.approx(t_by_integration(t, df), rel=1e-6)
        assert f_upper(t * t, 1, df) == pytest.approx(t_two_sided(t, df), rel=1e-9)


def test_degenerate_fits_give_null(spark):
    rows = [(float(i), 2.0 * i + 1, 5.0, float(i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, line double, flat double, other double")
    for target in ("line", "flat"):
        fits = regression.fit_models(df, target, {"m": ("x", "other")})
        fit = regression.fit_table(spark, fits).first()
        assert target == "line" or (fit.r_squared, fit.adj_r_squared) == (None, None)
        assert regression.coefficient_table(spark, fits).count() == 3
        shape = regression.diagnostics(df, fits).first()
        assert target == "line" or (shape.f_statistic, shape.aic, shape.omnibus) == (None, None, None)
        assert regression.model_table(spark, fits, [("x", "x", "%.2f")]).count() == 2


def test_histogram_up_to_a_threshold(spark):
    got = distribution.histogram(frame(spark, [0.0, 1.0, 2.0, 99.0]), "v", bins=2, at_most=2.0).orderBy("bin").collect()
    assert [(r.lower, r.upper, r["count"]) for r in got] == [(0.0, 1.0, 1), (1.0, 2.0, 2)]


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 50.0, -40.0]
    row = distribution.box_stats(frame(spark, values), "v").first()
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (row.q1, row.median, row.q3) == (q1, median, q3)
    assert (row.whisker_low, row.whisker_high) == (1.0, 5.0)
    assert (row.outliers_low, row.outliers_high, row["count"]) == (1, 1, 7)


def test_correlation_skips_null_pairs_and_constants(either_mode):
    data = [(1.0, 2.0, 5.0, None), (2.0, 3.9, 5.0, 1.0), (3.0, None, 5.0, None), (4.0, 8.2, 5.0, None)]
    df = either_mode.createDataFrame(data, "y double, a double, flat double, single double")
    got = {r.variable: r.correlation for r in correlation.correlate(df, "y", ["a", "flat", "single"]).collect()}
    assert set(got) == {"a"}
    assert got["a"] == pytest.approx(np.corrcoef([1, 2, 4], [2.0, 3.9, 8.2])[0, 1])


def test_correlation_filter_order_and_names(spark):
    data = [(float(i), float(i), float(-i), i % 5) for i in range(20)]
    df = spark.createDataFrame(data, "y double, up double, down double, k int")
    got = correlation.correlate(df, "y", ["down", "up"], "k <> 0").collect()
    assert [r.variable for r in got] == ["up", "down"]
    with pytest.raises(ValueError, match="no such columns"):
        correlation.correlate(df, "y", ["absent"])


def test_tail_probabilities_against_textbook_values():
    assert t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(12.70620474, 1) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(0.0, 7) == pytest.approx(1.0)
    assert t_two_sided(-3.169272673, 10) == pytest.approx(0.01, abs=1e-9)
    assert t_two_sided(1.959963985, 10**9) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(1.96, 10**6) == pytest.approx(t_two_sided(1.96, 10**8), abs=1e-6)
    assert f_upper(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert f_upper(3.478049691, 4, 10) == pytest.approx(0.05, abs=1e-8)
    assert f_upper(2.5, 4, 10**9) == pytest.approx(chi2_upper(10.0, 4), abs=1e-9)
    assert chi2_upper(5.991464547, 2) == pytest.approx(0.05, abs=1e-9)
    assert chi2_upper(7.814727903, 3) == pytest.approx(0.05, abs=1e-9)
    assert t_critical(0.05, 10) == pytest.approx(2.228138852, abs=1e-8)
    assert t_two_sided(40.0, 500) < 1e-100


def regression_data(n=400):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=n), rng.normal(size=n) * 1e4 + 5e4
    x3 = 0.5 * x1 + rng.normal(size=n)
    y = 1.5 + 0.7 * x1 - 2e-5 * x2 + 0.1 * x3 + rng.normal(size=n)
    return y, x1, x2, x3


def by_least_squares(y, *xs):
    design = np.column_stack([np.ones(len(y)), *xs])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    residual = y - design @ beta
    variance = residual @ residual / (len(y) - design.shape[1])
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * variance)
    return beta, errors, residual, design


@pytest.fixture(scope="module")
def model_frame(spark):
    y, x1, x2, x3 = regression_data()
    rows = [tuple(map(float, row)) for row in zip(y, x1, x2, x3, strict=True)]
    rows += [(1.0, None, 2.0, 3.0), (None, 1.0, 2.0, 3.0)]
    return spark.createDataFrame(rows, "y double, x1 double, x2 double, x3 double")


MODELS = {"one": ("x1",), "two": ("x1", "x2"), "three": ("x1", "x2", "x3")}


@pytest.fixture(scope="module")
def fits(model_frame):
    return regression.fit_models(model_frame, "y", MODELS)


def test_each_model_uses_its_own_complete_rows(fits):
    assert [fit.n for fit in fits.values()] == [400, 400, 400]


def test_models_match_least_squares(fits):
    y, *xs = regression_data()
    for k, fit in enumerate(fits.values(), 1):
        beta, errors, residual, design = by_least_squares(y, *xs[:k])
        assert fit.coefficients == pytest.approx(beta, rel=1e-8)
        assert fit.std_errors == pytest.approx(errors, rel=1e-8)
        assert fit.residual_ss == pytest.approx(residual @ residual, rel=1e-9)
        assert fit.condition_number == pytest.approx(np.linalg.cond(design), rel=1e-5)
        n, p = design.shape
        assert fit.bic - fit.aic == pytest.approx(p * (math.log(n) - 2))


def test_nested_models_explain_more(fits):
    r2 = [fit.r_squared for fit in fits.values()]
    assert r2 == sorted(r2)
    assert all(fit.adjusted_r_squared < fit.r_squared for fit in fits.values())


def test_residuals_are_orthogonal(model_frame, fits):
    residual = fits["three"].residual()
    row = model_frame.na.drop().agg(F.avg(residual), F.corr(residual, "x1"), F.corr(residual, "x2")).first()
    assert list(row) == pytest.approx([0, 0, 0], abs=1e-8)


def test_vif_matches_auxiliary_regressions(spark, fits):
    _, *xs = regression_data()
    got = {r.variable: r.vif for r in regression.vif_table(spark, fits["three"]).collect()}
    for i, name in enumerate(("x1", "x2", "x3")):
        others = [x for j, x in enumerate(xs) if j != i]
        *_, residual, _ = by_least_squares(xs[i], *others)
        total = ((xs[i] - xs[i].mean()) ** 2).sum()
        assert got[name] == pytest.approx(total / (residual @ residual), rel=1e-8)
    ones = np.ones(len(xs[0]))
    fitted, *_ = np.linalg.lstsq(np.column_stack(xs), ones, rcond=None)
    left = ones - np.column_stack(xs) @ fitted
    assert got["const"] == pytest.approx(len(ones) / (left @ left), rel=1e-6)


def test_model_tables(spark, model_frame, fits):
    wide = {r.term: (r.one, r.two, r.three) for r in regression.compare_models(spark, fits, "coef").collect()}
    assert wide["x3"][:2] == (None, None)
    assert wide["x1"][2] == pytest.approx(fits["three"].coefficients[1])
    p_values = {r.term: r.three for r in regression.compare_models(spark, fits, "p_value").collect()}
    assert p_values["x1"] < 1e-10
    final = regression.model_table(spark, fits, (("X1", "x1", "%.3f"), ("X2", "x2", "%.2e"))).orderBy("position").collect()
    assert final[0].one == f"{fits['one'].coefficients[1]:.3f}"
    assert final[1].one == "-"
    assert final[1].two == f"{fits['two'].coefficients[2]:.2e}"
    assert final[2].three == f"{fits['three'].r_squared:.3f}"
    fit = regression.fit_table(spark, fits, {"one": "First"}).collect()
    assert {r.model for r in fit} == {"First", "two", "three"}
    intervals = regression.coefficient_table(spark, fits).where("ci_low > coef OR ci_high < coef")
    assert intervals.count() == 0


def test_diagnostics(model_frame, fits):
    y, *xs = regression_data()
    row = {r.model: r for r in regression.diagnostics(model_frame, fits).collect()}["three"]
    *_, residual, _ = by_least_squares(y, *xs)
    spread = (residual**2).mean()
    skewness = (residual**3).mean() / spread**1.5
    kurtosis = (residual**4).mean() / spread**2
    assert row.skewness == pytest.approx(skewness, abs=1e-8)
    assert row.kurtosis == pytest.approx(kurtosis, rel=1e-8)
    jarque_bera = 400 / 6 * (skewness**2 + (kurtosis - 3) ** 2 / 4)
    assert row.jarque_bera == pytest.approx(jarque_bera, rel=1e-6)
    assert row.jarque_bera_p == pytest.approx(math.exp(-jarque_bera / 2), rel=1e-6)
    assert row.log_likelihood == pytest.approx(-200 * (math.log(2 * math.pi * spread) + 1))


def test_degenerate_models_are_refused(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(i * 2), float(i)) for i in range(9)], "y double, flat double, a double, b double")
    with pytest.raises(ValueError, match="constant"):
        regression.fit_models(df, "y", {"m": ("flat",)})
    with pytest.raises(ValueError, match="dependent"):
        regression.fit_models(df, "y", {"m": ("a", "b")})
    with pytest.raises(ValueError, match="complete rows"):
        regression.fit_models(df.limit(1), "y", {"m": ("a",)})


def test_gram_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (None, 9.0)], "a double, b double")
    got = {(r.row, r.column): r.value for r in regression.gram_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 10.0, ("a", "b"): 14.0, ("b", "b"): 20.0}
