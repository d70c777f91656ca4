"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from oracle_check import compare, duck

from pyspark.sql import DataFrameWriter
from pyspark.sql.classic.dataframe import DataFrame

from catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


# Operators that would gather data in one place, pair everything with everything or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "Window")


# These read headers, one line a split in Python, before they read the files.
READ_HEADERS = {"quarter_files", "quarter_files_all", "incremental_quarters", "batch_curated"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all results that are fetched and all tables that are written, as they are."""
    seen = []

    def noted(owner, name, frame):
        run = getattr(owner, name)

        def wrapper(self, *args, **kwargs):
            seen.append(plan_of(frame(self)))
            return run(self, *args, **kwargs)

        monkeypatch.setattr(owner, name, wrapper)

    for name in ("collect", "count", "toPandas", "isEmpty"):
        noted(DataFrame, name, lambda df: df)
    for name in ("save", "parquet", "csv", "json", "text"):
        noted(DataFrameWriter, name, lambda writer: writer._df)
    return seen


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, plans, name):
    """Neither the query itself nor any job that runs while it is built has an unwanted operator."""
    df = QUERIES[name](spark, FOLDER)
    allowed = {"MapInArrow"} if name in READ_HEADERS else set()
    for plan in [*plans, plan_of(df)]:
        assert [operator for operator in UNWANTED if operator in plan and operator not in allowed] == []
    outcome = compare(con, name, df)
    assert outcome.startswith("ok" if name in ORACLES else "rows only"), outcome


def test_flagship_counts_before_it_shuffles_and_joins(spark):
    plan = plan_of(QUERIES["rates_by_unit_period"](spark, FOLDER))
    events = plan[: plan.index("o_custkey")]
    assert events.count("HashAggregate") >= 1
    assert "LeftOuter" not in plan  # the null-rejecting filter makes the join inner
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_custkey" in line)
    assert "o_totalprice" not in scan
    assert "PushedFilters: [" in scan
    assert "1-URGENT" in scan.split("PushedFilters")[1]


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_units_by_rate"](spark, FOLDER))


def test_deduplication_shuffles_before_deriving(spark):
    plan = plan_of(QUERIES["clean_occurrences"](spark, FOLDER))
    (exchange,) = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "categoria_rubrica" not in exchange
