"""The registered queries that SQL can express, against DuckDB on the smallest tables."""

import oracle_check
import pytest

from arealis.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    found = oracle_check.duck(FOLDER)
    for table in ("documents", "labels", "pages"):
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, monkeypatch, name):
    monkeypatch.setattr(oracle_check, "ORACLES", ORACLES)
    outcome = oracle_check.compare(con, name, QUERIES[name](spark, FOLDER))
    assert outcome.startswith("ok") and "types?" not in outcome, outcome
