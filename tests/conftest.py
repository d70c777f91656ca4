import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from arealis.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def either_mode(request, spark):
    """Run the test with ANSI mode on and off."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def apply(spark):
    """Evaluate a column function over texts, keeping their order."""
    from pyspark.sql import functions as F

    def run(function, values, type_="string"):
        rows = [(i, value) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {type_}")
        return [row.y for row in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
