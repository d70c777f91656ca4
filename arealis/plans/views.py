"""SQL surface: the analysis tables as temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arealis.operators.correlation import correlate
from arealis.presets.analysis import TARGET_RATE, URBAN_VARIABLES

# Fixed value: top districts by flagged events. Events are counted per unit before the districts' names join.
TOP_DISTRICTS_SQL = """
    WITH counted AS (
        SELECT SJ_CD_SETOR, count(*) AS n
        FROM {crimes}
        WHERE SJ_CD_SETOR IS NOT NULL AND (is_roubo OR is_furto)
        GROUP BY SJ_CD_SETOR
    )
    SELECT d.nm_dist AS SJ_NM_DIST, sum(c.n) AS total_crimes
    FROM counted c LEFT JOIN {censo} d ON c.SJ_CD_SETOR = d.cd_setor
    GROUP BY 1
    ORDER BY 2 DESC, 1
    LIMIT 10
"""

RATES_SQL = """
    WITH counted AS (
        SELECT SJ_CD_SETOR AS cd_setor, count(*) AS total_crimes
        FROM {crimes}
        WHERE SJ_CD_SETOR IS NOT NULL AND is_furto
        GROUP BY SJ_CD_SETOR
    )
    SELECT d.*, c.total_crimes,
           CASE WHEN d.qt_pessoas > 0 THEN c.total_crimes / d.qt_pessoas * 1000 END
               AS tx_crimes_1000_hab
    FROM counted c INNER JOIN {censo} d ON c.cd_setor = d.cd_setor
"""

EVENTS_PER_YEAR_SQL = "SELECT ano, count(*) AS qt FROM {crimes} GROUP BY 1 ORDER BY 1 DESC"


def register_views(**tables: DataFrame) -> None:
    """Register each table under its name, for a user's own ``spark.sql``; the session has one such name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def top_districts(crimes: DataFrame, censo: DataFrame) -> DataFrame:
    """The ten districts with most flagged events; events of unknown units are a district without a name."""
    return crimes.sparkSession.sql(TOP_DISTRICTS_SQL, crimes=crimes, censo=censo)


def rates_of_thefts(crimes: DataFrame, censo: DataFrame) -> DataFrame:
    """Thefts per 1000 inhabitants and the unit's own columns."""
    return crimes.sparkSession.sql(RATES_SQL, crimes=crimes, censo=censo)


def events_per_year(crimes: DataFrame) -> DataFrame:
    return crimes.sparkSession.sql(EVENTS_PER_YEAR_SQL, crimes=crimes)


def view_correlations(spark: SparkSession, view: str, where: str | None = None) -> DataFrame:
    """``filtered_correlations`` of a registered view."""
    return filtered_correlations(spark.table(view), where)


def filtered_correlations(table: DataFrame, where: str | None = None) -> DataFrame:
    """Correlations of the urban variables with the rate, under an SQL predicate.

    The predicate is one expression over the table's columns; it cannot reach other tables' names.
    """
    return correlate(table, TARGET_RATE, URBAN_VARIABLES, where, ascending=True)
