"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word definition `[^\x20\x09-\x0D]+`: fixed value.
SPACES = " \t\n\x0b\x0c\r"

# A key with more than one in HOT_SHARE of all rows is salted; there are at most HOT_SHARE such keys.
HOT_SHARE = 1000
SALTS = 64


_caches: dict[str, Callable[[], None]] = {}


def clear_caches(but: str = "") -> None:
    """Empty all caches of this process but that of a name.

    Python workers go on from one stage to the next, and what each stage keeps would add up.
    """
    for name in [name for name in _caches if name != but]:
        _caches.pop(name)()


def keep_cache(name: str, clear: Callable[[], None]) -> None:
    """From now on this process keeps the cache of ``name`` only, which ``clear`` empties."""
    clear_caches(but=name)
    _caches[name] = clear


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a text without words."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves ``part`` modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def skew_join(
    rows: DataFrame,
    groups: DataFrame,
    on: Sequence[str],
    size: str,
    total: int,
    spread: Column,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows to one row per key, where a few keys may hold most of the rows.

    ``groups`` has one row per key (null keys never match) and the key's number of rows in ``size``; ``total`` is
    the number of rows. Keys above ``total / HOT_SHARE`` rows, at most HOT_SHARE of them by arithmetic,
    are broadcast as a list; their rows spread over ``salts`` values by ``spread`` and their group row is repeated
    for each. All other keys keep salt 0.
    """
    is_hot = F.col(size) * HOT_SHARE > F.lit(total)
    hot = groups.filter(is_hot).select(*on, F.lit(True).alias("_hot"))
    salted = groups.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    marked = rows.join(F.broadcast(hot), list(on), "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    )
    return marked.join(salted, [*on, "_salt"], how).drop("_salt", "_hot")
