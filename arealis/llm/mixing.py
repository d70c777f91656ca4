"""Mixing sources to target weights by weighted fair queueing.

Every source queues its shuffled documents, once more for each allowed repeat. A copy's virtual finish time is
the source's words up to its end divided by the source's target. All copies, sorted globally by finish time, are
taken until the total budget is spent, so every source is served in proportion to its target at every moment.

Running sums are taken in two levels: within slices, and over the sums of the slices. There are as many slices as
rows in one, the square root of all rows, so no task holds a source, whatever its share.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import skew_join, word_count
from arealis.sources.scratch import materialize

# Weights of the sources in code point order, repeated from the start: fixed values.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEATS = 2


def source_targets(
    sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS
) -> list[float]:
    """Words that each source shall give. Shares go by weight; what a source cannot give goes to the others."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    targets, left, open_ = [0.0] * len(sizes), budget * sum(sizes), set(range(len(sizes)))
    while open_:
        share = left / sum(weight[i] for i in open_)
        full = {i for i in open_ if share * weight[i] > repeats * sizes[i]}
        for i in full or open_:
            targets[i] = float(repeats * sizes[i]) if full else share * weight[i]
        left -= sum(targets[i] for i in full)
        open_ = open_ - full if full else set()
    return targets


def _running(df: DataFrame, groups: Sequence[str], slice_: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Running sum of ``value`` in each group in the order (slice_, *order), the row itself included."""
    sums = df.groupBy(*groups, slice_).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*groups, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_inside", F.sum(value).over(inside))
        .join(starts, [*groups, slice_])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )


def mix_plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Which copies of which rows the mix takes.

    Returns two tables. ``rows`` has one row for every row of ``docs``: ``row`` (a number), ``key``, ``size`` (words),
    ``source_size``, ``target`` of its source. ``taken`` has one row for every copy taken: ``row, key,
    repeat, finish``. Null sources are one source, the last in order; null texts have size 0. Documents are taken
    whole, so a source misses its target by less than two documents. Rows that repeat everything are documents of
    their own. The order depends on the seed, key and size only, and on the place in the table for rows that share
    both, so reruns agree. An empty table gives two empty
    tables. Sources are few (the weights name them); their totals are the only thing that the driver sees.
    Other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *_narrow(F.col(key), F.col(text), F.col(source)))
    return _plan(materialize(rows), weights, budget, repeats, seed)


def _narrow(key: Column, text: Column, source: Column) -> list[Column]:
    named = F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))
    return [key.alias("key"), named.alias("src"), word_count(text).alias("size")]


def _plan(rows: DataFrame, weights: Sequence[float], budget: float, repeats: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The plan for stored rows ``row, key, src, size``."""
    found = rows.groupBy("src").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    totals = sorted(found, key=lambda r: (r.src == "", r.src.encode("utf-8")))
    targets = source_targets([r["size"] for r in totals], weights, budget, repeats)
    table = rows.sparkSession.createDataFrame(
        [(r.src, r["size"], t) for r, t in zip(totals, targets, strict=True)], "src string, source_size long, target double"
    )
    rows = rows.join(F.broadcast(table), "src")  # one row for each source
    n = sum(r.n for r in found)
    slices = max(1, math.isqrt(repeats * n))
    copies = (
        _spread_repeats(rows, n)
        .withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("_hash", F.xxhash64(F.lit(seed), "repeat", "key", "size", "_again"))
        .withColumn("_slice", F.pmod("_hash", F.lit(slices)))
    )
    order = ["_hash", "key", "row"]
    queued = _running(copies, ["src", "repeat"], "_slice", order, "size", "_words")
    finish = (F.col("repeat") * F.col("source_size") + F.col("_words")) / F.col("target")
    # A source without words takes no part in the contest; its rows lie anywhere in the first unit of time.
    anywhere = F.pmod("_hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    queued = queued.withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(anywhere))
    # Queues run evenly, so equal slices of virtual time hold equal numbers of words.
    timed = queued.withColumn("_slice", F.floor(F.col("finish") * slices)).withColumn("_all", F.lit(0))
    spent = _running(timed, ["_all"], "_slice", ["finish", "src", "repeat", *order], "size", "_spent")
    limit = budget * sum(r["size"] for r in found)
    taken = spent.filter(F.col("_spent") <= limit).select("row", "key", "repeat", "finish")
    return rows.select("row", "key", "size", "source_size", "target"), taken


def _spread_repeats(rows: DataFrame, total: int) -> DataFrame:
    """Add ``_again``: null, or the row's number where others have the same key and size.

    Keys that are missing, or rows that repeat, would else be one hash and one slice, whatever their share. (A null does
    not change a hash.)
    """
    alike = rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    alike = materialize(alike.select(F.col("key").isNull().alias("_none"), F.hash("key").alias("_code"), "size", "_n"))
    if alike.isEmpty():
        return rows.withColumn("_again", F.lit(None).cast("long"))
    # By code, as null keys match nothing; keys that share a code are spread as well.
    alike = alike.groupBy("_none", "_code", "size").agg(F.sum("_n").alias("_n"))
    coded = rows.withColumns({"_none": F.col("key").isNull(), "_code": F.hash("key")})
    found = skew_join(coded, alike, ["_none", "_code", "size"], "_n", total, F.col("row"))
    return found.withColumn("_again", F.when(F.col("_n").isNotNull(), F.col("row"))).drop("_none", "_code", "_n")


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: key, ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted)."""
    rows, taken = mix_plan(docs, **settings)
    times = taken.groupBy("row").agg(F.count(F.lit(1)).alias("times"))
    return rows.join(times, "row", "left").select(
        F.col("key").alias(settings.get("key", "doc_id")),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    seed: int = 7,
) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, range-sorted by finish time.

    Nulls, empty and long texts, repeated rows and empty tables are as in ``mix_plan``; all columns of any name and type
    come along.
    """
    numbered = materialize(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")))
    parts = [F.col("doc")[name] for name in (key, text, source)]
    _, taken = _plan(materialize(numbered.select("row", *_narrow(*parts))), weights, budget, repeats, seed)
    return numbered.join(taken.drop("key"), "row").orderBy("finish", "row", "repeat").select("doc.*")
