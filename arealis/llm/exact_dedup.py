"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies are combined three times: within each map task, within salted digest groups, and over the winners of all
salts. Every stage groups by the digest and by the whole text, so equal digests of different texts never merge.
A text held by a third of all rows is one row per task after the first stage and one row per salt after the
second; no list of members is ever built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import skew_join
from arealis.sources.scratch import materialize

SALTS = 16


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def combine(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256_hex
) -> DataFrame:
    """One row per distinct text: ``digest, text, keep_id, group_size``. A null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_id"), whole.alias("_text"), digest(whole).alias("_digest"))
    # The salt is that of the map task, so the copies of one task combine before they leave it.
    salted = rows.groupBy("_digest", "_text", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")).agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n")
    )
    return salted.groupBy("_digest", "_text").agg(F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size")).select(
        F.col("_digest").alias("digest"), F.col("_text").alias("text"), "keep_id", "group_size"
    )


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256_hex
) -> DataFrame:
    """Report for every row of ``docs`` the copy that stays.

    Returns ``key, keep_id, group_size, kept, text_sha256``. Texts are equal when identical; null equals empty.
    The largest key of a group stays; a null key stays only if no copy has a key. Rows that repeat key and text
    are one document and share its verdict, each counted in ``group_size``. Other columns are ignored, an empty
    table gives an empty report, and texts of any length are compared whole.
    """
    groups = materialize(
        combine(docs, key, text, digest).select("digest", "keep_id", "group_size")
    )
    copies = groups.filter(F.col("group_size") > 1)
    total, texts, digests = groups.agg(
        F.coalesce(F.sum("group_size"), F.lit(0)), F.count(F.lit(1)), F.count_distinct("digest")
    ).first()
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_id"), whole.alias("_text"), digest(whole).alias("digest"))
    on = ["digest"]
    if texts != digests:  # different texts share a digest: the whole text joins too
        on = ["digest", "_text"]
        copies = combine(docs, key, text, digest).filter(F.col("group_size") > 1).withColumnRenamed("text", "_text")
    rows = rows.withColumn("text_sha256", F.sha2("_text", 256)).select("_id", "text_sha256", *on)
    found = skew_join(rows, copies, on, "group_size", total, F.col("_id"))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_id").alias(key),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one row per distinct text, with all their columns.

    The text comes from the combined winners, so it is not shuffled again for the join: the other columns, which
    are narrow, join on key and digest. Of rows that repeat key and text, the first stays. Null and empty texts are
    copies of each other; a null key stays only if no copy has a key. Other columns may have any name and type; texts
    of any length are compared whole; an empty table stays empty.
    """
    others = [name for name in docs.columns if name not in (key, text)]
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("_id"),
        sha256_hex(whole).alias("_digest"),
        F.col(text).isNull().alias("_null"),
        F.struct(*(others or [F.lit(0)])).alias("_rest"),
        F.monotonically_increasing_id().alias("_place"),
    )
    first = F.min_by(F.struct("_null", "_rest"), "_place").alias("_first")  # maps have no order of their own
    narrow = narrow.groupBy("_id", "_digest").agg(first).select("_id", "_digest", "_first.*")
    winners = combine(docs, key, text).select(
        F.col("keep_id").alias("_keep"), F.col("digest").alias("_found"), F.col("text").alias("_text")
    )
    joined = winners.join(narrow, F.col("_keep").eqNullSafe(F.col("_id")) & (F.col("_found") == F.col("_digest")))
    columns = {key: F.col("_keep"), text: F.when(~F.col("_null"), F.col("_text"))}
    return joined.select(*[columns.get(name, F.col("_rest")[name]).alias(name) for name in docs.columns])
