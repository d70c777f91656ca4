"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters every record into one of many memory-sized buckets by a seeded hash. Pass two brings each
bucket together in one task, shuffles it in memory with Spark's ``shuffle`` (Fisher-Yates) and writes it. The
buckets in order form one permutation of all records; the shards are equal cuts of it.

Neighbouring buckets share a partition, of which there are a bounded number, and a task goes through its buckets one
after the other. Where each bucket begins follows from counts summed in two levels, within partitions and
over them, and travels to the bucket with its records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import skew_join
from arealis.sources.scratch import materialize, shared_folder

BUCKET_BYTES = 8 << 20
# Reduce tasks at most; part of what decides the permutation, so it does not follow the cluster.
MAX_PARTITIONS = 4096


def shuffle_into_shards(
    docs: DataFrame,
    path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 16,
    seed: int = 20,
    bucket_bytes: int = BUCKET_BYTES,
    max_partitions: int = MAX_PARTITIONS,
) -> DataFrame:
    """Write all rows of ``docs`` as shuffled shards under ``path`` and return them read back.

    The files lie in one folder ``_shard=N`` per shard; ``_slot`` is the row's place there, gapless from 0. Law
    ``rows``: the shards' row counts are at most one apart. Null keys and null texts are records like any other.
    Key and text are hashed, so neither a key nor a text that a third of the rows share fills a bucket; rows that
    repeat both are numbered first and scatter one by one. An empty table gives no rows. Buckets have
    ``bucket_bytes`` on average; a single larger record makes a larger bucket. Columns of ``docs`` may have any type, maps
    too; those named like the two added ones are replaced. The same rows in the same files give the same shards
    again, on any cluster, and a task that is run again writes the same rows to the same slots.
    """
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/shards"
    records = _numbered_repeats(docs, key, text)
    content = F.xxhash64(F.lit(seed), F.col(f"_row.{key}"), F.col(f"_row.{text}"), F.col("_copy"))
    narrow = materialize(
        records.select(content.alias("_hash"), F.coalesce(F.octet_length(f"_row.{text}"), F.lit(0)).alias("_size"))
    )
    rows, total = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("_size") + 64), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    partitions = min(buckets, max_partitions)
    bucket = F.pmod("_hash", F.lit(buckets))
    part = F.expr(f"CAST(_bucket * {partitions} div {buckets} AS INT)")
    counts = materialize(narrow.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_part", part))
    # One row for each partition, then those of one partition by themselves.
    outer = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("_part").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("_part").agg(F.sum("_n").alias("_n"))
    sums = sums.select("_part", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    inside = counts.select("_part", "_bucket", F.coalesce(F.sum("_n").over(inner), F.lit(0)).alias("_inside"))
    starts = inside.join(F.broadcast(sums), "_part")  # sums has max_partitions rows at most
    # Pass one: scatter.
    scattered = records.select(content.alias("_hash"), "_copy", "_row").withColumn("_bucket", bucket).withColumn("_part", part)
    scattered = scattered.select("_part", "_bucket", F.lit(None).cast("long").alias("_start"), F.struct("_hash", "_copy", "_row").alias("_record"))
    nothing = F.lit(None).cast(scattered.schema["_record"].dataType)
    begins = starts.select("_part", "_bucket", (F.col("_before") + F.col("_inside")).alias("_start"), nothing.alias("_record"))
    # Pass two: each bucket is one array in one task. It is sorted, and so are the buckets of a task, so that the
    # shuffle does not depend on the order in which records arrive.
    order = "(a, b) -> CASE WHEN (a._hash, a._copy) < (b._hash, b._copy) THEN -1 WHEN (a._hash, a._copy) > (b._hash, b._copy) THEN 1 ELSE 0 END"
    shuffled = (
        scattered.union(begins)
        .repartitionById(partitions, "_part")
        .groupBy("_part", "_bucket")
        .agg(F.max("_start").alias("_start"), F.collect_list("_record").alias("_records"))
        .sortWithinPartitions("_bucket")
        .withColumn("_records", F.shuffle(F.expr(f"array_sort(_records, {order})"), seed))
    )
    shard = f"(_start + _at) * {shards} div {max(rows, 1)}"
    slot = f"_start + _at - (({shard}) * {rows}L + {shards - 1}) div {shards}"
    placed = shuffled.select("_start", F.posexplode("_records").alias("_at", "_record")).select(
        *[F.col("_record._row")[name].alias(name) for name in docs.columns if name not in ("_shard", "_slot")],
        F.expr(shard).cast("int").alias("_shard"),
        F.expr(slot).alias("_slot"),
    )
    placed.write.partitionBy("_shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _numbered_repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_row, _copy``: rows as structs; rows that repeat key and text have numbers that differ, others 0."""
    same = F.xxhash64(key, text)
    seen = docs.groupBy(same.alias("_same")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(seen.filter("_n > 1"))
    rows = docs.select(F.struct("*").alias("_row"), same.alias("_same"))
    if repeated.isEmpty():
        return rows.select("_row", F.lit(0).cast("long").alias("_copy"))
    rows = rows.withColumn("_id", F.monotonically_increasing_id() + 1)
    total = docs.count()
    found = skew_join(rows, repeated, ["_same"], "_n", total, F.col("_id"))
    # Stored, as the numbers must be the same wherever they are used.
    return materialize(found.select("_row", F.when(F.col("_n").isNotNull(), F.col("_id")).otherwise(F.lit(0)).alias("_copy")))
