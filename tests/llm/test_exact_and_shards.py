import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arealis.llm import exact_dedup, sharding


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda text: F.lit("all collide")], ids=["sha", "colliding"])
def test_report_matches_brute_force(awkward, digest):
    got = exact_dedup.exact_duplicates(awkward, digest=digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(awkward.collect())


def test_hot_group_is_salted(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_duplicates(docs)
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000").select("keep_id").distinct().collect()[0][0] == 2997


def test_drop_copies_keeps_whole_rows(awkward, nothing):
    got = exact_dedup.drop_copies(awkward)
    assert got.columns == awkward.columns
    rows = got.collect()
    assert len(rows) == len({r.text or "" for r in awkward.collect()})
    assert {r.doc_id for r in rows} == {3, 6, 7, 8, 9, 10, None}
    assert next(r for r in rows if r.doc_id == 6).source is None
    assert exact_dedup.drop_copies(nothing).count() == 0
    assert exact_dedup.exact_duplicates(nothing).count() == 0


@pytest.mark.parametrize("bucket_bytes", [200, 8 << 20])
def test_shards_hold_every_row_once(awkward, bucket_bytes):
    got = sharding.shuffle_into_shards(awkward, bucket_bytes=bucket_bytes, shards=5)
    rows = got.collect()
    assert sorted(str(tuple(r)[:-2]) for r in rows) == sorted(str(tuple(r)) for r in awkward.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r._shard].append(r._slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_of_nothing_and_of_one_row_repeated(spark, nothing):
    assert sharding.shuffle_into_shards(nothing).count() == 0
    same = spark.range(1000).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"), F.lit("own").alias("_shard"))
    got = sharding.shuffle_into_shards(same, bucket_bytes=2000)
    assert got.count() == 1000
    assert got.groupBy("_shard").agg(F.max("_slot").alias("s")).filter("s not in (61, 62)").isEmpty()


@pytest.fixture(scope="module")
def with_maps(spark):
    rows = [(i % 40 if i % 7 else None, f"text {i % 30}", {"a": i}) for i in range(200)] + [(1, "text 1", None)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, marks map<string, int>")


def test_columns_of_any_type_come_along(with_maps):
    kept = exact_dedup.drop_copies(with_maps)
    assert kept.columns == with_maps.columns and kept.count() == 30
    every = sorted(str(tuple(r)) for r in with_maps.collect())
    assert set(map(str, map(tuple, kept.collect()))) <= set(every)
    shards = sharding.shuffle_into_shards(with_maps, shards=3, bucket_bytes=500)
    assert sorted(str(tuple(r)[:-2]) for r in shards.collect()) == every


def placed(df):
    return sorted((str(tuple(r)), r._shard, r._slot) for r in df.collect())


def test_a_rerun_gives_the_same_shards(spark, with_maps):
    """Also with other partitions before the shuffle, and however many buckets share a task."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    for few in (3, 4096):
        first = placed(sharding.shuffle_into_shards(docs, bucket_bytes=2000, max_partitions=few))
        assert first == placed(sharding.shuffle_into_shards(docs.repartition(7), bucket_bytes=2000, max_partitions=few))
    assert placed(sharding.shuffle_into_shards(with_maps, bucket_bytes=500)) == placed(sharding.shuffle_into_shards(with_maps, bucket_bytes=500))


def test_repeated_rows_fill_no_bucket(spark):
    """Half of the keys are null with one text; buckets stay near their mean, and so do the tasks."""
    docs = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    records = sharding._numbered_repeats(docs, "doc_id", "text")
    buckets = records.groupBy(F.pmod(F.xxhash64(F.lit(20), "_row.doc_id", "_row.text", "_copy"), F.lit(50))).count()
    assert buckets.agg(F.max("count")).first()[0] < 1.5 * 8000 / 50
    assert sharding.shuffle_into_shards(docs, bucket_bytes=10_000, max_partitions=5).count() == 8000


def test_shuffle_moves_rows(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    order = [r.doc_id for r in sharding.shuffle_into_shards(docs, shards=1).orderBy("_slot").collect()]
    assert sorted(order) == list(range(500))
    assert sum(a == b for a, b in zip(order, range(500), strict=True)) < 20


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op8_quality_rules", "op10_sharding"])
def test_native_plans_hold_no_python(spark, name):
    from arealis.llm.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow") if word in plan]
