import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import near_dedup as nd

FREQUENT_NONE = (np.zeros(0, np.uint64), np.zeros(0))


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def brute_classes(rows):
    """Connected components of equal texts and of pairs with a Jaccard similarity of 0.8 or more."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            if equal or (sets[i] & sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                label[find(i)] = find(j)
    out = defaultdict(set)
    for i, (key, _) in enumerate(rows):
        out[find(i)].add(key)
    return {frozenset(ids) for ids in out.values()}


def classes(found):
    out = defaultdict(set)
    for r in found:
        out[r.class_id].add(r.doc_id)
    return {frozenset(ids) for ids in out.values()}


def corpus(seed, groups):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for size in groups:
        base = [word() for _ in range(rng.randint(80, 200))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join([word() for _ in range(150)] + passage) for _ in range(20)]
    rows += [rows[0], rows[1], None, "", "too short", "too short"]
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [nd.BLOCK, 4])
def test_classes_match_brute_force(spark, monkeypatch, block):
    rows = corpus(1, [1] * 20 + [2] * 8 + [15])
    monkeypatch.setattr(nd.candidate_pairs, "__defaults__", (block,))
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got, want = classes(found), brute_classes(rows)
    if block == nd.BLOCK:
        assert got == want
    else:  # blocks meet through their trees' best members
        assert sum(len(ids) > 1 for ids in got ^ want) <= 2
    sizes = {r.doc_id: r.class_size for r in found}
    assert all(sizes[key] == len(ids) for ids in got for key in ids)
    assert all(r.kept == (r.doc_id == r.class_id == min(ids)) for ids in got for r in found if r.doc_id in ids)


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(3)
    seen, true = [], []
    for _ in range(60):
        common = rng.integers(0, 2**63, 150).astype(np.uint64)
        own = rng.integers(0, 2**63, (2, rng.integers(1, 60))).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, x])) for x in own]
        weights = [(1 + (s % np.uint64(3)).astype(np.float32)) for s in sets]
        true.append(nd.weighted_jaccard(sets[0], weights[0], sets[1], weights[1]))
        seen.append((nd.sample(sets[0], weights[0]) == nd.sample(sets[1], weights[1])).mean())
    assert abs(np.mean(seen) - np.mean(true)) < 0.02
    assert np.abs(np.array(seen) - true).max() < 0.25


def test_scaled_weights_and_long_texts():
    sets = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(sets)
    sets = sets[order]
    one = nd.sample(sets, np.full(5000, 1.8, np.float32))
    assert (one == nd.sample(sets, np.full(5000, 1.8, np.float32))).all()
    half = nd.sample(sets, np.full(5000, 0.9, np.float32))
    assert 0.2 < (one == half).mean() < 0.8  # the weighted similarity is one half


def test_frequent_shingles_are_exact(spark):
    rows = [(i, "always the same five words " + " ".join(f"own{i}x{j}" for j in range(6))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    (found, weight), full = nd.frequent_shingles(df, "doc_id", "text")
    assert len(found) == 1 and weight[0] == pytest.approx(np.log1p(1))
    assert full == pytest.approx(np.log1p(1 / nd.FREQUENT))


def test_a_repeated_phrase_does_not_make_texts_alike(spark):
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(100)) + " again and" * 300) for i in range(5)]
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.filter("class_size > 1").isEmpty()


def test_awkward_rows(awkward, nothing):
    found = nd.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    by_key = defaultdict(set)
    for r in found:
        by_key[r.class_id].add(r.doc_id)
    assert by_key[1] == {1, 2, 10} and by_key[4] == {4, 5, 6} and by_key[None] == {None}
    kept = nd.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 7, 8, 9, None}
    assert nd.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("wide", [nd.WIDE, 0], ids=["in parts", "by groups of samples"])
def test_blocks_of_a_bucket_lose_no_pair(spark, monkeypatch, wide):
    """Chains in one bucket, only neighbours similar: a failed pair of two blocks must not be the only one tried."""
    rng = random.Random(1)
    rows = []
    for _ in range(2):
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
        rows += [" ".join(words[i * 8 : i * 8 + 104]) for i in range(20)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    sign = nd.signatures
    monkeypatch.setattr(nd, "signatures", lambda *given: sign(*given).withColumn("keys", F.array(F.lit(7).cast("long"))))
    monkeypatch.setattr(nd.candidate_pairs, "__defaults__", (8,))
    monkeypatch.setattr(nd, "WIDE", wide)
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert classes(found) == brute_classes(rows)


def test_small_partitions_send_few_candidates(spark):
    """In a partition of a few rows every shingle is frequent; the bound over all partitions drops the rare ones."""
    rows = [(i, "always the same five words " + " ".join(f"own{i}x{j}" for j in range(6))) for i in range(64)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(32)
    found, total = nd.frequent_candidates(df)
    assert total == 64 and found.count() == 1


def planted_frequencies():
    """Shingles in 1, 2, 3 and 30 of 60 texts, dealt over several chunks."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    shared = {n: " ".join(word() for _ in range(12)) for n in (2, 3, 30)}
    return [(i, " ".join([*(shared[n] for n in shared if i < n), *(word() for _ in range(30))])) for i in range(60)]


def test_every_shingle_has_its_own_document_frequency(spark, monkeypatch):
    """Rare shingles too: no two document frequencies weigh the same."""
    rows = planted_frequencies()
    monkeypatch.setattr(nd, "CHUNK_BYTES", 700)
    monkeypatch.setattr(nd, "_can_match", lambda *_: True)
    texts, chunks, total = nd._in_chunks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    assert chunks > 8 and total == 60
    shingler, want = nd.Shingler(), defaultdict(int)
    sets = {i: shingler.counted(t) for i, t in rows}
    for found, _ in sets.values():
        for h in found.tolist():
            want[h] += 1
    assert set(want.values()) >= {1, 2, 3, 30}
    for r in nd.signatures(texts, chunks, total).collect():
        df = np.frombuffer(r.df, np.uint32)
        assert df.tolist() == [want[h] for h in sets[r.id][0].tolist()]
        assert nd.weigh(sets[r.id][1], df, total)[0] == pytest.approx(np.log1p(60 / df))


def rare_and_common():
    """Texts 0 and 1 share what no other has, but differ in a common line: under 0.8 of their shingles are the same."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    lines = [" ".join(word() for _ in range(16)) for _ in range(2)]
    rare = " ".join(word() for _ in range(100))
    rows = [(0, f"{rare} {lines[0]}"), (1, f"{rare} {lines[1]}")]
    rows += [(i, " ".join([*(word() for _ in range(100)), lines[i % 2]])) for i in range(2, 62)]
    return rows + [(i, " ".join(word() for _ in range(20))) for i in range(62, 200)]


def test_rare_shingles_outweigh_common_ones(spark):
    rows = rare_and_common()
    sets = [shingles(t) for _, t in rows[:2]]
    assert len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1])
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).filter("class_size > 1").collect()
    assert {r.doc_id for r in found} == {0, 1}


def test_texts_that_match_nothing_have_no_samples(spark):
    rows = planted_frequencies()[:1] + [(100 + i, " ".join(f"own{i}x{j}" for j in range(50))) for i in range(5)]
    rows += [(200, rows[0][1] + " more")]
    texts = nd._in_chunks(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert {r.id for r in nd.signatures(*texts).filter("size(keys) > 0").collect()} == {0, 200}
