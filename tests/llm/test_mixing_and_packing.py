import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arealis.llm import mixing, near_dedup, packing
from arealis.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_targets_reshare_what_a_source_cannot_give():
    assert mixing.source_targets([100, 100, 100]) == [200.0, 83.33333333333333, 166.66666666666666]
    targets = mixing.source_targets([10, 1000, 5])
    assert targets[0] == 20 and targets[2] == 10 and sum(targets) == pytest.approx(1.5 * 1015)
    assert mixing.source_targets([]) == []
    assert mixing.source_targets([0, 0]) == [0.0, 0.0]


def test_mix_comes_near_its_targets(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_mixing"](spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    words = {i: len([w for w in (d.text or "").replace("\n", " ").split(" ") if w]) for i, d in docs.items()}
    totals = Counter()
    for i, d in docs.items():
        totals[d.source] += words[i]
    want = dict(zip(sorted(totals), mixing.source_targets([totals[s] for s in sorted(totals)]), strict=True))
    taken, longest = Counter(), max(words.values())
    for r in rows:
        source = docs[r.doc_id].source
        assert (r["size"], r.source_size, r.target) == (words[r.doc_id], totals[source], want[source])
        assert r.taken <= 2 * r["size"]
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= longest for s in want)
    assert sum(taken.values()) <= 1.5 * sum(totals.values())
    again = QUERIES["op7_mixing"](spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_serves_sources_evenly_all_along(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "ab"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = [r.source for r in mixing.mix(docs, weights=(3, 1), budget=0.5).collect()]
    half = Counter(mixed[: len(mixed) // 2])
    assert half["a"] / half["b"] == pytest.approx(3, rel=0.15)


def test_mix_of_awkward_rows(awkward, nothing):
    rows = mixing.mix_report(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert set(map(str, mixed.collect())) <= set(map(str, awkward.collect()))
    assert mixing.mix_report(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0


def fair_queue(rows, hashes, weights=mixing.WEIGHTS, budget=mixing.BUDGET, repeats=mixing.REPEATS):
    """Words taken per row, document by document: ``rows`` are (row, key, source, size), ``hashes`` by (row, repeat)."""
    totals = Counter()
    for _, _, source, size in rows:
        totals[source] += size
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mixing.source_targets([totals[s] for s in names], weights, budget, repeats), strict=True))
    slices = max(1, int((repeats * len(rows)) ** 0.5))
    queue = []
    for name in names:
        for repeat in range(repeats):
            mine = [(hashes[row, repeat] % slices, hashes[row, repeat], key, row, size) for row, key, source, size in rows if source == name]
            mine.sort(key=lambda m: (m[0], m[1], m[2] is not None, m[2] or 0, m[3]))
            words = repeat * totals[name]
            for _, code, key, row, size in mine:
                words += size
                finish = words / target[name] if target[name] > 0 else code % 2**30 / 2**30
                src = "" if name is None else f"={name}"
                queue.append(((int(finish * slices // 1), finish, src, repeat, code, key is not None, key or 0, row), row, size))
    taken, spent = Counter(), 0
    for _, row, size in sorted(queue):
        spent += size
        if spent > budget * sum(totals.values()):
            break
        taken[row] += size
    return taken


@pytest.mark.parametrize("case", ["unique", "repeated", "empty source"])
def test_taken_equals_a_sequential_fair_queue(spark, case):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        key = None if case == "repeated" and i % 3 == 0 else i // 2 if case == "repeated" and i % 3 == 1 else i
        source = ["a", "b", "c", "ä", None][min(4, int(rng.exponential(1)))]
        size = 0 if case == "empty source" and source == "b" else 5 if case == "repeated" else int(rng.integers(0, 40))
        rows.append((key, "w " * size, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    numbered = mixing.materialize(docs.select(F.monotonically_increasing_id().alias("row"), *mixing._narrow(F.col("doc_id"), F.col("text"), F.col("source"))))
    every = mixing._spread_repeats(numbered, len(rows)).withColumn("repeat", F.explode(F.array(F.lit(0), F.lit(1))))
    codes = every.select("row", "repeat", F.xxhash64(F.lit(7), "repeat", "key", "size", "_again").alias("h")).collect()
    plain = [(r.row, r.key, r.src[1:] if r.src else None, r.size_) for r in numbered.withColumnRenamed("size", "size_").collect()]
    want = fair_queue(plain, {(r.row, r.repeat): r.h for r in codes})
    _, taken = mixing._plan(numbered, mixing.WEIGHTS, mixing.BUDGET, mixing.REPEATS, 7)
    sizes = {row: size for row, _, _, size in plain}
    got = Counter()
    for r in taken.collect():
        got[r.row] += sizes[r.row]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_repeated_keys_and_empty_sources_spread_over_slices(spark):
    """A third of the rows without a key, a third with one key, all of one size, or without words: no large slice."""
    n = 6000
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(5)).otherwise(F.col("id")).cast("long")
    rows = spark.range(n).select(F.col("id").alias("row"), key.alias("key"), F.lit(4).cast("long").alias("size"))
    slices = int((2 * n) ** 0.5)
    spread = mixing._spread_repeats(rows, n).select(F.pmod(F.xxhash64(F.lit(7), F.lit(0), "key", "size", "_again"), F.lit(slices)).alias("s"))
    assert spread.groupBy("s").count().agg(F.max("count")).first()[0] < 5 * n / slices
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(" ").alias("text"), F.lit("blank").alias("source"))
    _, taken = mixing.mix_plan(docs)
    finish = [r.finish for r in taken.collect()]
    assert len(finish) == 2 * n and max(Counter(int(f * slices) for f in finish).values()) < 5 * len(finish) / slices


TEXTS = st.text(alphabet=st.sampled_from(list("ab Zé'.,1 \n\t  \x1c\x85日<|endoftext|>")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_encoder_gives_the_tokenizers_ids(texts):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    got = packing._encoder(*RANKS).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


MARKED = st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", " b", "Z'é", "日"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(MARKED.map("".join), max_size=5))
def test_added_tokens_are_those_of_the_tokenizer(texts):
    whole = Tokenizer.from_file(PATH)
    texts = [*texts, "a <|endoftext|> b"]
    got = packing._encoder(*RANKS).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert np.frombuffer(got[-1], "<u4").tolist() == [64, 220, 50256, 275]


def test_stages_keep_one_cache_in_a_process():
    """The words of an earlier stage are not kept beside those of a later one."""
    encoder, shingler = packing._encoder(*RANKS), near_dedup._shingler()
    shingler.hashes("some words")
    assert shingler.known and packing._encoder(*RANKS) is encoder
    assert not shingler.known
    encoder.encode(["some words"])
    assert encoder.first and encoder.rest and near_dedup._shingler() is shingler
    assert not encoder.first and not encoder.rest


def check_packing(rows, docs, capacity=packing.CAPACITY):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    want = Counter()
    for key, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        starts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[key, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        ends = [0, *(a + n for a, n in parts)]
        assert [a for a, _ in parts] == ends[:-1] and ends[-1] <= capacity
    return len(bins)


def test_packing_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op6_packing"](spark, folder).collect()
    bins = check_packing(rows, docs)
    assert bins <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


def test_packing_awkward_rows(awkward, nothing):
    packed = packing.pack(awkward, *RANKS)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    check_packing(packed.collect(), docs)
    whole = packing.sequences(packed).collect()
    assert sum(len(b"".join(r.ids)) // 4 for r in whole) == sum(r.length for r in whole)
    assert packing.pack(nothing, *RANKS).count() == 0


def one_by_one(lengths, capacity):
    """The sequential method: one bin at a time over a list of pieces."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        taken, gap = [], capacity
        for x in list(left):
            if x <= gap:
                taken.append(x)
                left.remove(x)
                gap -= x
        if gap:
            s = min(taken)
            pairs = [(a + b, -a) for i, a in enumerate(left) for b in left[i + 1 :] if s < a + b <= s + gap]
            if pairs:
                total, a = max(pairs, key=lambda p: (p[0], -min(-p[1], p[0] + p[1])))
                taken.remove(s)
                for x in (-a, total + a):
                    taken.append(x)
                    left.remove(x)
                left.append(s)
                left.sort(reverse=True)
        bins.append(sorted(taken))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_histogram_plan_is_the_sequential_method(lengths):
    plan = packing.plan_bins(Counter(lengths), 30)
    got = Counter()
    for bins, contents in plan:
        got[tuple(sorted(x for length, n in contents for x in [length] * n))] += bins
    used = Counter(x for bin_, n in got.items() for x in bin_ for _ in range(n))
    assert used == Counter(lengths)
    assert all(sum(bin_) <= 30 for bin_ in got)
    assert sum(got.values()) == len(one_by_one(lengths, 30))
    assert len(plan) <= 30
