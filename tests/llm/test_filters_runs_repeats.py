"""Filter audit, periodic runs and repeats against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import filter_audit, periodic_runs, repeats

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Filter audit


def brute_masks(rows):
    out = []
    for key, text, lang in rows:
        t = (text or "").encode()
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text or "")) > 10 * len(text or ""),
            "D": bool(re.search("[#$%&*|]", text or "")),
            "E": key is not None and any(k is not None and k < key and (u or "") == (text or "") for k, u, _ in rows),
        }
        out.append((lang or "", {x for x, failed in fails.items() if failed}, key))
    return out


def brute_audit(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    masks, out = brute_masks(rows), []
    shapley = Counter()
    for part in {p for p, _, _ in masks}:
        mine = [(f, k) for p, f, k in masks if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [(f, k) for f, k in left if x in f]
                kept = [(f, k) for f, k in left if x not in f]
                failing = [f for f, _ in mine if x in f]
                row = [part, "".join(order), step, len(kept), len(removed), len(failing) - len(removed), sum(f == {x} for f in failing)]
                out.append((*row, sum(k in good for _, k in removed), sum(k in toxic for _, k in removed)))
                shapley[part, x] += len(removed)
                left = kept
    return sorted(((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out), key=repr)


def documents(rng, n):
    texts, rows = ["", "a", "shared beginning " * 40, "SHOUT " * 120, "#"], []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            text = rng.choice(texts)
        else:
            text = "shared beginning " * rng.choice([0, 40]) + " ".join(f"w{rng.randrange(10 ** rng.randint(1, 4))}" for _ in range(rng.randrange(200)))
            texts.append(text)
        rows.append((rng.choice([i, i, i, None]), rng.choice([text, text, text, None]), rng.choice(["en", "de", None])))
    return rows + rows[:5]


SCHEMA = "doc_id long, text string, lang string"


@pytest.mark.parametrize("trie_bytes", [1, 1 << 20])
def test_audit_equals_brute_force(spark, marks, monkeypatch, trie_bytes):
    monkeypatch.setattr(filter_audit, "TRIE_BYTES", trie_bytes)
    rows = documents(random.Random(trie_bytes), 150)
    got = filter_audit.filter_audit(spark.createDataFrame(rows, SCHEMA), marks)
    labels = [(r.doc_id, r.quality, r.toxic) for r in marks.collect()]
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert rows_of(got) == brute_audit(rows, labels)


def test_audit_of_awkward_and_empty_tables(spark, awkward, nothing, marks):
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in marks.collect()]
    assert rows_of(filter_audit.filter_audit(awkward, marks)) == brute_audit(rows, labels)
    assert filter_audit.filter_audit(nothing, marks).count() == 0
    assert filter_audit.filter_audit(awkward, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_trie_holds_least_ids():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(400)]
    trie, duplicates = filter_audit.RadixTrie(), []
    keys = [rng.randrange(300) for _ in texts]
    for text, key in zip(texts, keys, strict=True):
        duplicates += trie.insert(text, key, (key, text))
    least = {t: min(k for u, k in zip(texts, keys, strict=True) if u == t) for t in texts}
    found = list(trie.traverse())
    assert {t: {k for k, _ in rows} for t, rows in found} == {t: {k} for t, k in least.items()}
    assert Counter(duplicates) == Counter((k, t) for t, k in zip(texts, keys, strict=True) if k > least[t])


def test_prefixes_grow_until_they_part(spark):
    rows = [(i, "same beginning " * 30 + str(i), "en", 0) for i in range(40)] + [(99, "other", "en", 0)] * 3
    df = spark.createDataFrame(rows, "id long, text string, part string, mask int").withColumn("text", F.col("text").cast("binary"))
    out, length = filter_audit.prefix_lengths(df, 4)
    lengths = {(r.id, r.n) for r in out.select("id", length.alias("n")).collect()}
    assert {n for i, n in lengths if i < 99} == {1024} and {n for i, n in lengths if i == 99} == {16}


# Periodic runs


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] == w[i - q]:
                j = i
                while j < n and w[j] == w[j - q]:
                    j += 1
                s, size = i - q, j - i + q
                if size >= max(6, 4 * q) and not any(w[s + p : s + size] == w[s : s + size - p] for p in range(1, q)):
                    out.append((s, size, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(key, text, plant=True):
    w = WORD.findall((text or "").encode())
    if plant and key is not None and w and (h := zlib.crc32(str(key).encode())) % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    rest = b" ".join(x for i, x in enumerate(w) if i not in gone)
    milli = best[1] * 1000 // best[2] if runs else None
    return (key, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_runs_of_random_words():
    rng = random.Random(7)
    for _ in range(1500):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
        w = [b"%d" % rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n > 4:
            a, p = rng.randrange(n), rng.randint(1, n // 3)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        assert periodic_runs.runs_of(w) == brute_runs(w)


def test_runs_of_long_texts_take_few_cells():
    one = [b"a"] * 50_000
    assert periodic_runs.runs_of(one) == [(0, 50_000, 1)]
    assert periodic_runs.collapsed(one, [(0, 50_000, 1)]) == [b"a"]
    a, b = [b"a"], [b"b"]
    while len(a) < 30_000:  # a Fibonacci word has no fourth power
        a, b = a + b, a
    assert periodic_runs.runs_of(a) == []
    assert len(periodic_runs._cells(periodic_runs._numbered(a))) < 20 * len(a)


def test_run_report_equals_brute_force(spark, awkward, nothing):
    rng = random.Random(8)
    rows = [(i, " \t\n\v\f\r"[rng.randrange(6)].join(rng.choice("abc") for _ in range(rng.randrange(80)))) for i in range(200)]
    df = spark.createDataFrame([*rows, *rows[:3], (None, "a " * 30), (2**53 + 1, "b " * 9)], "doc_id long, text string")
    want = sorted((brute_report(r.doc_id, r.text) for r in df.collect()), key=repr)
    assert rows_of(periodic_runs.run_report(df, words_of=periodic_runs.planted)) == want
    assert rows_of(periodic_runs.run_report(df)) == sorted((brute_report(r.doc_id, r.text, False) for r in df.collect()), key=repr)
    strange = awkward.filter("doc_id is null or doc_id != 7")
    assert rows_of(periodic_runs.run_report(strange)) == sorted((brute_report(r.doc_id, r.text, False) for r in strange.collect()), key=repr)
    assert periodic_runs.run_report(awkward).count() == awkward.count()
    for result in (periodic_runs.run_report(nothing), periodic_runs.find_runs(nothing), periodic_runs.collapse_runs(nothing)):
        assert result.count() == 0


def test_runs_and_collapsed_texts(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y"), (2, None), (None, "z " * 7)], "doc_id long, text string")
    assert rows_of(periodic_runs.find_runs(df)) == [(1, 1, 15, 3), (None, 0, 7, 1)]
    assert rows_of(periodic_runs.collapse_runs(df)) == [(1, "x a b c y"), (2, ""), (None, "z")]


# Repeats


def brute_removal(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[:-1] & ~np.append(False, gone[:-1][:-1])).sum()) if t else 0
        kept = bytes(b for b, x in zip(t, gone, strict=False) if not x)
        out.append((key, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removal(df, **options):
    out = repeats.remove_repeats(df, **options).withColumn("kept", F.sha2("kept", 256))
    return rows_of(out)


def texts_with_repeats(rng, n, alphabet, longest):
    texts = []
    for _ in range(n):
        kind, size = rng.random(), rng.randint(0, longest)
        text = "".join(rng.choice(alphabet) for _ in range(size))
        if kind < 0.3 and texts:
            other = rng.choice(texts)
            a, b = sorted((rng.randrange(len(other) + 1), rng.randrange(len(other) + 1)))
            text = text[: size // 2] + other[a:b] + text[size // 2 :]
        elif kind < 0.4:
            text = (rng.choice(["a", "ab", "abc"]) * size)[:size]
        elif kind < 0.45 and texts:
            text = rng.choice(texts)
        texts.append(text)
    return texts


@pytest.mark.parametrize("length,group,alphabet", [(8, 2000, "ab"), (16, 3, "abcdefgü"), (200, 3, "abcdefgh")])
def test_removal_equals_brute_force(spark, length, group, alphabet):
    rng = random.Random(length)
    texts = texts_with_repeats(rng, 20 if length == 16 else 40, alphabet, 6 * length if length > 16 else 100)
    if length == 200:  # a line that many texts hold, and texts of one period
        texts = [t + "LINE" * 16 + "".join(rng.choice(alphabet) for _ in range(90)) for t in texts] + ["a" * 3000, "ab" * 2000, "only here " * 40]
    rows = [*enumerate(texts), (None, None), (None, texts[0]), (2**53 + 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removal(df, length=length, group=group) == brute_removal(rows, length)


def test_large_groups_are_coded_anew_without_all_their_crowded_grams(spark, monkeypatch):
    """Near copies with changed words and a common passage: right spans, after few rounds."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    base, passage = [word() for _ in range(40)], " ".join(word() for _ in range(12))
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(40), 2):
            copy[at] = word()
        texts += [" ".join(copy), f"{word()} {word()} {passage} {word()} {word()}"]
    rows = list(enumerate(texts))
    rounds = []
    different = repeats._different_pieces
    monkeypatch.setattr(repeats, "_different_pieces", lambda *a: (rounds.append(a[-1]), different(*a))[1])
    monkeypatch.setattr(repeats, "OFTEN", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert removal(df, length=60, group=8) == brute_removal(rows, 60)
    assert len(rounds) <= 4


def test_excluded_grams_are_codes_of_windows_without_others_only():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 2 + b"0123456789", np.uint8)
    hashes = repeats._gram_hashes(data, 8)
    _, _, plain, _ = repeats.cut_pieces(data, 24, np.array([], np.uint64))
    _, _, codes, _ = repeats.cut_pieces(data, 24, plain[:1])
    assert plain[0] not in codes and set(codes) <= set(hashes)
    assert set(repeats.cut_pieces(data, 24, hashes)[2]) == set(plain)


def test_repeats_of_awkward_and_empty_tables(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id != 7]
    assert rows_of(repeats.removal_report(awkward.filter("doc_id is null or doc_id != 7"))) == brute_removal(rows, 200)
    assert repeats.removal_report(awkward).count() == awkward.count()
    assert repeats.removal_report(nothing).count() == 0
    assert repeats.repeat_groups(nothing).count() == 0


def test_groups_have_all_occurrences(spark):
    rng = random.Random(2)
    passage, common = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (90, 40))
    texts = [f"{'x' * i}<{passage}>{i}{common}{'y' * i}" for i in range(3)] + [f"#{common}#{passage}" * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    groups = defaultdict(set)
    for r in repeats.repeat_groups(df, length=30).collect():
        groups[r.repeat, r.size].add((r.row, r.start))
    covered = defaultdict(set)
    for (_, size), places in groups.items():
        strings = {texts[row][start : start + size] for row, start in places}
        assert len(strings) == 1 and len(places) > 1
        string = strings.pop()
        everywhere = {(i, m.start()) for i, t in enumerate(texts) for m in re.finditer(f"(?={re.escape(string)})", t)}
        assert places <= everywhere
        for row, start in places:
            covered[row] |= set(range(start, start + size))
    for key, n, gone, _, _ in removal(df, length=30):
        assert len(covered[key]) == gone and n == len(texts[key])


def test_suffix_array_finds_maximal_repeats():
    """Against all pairs of suffixes: lengths, occurrences and diversity on both sides."""
    rng = random.Random(6)
    for _ in range(60):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 14))) for _ in range(rng.randint(1, 5))]
        array = repeats.SuffixArray(pieces, 3)
        flat = [(i, j) for i, p in enumerate(pieces) for j in range(len(p))]
        got = {
            (size, frozenset(flat[k] for k in array.order[i:j])) for size, i, j in array.maximal_repeats()
        }
        want = set()
        strings = {p[a:b] for p in pieces for a in range(len(p)) for b in range(a + 3, len(p) + 1)}
        for s in strings:
            at = [(i, j) for i, p in enumerate(pieces) for j in range(len(p)) if p.startswith(s, j)]
            left = {pieces[i][j - 1] if j else -1 - i for i, j in at}
            right = {pieces[i][j + len(s)] if j + len(s) < len(pieces[i]) else -1 - i for i, j in at}
            if len(at) > 1 and len(left) > 1 and (len(right) > 1):
                want.add((len(s), frozenset(at)))
        assert got == want
