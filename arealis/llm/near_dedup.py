"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

1. The document frequency of every shingle is counted: texts are dealt to chunks, the distinct shingles of a chunk to
   buckets by hash, and each bucket tells each chunk the counts of the shingles that it sent. A shingle weighs its term
   frequency times ln(1 + N / df); a second weighting has the same with a ceiling, so that what large groups of near
   copies share does not weigh too little beside a few changed words. Texts are near if either similarity is high.
2. Every text is sampled by both weightings: two texts agree in one sample with a probability equal to their weighted
   Jaccard similarity. Samples are banded; texts that agree in a band meet in a bucket. Texts with too little weight on
   shingles that occur in another text are near to none and have no samples.
3. Buckets of two are one candidate pair. Larger buckets, in blocks of bounded size, are linked by a
   forest of their most similar pairs, found on the samples inside a task; blocks meet again through the roots of
   their trees. Pairs inside a bucket are never written out.
4. Candidate pairs are verified by exact weighted Jaccard similarity. Where a failed pair leaves a block in parts,
   the block's task goes through all other pairs between the parts, likeliest first, until the parts meet.
5. Verified links are joined to connected components.
6. Where a bucket of several blocks still holds several components, tasks of two parts each go through all pairs
   of its members that are in different components, in the same way. Buckets with many such parts are first bucketed
   again by each of twenty groups of samples of either weighting, of which any pair worth trying shares one.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import keep_cache, skew_join
from arealis.sources.scratch import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
# Share of the documents from which a shingle counts as frequent; under the ceiling, rarer ones share the full weight.
FREQUENT = 0.2
WEIGHTINGS = 2  # inverse document frequency as it is, and with a ceiling
CHUNK_BYTES = 4 << 20  # of text whose shingles are counted together
CHUNKS_A_BUCKET = 1  # shingles of a bucket, in those of a chunk
# Estimated similarity from which a pair is verified: 3.5 standard errors of 48 samples below 0.8.
TRY_FROM = 0.6
BLOCK = 1024
# Parts of a bucket outside of its largest component from which buckets of groups of samples cost less.
WIDE = 20
CACHE_WORDS = 200_000
CHUNK = 2048  # shingles sampled at once
SETS_AT_ONCE = 128
LIMIT = 4.0  # times the mean of the least value's distribution: all but two in a hundred lie below

_U = np.uint64
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], _U)
_MIX = _U(0xBF58476D1CE4E5B9)
_LOW = _U(0xFFFF)


class _Words(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code


class Shingler:
    """Hashes of the word shingles of a text; hashes of frequent words are kept."""

    def __init__(self) -> None:
        self.known = _Words()

    def hashes(self, text: str) -> np.ndarray:
        """One hash per shingle in text order. A text of fewer words is one shingle, one without words none."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        words = text.split()
        codes = np.fromiter(map(self.known.__getitem__, words), _U, len(words))
        width = min(SHINGLE, len(codes))
        n = len(codes) - width + 1 if width else 0
        out = np.zeros(n, _U)
        for i in range(width):
            out += codes[i : i + n] * _STEP[i]
        return out ^ (out >> _U(31))

    def counted(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles, sorted, and how often each occurs."""
        return np.unique(self.hashes(text), return_counts=True)


def weigh(counts: np.ndarray, df: np.ndarray, total: int) -> np.ndarray:
    """Weights of shingles by weighting: term frequency times inverse document frequency, and that with a ceiling.

    The term frequency is 1 + ln(times), or else one phrase said over and over would make texts alike
    that share nothing else. The ceiling is the weight of a shingle in FREQUENT of all documents.
    """
    rare = np.log1p(total / df)
    return ((1 + np.log(counts)) * np.stack([rare, np.minimum(rare, math.log1p(1 / FREQUENT))])).astype(np.float32)


@functools.lru_cache(maxsize=1)
def _one_shingler() -> Shingler:
    return Shingler()


def _shingler() -> Shingler:
    shingler = _one_shingler()
    keep_cache("shingler", shingler.known.clear)
    return shingler


@functools.lru_cache(maxsize=1)
def _gamma_table() -> np.ndarray:
    """65,536 quantiles of the Gamma(2, 1) distribution, by inverting its distribution function."""
    x = np.concatenate([[0], np.geomspace(1e-4, 30, 400_000)])
    share = -np.expm1(-x) - x * np.exp(-x)
    return np.interp((np.arange(65536) + 0.5) / 65536, share, x)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    gamma = _gamma_table()
    seeds = (np.arange(1, SAMPLES + 1, dtype=_U) * _STEP[0]) ^ _STEP[3]
    return gamma.astype(np.float32), (1 / gamma).astype(np.float32), np.log(gamma).astype(np.float32), seeds


def _drawn(h: np.ndarray, log_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value that decides a sample, and t, from hashes and logarithms of weights side by side."""
    r_of, inverse_r_of, log_c_of, _ = _tables()
    draws = h.view(np.uint16).reshape(*h.shape, 4)
    r = r_of[draws[..., 0]]
    b = draws[..., 1] * np.float32(2.0**-16)
    t = np.floor(log_weight * inverse_r_of[draws[..., 0]] + b)
    return log_c_of[draws[..., 2]] - r * (t - b) - r, t


@functools.lru_cache(maxsize=1)
def _buffers() -> tuple[np.ndarray, ...]:
    """Room for one chunk, used again and again: fresh memory costs more than the arithmetic."""
    return tuple(np.empty(SAMPLES * CHUNK, kind) for kind in (_U, _U, np.float32, np.float32, bool))


def sample_many(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Improved consistent weighted sampling (Ioffe 2010): SAMPLES signed 32-bit fingerprints per set of shingles and weights.

    For each sample every shingle draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash; with
    t = floor(ln S / r + b) and ln y = r (t - b), the shingle of least ln c - ln y - r is taken together with t.
    Short sets go through numpy together, long ones in parts. No set may be empty.
    """
    sizes = np.array([len(shingles) for shingles, _ in sets])
    parts = -(-sizes // CHUNK)
    code = np.concatenate([shingles for shingles, _ in sets])
    log_weight = np.log(np.concatenate([weights for _, weights in sets]))
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.repeat(np.cumsum(sizes) - sizes, parts) + nth * CHUNK
    ends = np.append(starts[1:], len(code))
    found = []
    first = 0
    while first < len(starts):  # as many parts at once as fit a chunk
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK, "right")))
        begin, end = starts[first], ends[last - 1]
        found.append(_sample_parts(code[begin:end], log_weight[begin:end], starts[first:last] - begin))
        first = last
    value, who, level = (np.concatenate(column, axis=1) for column in zip(*found, strict=True))
    chosen = np.repeat((np.cumsum(parts) - parts)[None, :], SAMPLES, axis=0)
    for i in np.flatnonzero(parts > 1):
        chosen[:, i] += value[:, chosen[0, i] : chosen[0, i] + parts[i]].argmin(1)
    who, level = np.take_along_axis(who, chosen, 1), np.take_along_axis(level, chosen, 1)
    seeds = _tables()[3][:, None]
    out = (who ^ (level.astype(np.int64).astype(_U) * _STEP[1])) * (seeds | _U(1))
    return np.ascontiguousarray((out >> _U(32)).astype(np.uint32).view(np.int32).T)


def _begins(groups: np.ndarray) -> np.ndarray:
    """Where stretches of equal values begin."""
    is_first = np.ones(len(groups), bool)
    np.not_equal(groups[1:], groups[:-1], out=is_first[1:])
    return np.flatnonzero(is_first)


def _sample_parts(code: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sample and part: the least value, the first shingle that has it, and its t.

    As ln y is at most ln S, a value is at least ln c - r - ln S. The exponential of the least value of a part has an
    exponential distribution with the sum of the weights as its rate; so it seldom lies above ``limit``, and only shingles
    whose bound does not are worked out. Where none has a value up to ``limit``, all of the part's shingles are.
    """
    r_of, _, log_c_of, seeds = _tables()
    sizes = np.append(starts[1:], len(code)) - starts
    limit = np.log(LIMIT / np.add.reduceat(np.exp(log_weight), starts))
    h, low, bound, other, is_near = (buffer[: SAMPLES * len(code)].reshape(SAMPLES, len(code)) for buffer in _buffers())
    np.multiply((seeds | _U(1))[:, None], code[None, :], out=h)  # samples in rows
    h ^= np.right_shift(h, _U(29), out=low)
    h *= _MIX
    h ^= np.right_shift(h, _U(32), out=low)
    np.right_shift(h, _U(32), out=low)
    np.take(log_c_of, np.bitwise_and(low, _LOW, out=low).view(np.int64), out=bound, mode="clip")
    np.take(r_of, np.bitwise_and(h, _LOW, out=low).view(np.int64), out=other, mode="clip")
    bound -= other
    reach = log_weight + np.repeat(limit, sizes) + np.float32(1e-3)  # more than the rounding
    near = np.flatnonzero(np.less_equal(bound, reach, out=is_near))
    row, place = np.divmod(near, len(code))
    a, t = _drawn(h.ravel()[near], log_weight[place])
    group = row * len(starts) + np.repeat(np.arange(len(starts)), sizes)[place]
    begins = _begins(group)
    least = np.minimum.reduceat(a, begins) if len(begins) else a
    first = np.flatnonzero(a == np.repeat(least, np.append(begins[1:], len(group)) - begins))
    first = first[_begins(group[first])]  # of equal values the first place
    value = np.full((SAMPLES, len(starts)), np.inf, np.float32)
    who, level = np.zeros(value.shape, _U), np.zeros(value.shape, np.float32)
    value.ravel()[group[first]], who.ravel()[group[first]], level.ravel()[group[first]] = a[first], code[place[first]], t[first]
    for i, part in np.argwhere(value > limit).tolist():
        mine = slice(starts[part], starts[part] + sizes[part])
        a, t = _drawn(np.ascontiguousarray(h[i, mine]), log_weight[mine])
        k = int(a.argmin())
        value[i, part], who[i, part], level[i, part] = a[k], code[mine][k], t[k]
    return value, who, level


def sample(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The fingerprints of one set."""
    return sample_many([(shingles, weights)])[0]


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _in_chunks(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int, int]:
    """``chunk, id, digest, text`` of all rows, the number of chunks, and of rows."""
    texts = _texts(docs, key, text)
    total, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    texts = texts.withColumn("digest", F.sha2("text", 256))
    return texts.withColumn("chunk", F.pmod(F.xxhash64("id", "digest"), F.lit(chunks))), chunks, total


def document_frequencies(texts: DataFrame, chunks: int) -> DataFrame:
    """``chunk, bucket, df``: the number of rows of ``texts`` with each distinct shingle of the chunk (bytes, unsigned 32 bits).

    The shingles of a chunk come in the order of their hashes: buckets are ranges of hashes, and so are the places in one.
    """
    buckets = -(-chunks // CHUNKS_A_BUCKET)
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], _U)

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        shingler = _shingler()
        found, count = np.unique(np.concatenate([np.unique(shingler.hashes(t)) for t in pdf["text"]]), return_counts=True)
        cuts = [0, *np.searchsorted(found, edges).tolist(), len(found)]
        parts = [(k, i, j) for k, (i, j) in enumerate(itertools.pairwise(cuts)) if i < j]
        count = count.astype(np.uint32)
        out = [(pdf["chunk"].iloc[0], k, found[i:j].tobytes(), count[i:j].tobytes()) for k, i, j in parts]
        return pd.DataFrame(out, columns=["chunk", "bucket", "shingles", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sent = np.frombuffer(b"".join(pdf["shingles"]), _U)
        _, place = np.unique(sent, return_inverse=True)
        df = np.bincount(place, np.frombuffer(b"".join(pdf["counts"]), np.uint32)).astype(np.uint32)[place]
        ends = np.cumsum([len(s) // 8 for s in pdf["shingles"]])
        found = [part.tobytes() for part in np.split(df, ends[:-1])]
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "df": found})

    dealt = texts.groupBy("chunk").applyInPandas(deal, "chunk long, bucket long, shingles binary, counts binary")
    return dealt.groupBy("bucket").applyInPandas(add, "chunk long, bucket long, df binary")


def frequent_candidates(texts: DataFrame) -> tuple[DataFrame, int]:
    """``h`` of the shingles that can be in FREQUENT of all documents by their counts per partition, and the number of
    documents.

    A partition lists what is in half that share of its documents. Where a shingle is not listed it has less, so
    those that stay have half the share overall: at most 2 / FREQUENT times the average shingles per document.
    """
    listed = FREQUENT / 2

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, n = _shingler(), 0
        kept: list[np.ndarray] = []
        for batch in batches:
            n += len(batch)
            kept += [np.unique(shingler.hashes(t)) for t in batch["text"]]
        if kept:
            found, count = np.unique(np.concatenate(kept), return_counts=True)
            often = count >= listed * n
            yield pd.DataFrame({"n": n, "h": [found[often].view(np.int64)], "c": [count[often]]})

    parts = materialize(texts.mapInPandas(local, "n long, h array<long>, c array<long>"))
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    some = parts.select("n", F.explode(F.arrays_zip("h", "c")).alias("_s")).groupBy(F.col("_s.h").alias("h"))
    some = some.agg(F.sum("n").alias("n"), F.sum("_s.c").alias("c"))
    most = F.col("c") + (F.lit(total) - F.col("n")) * listed
    return some.filter(most >= FREQUENT * total * (1 - 1e-9)).select("h"), total


def frequent_shingles(docs: DataFrame, key: str, text: str) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Shingles in at least FREQUENT of all documents with their weight ln(1 + N / df), and the ceiling of the weights.

    A summary of a table, not a step of ``near_duplicates``, which has the document frequencies of all shingles.
    At most (average shingles per document) / FREQUENT shingles can be frequent.
    """
    texts = _texts(docs, key, text)
    wanted, total = frequent_candidates(texts)
    full = math.log1p(1 / FREQUENT)
    candidates = np.sort(np.array([r.h for r in wanted.collect()], np.int64).view(_U))
    if not len(candidates):
        return (candidates, np.zeros(0)), full

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = _shingler(), np.zeros(len(candidates), np.int64)
        for batch in batches:
            for t in batch["text"]:
                found = np.unique(shingler.hashes(t))
                at = np.minimum(np.searchsorted(candidates, found), len(candidates) - 1)
                seen[at[candidates[at] == found]] += 1
        yield pd.DataFrame({"h": candidates.view(np.int64), "df": seen})

    counted = texts.mapInPandas(count, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
    rows = counted.filter(F.col("df") >= FREQUENT * total).collect()
    rows.sort(key=lambda r: r.h & (2**64 - 1))
    shingles = np.array([r.h for r in rows], np.int64).view(_U)
    return (shingles, np.log1p(total / np.array([r.df for r in rows], float))), full


def _band(samples: np.ndarray, band: int) -> int:
    return xxhash.xxh64_intdigest(samples.tobytes(), seed=band) - 2**63


def _can_match(weights: np.ndarray, df: np.ndarray, similarity: float) -> bool:
    """Whether another text can be so similar: at most the share of the weight that shingles of several texts have."""
    return bool((weights[:, df > 1].sum(1) >= (similarity - 1e-4) * weights.sum(1)).any())


def signatures(texts: DataFrame, chunks: int, total: int, similarity: float = SIMILARITY) -> DataFrame:
    """``id, digest, keys (one per band), samples, df`` of each of the ``total`` rows.

    ``samples`` are those of both weightings, ``df`` the document frequencies of the sorted distinct shingles. Texts without
    words, and those that can be similar to no other, have none.
    """

    def sign(pdf: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        shingler = _shingler()
        held = [shingler.counted(t) for t in pdf["text"]]
        df = np.frombuffer(b"".join(counted.sort_values("bucket")["df"]), np.uint32)
        ends = np.cumsum([len(found) for found, _ in held])
        # The chunk's distinct shingles in order, as document_frequencies has them.
        _, place = np.unique(np.concatenate([found for found, _ in held]), return_inverse=True)
        held = [(found, counts, df[at]) for (found, counts), at in zip(held, np.split(place, ends[:-1]), strict=True)]
        keys, samples, kept = [[] for _ in held], [b""] * len(held), [b""] * len(held)
        weights = [weigh(counts, n, total) for _, counts, n in held]
        able = [i for i, w in enumerate(weights) if w.size and _can_match(w, held[i][2], similarity)]
        for at in range(0, len(able), SETS_AT_ONCE):
            some = able[at : at + SETS_AT_ONCE]
            drawn = np.concatenate([sample_many([(held[i][0], weights[i][k]) for i in some]) for k in range(WEIGHTINGS)], axis=1)
            for i, one in zip(some, drawn, strict=True):
                keys[i] = [_band(part, k) for k, part in enumerate(one.reshape(-1, ROWS))]
                samples[i], kept[i] = one.tobytes(), held[i][2].tobytes()
        return pd.DataFrame({"id": pdf["id"], "digest": pdf["digest"], "keys": keys, "samples": samples, "df": kept})

    schema = f"id {texts.schema['id'].dataType.simpleString()}, digest string, keys array<long>, samples binary, df binary"
    counted = document_frequencies(texts, chunks)
    return texts.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInPandas(sign, schema)


def _estimates(samples: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Estimated similarity of each to one: the greater of the weightings' shares of equal samples."""
    return (samples == one).mean(-1).max(-1)


def _forest(samples: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over estimated similarity, by Prim's method; links under TRY_FROM are cut."""
    m = len(samples)
    outside = np.ones(m, bool)
    best = np.full(m, -1.0)
    parent = np.zeros(m, int)
    edges = []
    for _ in range(m):
        at = int(np.argmax(np.where(outside, best, -2)))
        if best[at] >= TRY_FROM:
            edges.append((int(parent[at]), at))
        outside[at] = False
        similar = _estimates(samples, samples[at])
        closer = outside & (similar > best)
        best[closer], parent[closer] = similar[closer], at
    return edges


def _decoded(samples: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(samples), np.int32).reshape(len(samples), WEIGHTINGS, SAMPLES)


def candidate_pairs(signed: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b`` (a < b), and the members ``key, n, parts, part, id`` of all buckets of three or more."""
    rows = signed.select("id", F.explode("keys").alias("key"))
    total = signed.count()
    buckets = materialize(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n > 1")
    )
    pairs = buckets.filter("n = 2 and a < b").select("a", "b")
    larger = buckets.filter("n > 2").select("key", "n")
    members = materialize(skew_join(rows, larger, ["key"], "n", max(1, total * BANDS * WEIGHTINGS), F.col("id"), "inner"))
    parts = F.ceil(F.col("n") / block)
    members = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id", "key", F.lit(0)), parts))
    kind = signed.schema["id"].dataType.simpleString()

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, edges = pdf["id"].to_numpy(), _forest(_decoded(pdf["samples"]))
        degree, reached = np.zeros(len(ids), int), np.arange(len(ids))
        for i, j in edges:  # parents come before children
            degree[[i, j]] += 1
            reached[j] = reached[i]
        out = [(pdf["key"].iloc[0], min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in edges]
        for root in np.unique(reached):  # each tree sends its best linked member to the next level
            tree = np.flatnonzero(reached == root)
            out.append((pdf["key"].iloc[0], ids[tree[np.argmax(degree[tree])]], None))
        return pd.DataFrame(out, columns=["key", "a", "b"]).astype({"a": object, "b": object})

    level, most, depth = members, larger.agg(F.max("n")).first()[0], 0
    while most:
        depth += 1
        blocks = level.join(signed.select("id", "samples"), "id").groupBy("key", "part")
        linked = materialize(blocks.applyInPandas(link, f"key long, a {kind}, b {kind}"))
        pairs = pairs.union(linked.filter("b is not null and a < b").select("a", "b"))
        if most <= block:
            break
        roots = linked.filter(F.col("b").isNull()).select("key", F.col("a").alias("id"))
        sizes = roots.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        sizes = sizes.join(larger.filter(F.col("n") > block).select("key"), "key", "left_semi")
        part = F.pmod(F.xxhash64("id", "key", F.lit(depth)), parts)
        level = materialize(roots.join(sizes, "key").withColumn("part", part))
        now = level.agg(F.max("n")).first()[0]
        if now is not None and now >= most:
            break  # these blocks have nothing in common; links_between_blocks sees the other pairs
        most = now
    return pairs.distinct(), members


def weighted_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, distinct: DataFrame, total: int) -> DataFrame:
    """``id, shingles, weights`` (bytes) of the texts of ``distinct`` whose id is in ``ids``."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = _shingler()
        for batch in batches:
            for at in range(0, len(batch), SETS_AT_ONCE):  # the sets are larger than the texts
                some = batch.iloc[at : at + SETS_AT_ONCE]
                found = [shingler.counted(t) for t in some["text"]]
                weights = [weigh(n, np.frombuffer(df, np.uint32), total) for (_, n), df in zip(found, some["df"], strict=True)]
                yield pd.DataFrame(
                    {"id": some["id"], "shingles": [f.tobytes() for f, _ in found], "weights": [w.tobytes() for w in weights]}
                )

    # Of a key with several texts the one with the least digest; repeated rows are one.
    signed = distinct.filter(F.size("keys") > 0).join(ids, "id", "left_semi")
    signed = signed.groupBy("id").agg(F.min(F.struct("digest", "df")).alias("_s")).select("id", "_s.digest", "_s.df")
    texts = _texts(docs, key, text).join(ids, "id", "left_semi").withColumn("digest", F.sha2("text", 256))
    wanted = texts.join(signed, ["id", "digest"]).groupBy("id").agg(F.min("text").alias("text"), F.min("df").alias("df"))
    kind = docs.schema[key].dataType.simpleString()
    return wanted.mapInPandas(measure, f"id {kind}, shingles binary, weights binary")


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the lesser weights over the sum of the greater, over sorted distinct shingles; of several weightings the most."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.minimum(wa[..., i], wb[..., j]).sum(-1, dtype=np.float64)
    whole = wa.sum(-1, dtype=np.float64) + wb.sum(-1, dtype=np.float64) - common
    return float(np.max(common / whole)) if np.all(whole) else 0.0


def _set(shingles: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(shingles, _U), np.frombuffer(weights, np.float32).reshape(WEIGHTINGS, -1)


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, similarity`` of each pair, exact."""

    @F.pandas_udf("double")
    def similar(a: pd.Series, wa: pd.Series, b: pd.Series, wb: pd.Series) -> pd.Series:
        return pd.Series(
            [weighted_jaccard(*_set(p, q), *_set(r, s)) for p, q, r, s in zip(a, wa, b, wb, strict=True)],
            dtype=float,
        )

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a"), F.col("weights").alias("_wa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b"), F.col("weights").alias("_wb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", similar("_a", "_wa", "_b", "_wb").alias("similarity"))


def components(links: DataFrame) -> DataFrame:
    """``id, label``: the least id of each connected component, for every id that has a link.

    Labels spread to neighbours and then jump to their label's label, so the rounds grow with the logarithm of
    the longest path. A label that a third of all ids have is spread over many tasks.
    """
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = materialize(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("l")).select("id", F.least("id", "l").alias("label")))
    total = max(1, labels.count())
    while True:
        spread = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        near = labels.join(spread, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        near = materialize(near)
        sizes = near.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        jump = sizes.join(near.select(F.col("id").alias("label"), F.col("label").alias("far")), "label")
        found = skew_join(near, materialize(jump), ["label"], "n", total, F.col("id"), "inner")
        new = materialize(found.select("id", "old", F.least("label", "far").alias("label")))
        if new.filter("old != label").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def _link_exactly(ids: np.ndarray, label: np.ndarray, samples: np.ndarray, sets: list[tuple], similarity: float) -> list[tuple]:
    """Links that join parts of a block: pairs of different parts by falling estimate, verified until they meet."""
    part = {x: x for x in label}

    def find(x):
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    likely: list[tuple[np.ndarray, ...]] = []
    for i in range(len(ids) - 1):
        similar = _estimates(samples[i + 1 :], samples[i])
        found = np.flatnonzero((similar >= TRY_FROM) & (label[i + 1 :] != label[i]))
        likely.append((-similar[found], np.full(len(found), i, np.int32), (i + 1 + found).astype(np.int32)))
    out: list[tuple] = []
    if not likely:
        return out
    unlike, first, second = (np.concatenate(column) for column in zip(*likely, strict=True))
    for at in np.argsort(unlike, kind="stable"):  # ties by place
        i, j = first[at], second[at]
        a, b = find(label[i]), find(label[j])
        if a != b and weighted_jaccard(*sets[i], *sets[j]) >= similarity:
            part[a] = b
            out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def links_between_parts(
    signed: DataFrame, members: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float
) -> DataFrame:
    """Verified links ``a, b`` between the parts of those blocks that the first links left in parts.

    At most one less than a block has members; the pairs that were tried stay in the task.
    """
    kind = signed.schema["id"].dataType.simpleString()
    labelled = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_ = labelled.groupBy("key", "part").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y")
    rows = labelled.join(open_.select("key", "part"), ["key", "part"], "left_semi")
    rows = rows.join(signed.select("id", "samples"), "id").join(sets, "id")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        held = [_set(s, w) for s, w in zip(pdf["shingles"], pdf["weights"], strict=True)]
        out = _link_exactly(pdf["id"].to_numpy(), pdf["label"].to_numpy(), _decoded(pdf["samples"]), held, similarity)
        return pd.DataFrame(out, columns=["a", "b"])

    rows = rows.select("key", "part", "id", "label", "samples", "shingles", "weights")
    return rows.groupBy("key", "part").applyInPandas(link, f"a {kind}, b {kind}")


def _open_buckets(labelled: DataFrame) -> DataFrame:
    """``key, n, main, main_parts, rest_parts`` of the buckets ``key, id, label, block`` with several labels."""
    counts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.max("block").alias("block"))
    found = counts.groupBy("key").agg(
        F.sum("c").alias("n"),
        F.max(F.struct("c", "label")).alias("most"),
        F.count(F.lit(1)).alias("labels"),
        F.max("block").alias("block"),
    )
    per_row = 2 / F.col("block")  # parts of half a block, so two of them are one
    return found.filter("labels > 1").select(
        "key",
        "n",
        F.col("most.label").alias("main"),
        F.ceil(F.col("most.c") * per_row).alias("main_parts"),
        F.ceil((F.col("n") - F.col("most.c")) * per_row).alias("rest_parts"),
    )


def _finer_buckets(rows: DataFrame) -> DataFrame:
    """``key, id, label, block`` of every group of samples of every row: keys are those of the bucket and the group."""
    # Pairs to be tried differ in so many samples at most; with one group more, some group has no difference.
    differ = SAMPLES - math.ceil(TRY_FROM * SAMPLES)
    edges = [SAMPLES * i // (differ + 1) for i in range(differ + 2)]
    firsts = range(0, WEIGHTINGS * SAMPLES, SAMPLES)
    groups = [F.substring("samples", 4 * (first + a) + 1, 4 * (b - a)) for first in firsts for a, b in itertools.pairwise(edges)]
    keys = F.array(*[F.xxhash64("key", F.lit(i), group) for i, group in enumerate(groups)])
    return rows.select(F.explode(keys).alias("key"), "id", "label", "block")


def links_between_blocks(
    signed: DataFrame, members: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float
) -> DataFrame | None:
    """Verified links ``a, b`` between the components that are left in buckets of several blocks; None without such.

    Only pairs of different components are looked at: a bucket's members are parted into those of the largest component
    and the rest, and each part of the rest meets every other part in a task of its own, which holds about one block.
    So a bucket costs its size times the number of parts of the rest. Where these are many, the members are bucketed again
    first, by each of some groups of samples: a pair whose estimate reaches TRY_FROM differs in fewer samples than there are
    groups, so in one group at least it agrees wholly.
    """
    kind = signed.schema["id"].dataType.simpleString()
    narrow = signed.select("id", "samples")
    several = members.filter("parts > 1").select("key", "id", F.ceil(F.col("n") / F.col("parts")).alias("block"))
    labelled = materialize(several.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")))
    open_ = materialize(_open_buckets(labelled))
    if open_.isEmpty():
        return None
    wide = open_.filter(F.col("rest_parts") > WIDE).select("key")
    if not wide.isEmpty():
        finer = materialize(_finer_buckets(labelled.join(wide, "key", "left_semi").join(narrow, "id")))
        labelled = labelled.join(wide, "key", "left_anti").unionByName(finer)
        open_ = materialize(open_.filter(F.col("rest_parts") <= WIDE).unionByName(_open_buckets(finer)))
    total = open_.agg(F.sum("n")).first()[0]
    rows = skew_join(labelled.select("key", "id", "label"), open_, ["key"], "n", total or 1, F.col("id"), "inner")
    dealt = F.xxhash64("id", "key", F.lit(-1))
    rows = rows.withColumn("is_rest", F.expr("label != main"))
    rows = rows.withColumn(
        "mine", F.when(F.col("is_rest"), F.pmod(dealt, "rest_parts")).otherwise(F.col("rest_parts") + F.pmod(dealt, "main_parts"))
    )
    # Parts of the rest meet all parts; parts of the largest component have the numbers after them.
    last = F.when(F.col("is_rest"), F.col("rest_parts") + F.col("main_parts")).otherwise(F.col("rest_parts")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "id", "label")

    def likely(pdf: pd.DataFrame) -> pd.DataFrame:
        label, samples = pdf["label"].to_numpy(), _decoded(pdf["samples"])
        wanted = np.zeros(len(pdf), bool)
        for i in range(len(pdf) - 1):
            near = (_estimates(samples[i + 1 :], samples[i]) >= TRY_FROM) & (label[i + 1 :] != label[i])
            wanted[i] |= near.any()
            wanted[i + 1 :] |= near
        return pdf.loc[wanted, ["key", "x", "y", "id", "label"]]

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        held = [_set(s, w) for s, w in zip(pdf["shingles"], pdf["weights"], strict=True)]
        out = _link_exactly(pdf["id"].to_numpy(), pdf["label"].to_numpy(), _decoded(pdf["samples"]), held, similarity)
        return pd.DataFrame(out, columns=["a", "b"])

    rows = rows.join(narrow, "id").groupBy("key", "x", "y").applyInPandas(likely, f"key long, x long, y long, id {kind}, label {kind}")
    rows = materialize(rows).join(narrow, "id").join(sets, "id")
    rows = rows.select("key", "x", "y", "id", "label", "samples", "shingles", "weights")
    return rows.groupBy("key", "x", "y").applyInPandas(link, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``key, class_id, class_size, kept, links``.

    Documents are in one class if a chain of pairs of at least ``similarity`` (weighted Jaccard over TF-IDF
    weighted five-word shingles, by the weights as they are or with a ceiling) connects them; equal texts always are. The class id is its least key, and that
    document stays. ``links`` counts the links to other texts that were verified and hold the class together. Null and empty texts equal each
    other and are near to nothing else; a text under five words is one shingle. Rows that repeat key and text are
    one document, and texts that share a key are in one class. Rows without a key are not compared: each stays,
    with a null class. An empty table gives an empty result.
    """
    nameless = docs.filter(F.col(key).isNull()).select(
        key,
        F.col(key).alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
        F.lit(0).cast("long").alias("links"),
    )
    docs = docs.filter(F.col(key).isNotNull()).select(key, text)
    texts, chunks, total = _in_chunks(docs, key, text)
    signed = materialize(signatures(texts, chunks, total, similarity))
    rows = signed.select("id", "digest")
    copies = materialize(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    firsts = copies.select(F.col("first").alias("id"), "digest")
    distinct = materialize(signed.join(firsts, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]))
    pairs, members = candidate_pairs(distinct.filter(F.size("keys") > 0))
    pairs = materialize(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(members.select("id")).distinct()
    sets = materialize(weighted_sets(docs, materialize(ids), key, text, distinct, total))
    links = materialize(similarities(pairs, sets).filter(F.col("similarity") >= similarity).select("a", "b"))
    more = links_between_parts(distinct, members, components(links), sets, similarity)
    links = materialize(links.union(more).distinct())
    labels = components(links)
    more = links_between_blocks(distinct, members, labels, sets, similarity)
    if more is not None:
        links = materialize(links.union(more).distinct())
        labels = components(links)
    found = _classes(rows, copies, links, labels).select(
        F.col("id").alias(key), "class_id", "class_size", (F.col("id") == F.col("class_id")).alias("kept"), "links"
    )
    return found.union(nameless)


def _classes(rows: DataFrame, copies: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """Carry the labels of the distinct texts to all rows."""
    degree = links.select(F.explode(F.array("a", "b")).alias("first")).groupBy("first").agg(F.count(F.lit(1)).alias("links"))
    named = labels.select(F.col("id").alias("first"), "label")
    table = copies.join(named, "first", "left").join(degree, "first", "left")
    table = table.withColumn("label", F.coalesce("label", "first")).fillna(0, ["links"])
    sizes = table.groupBy(F.col("label").alias("_l")).agg(F.sum("n").alias("class_size"), F.min("first").alias("class_id"))
    table = materialize(table.join(sizes, F.col("label") == F.col("_l")).select("digest", "n", "class_id", "class_size", "links"))
    several = table.filter("n > 1 or class_size > 1 or links > 0")
    total = copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = skew_join(rows, several, ["digest"], "n", total, F.col("id"))
    return joined.select(
        "id",
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce("links", F.lit(0).cast("long")).alias("links"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all columns; documents without a key stay.

    Rows that repeat the key that stays all stay. Null, empty and long texts are as in ``near_duplicates``; an empty table
    stays empty.
    """
    dropped = materialize(near_duplicates(docs, key, text).filter("not kept").select(F.col(key).alias("_key")))
    return docs.join(dropped, docs[key] == dropped["_key"], "left_anti")
