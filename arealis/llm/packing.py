"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

The packing depends on lengths only, and there are at most ``capacity`` of them, so it is planned on the histogram of
all piece lengths: a bin is filled greedily with the largest piece that fits, then its smallest piece gives way
to the two unpacked pieces that fill the bin most tightly. The same bin is repeated as often as its pieces last,
which is what the sequential method would do. A step uses up a length, or leaves fewer pieces of it than a bin takes,
which then go into one more pattern: the plan has a few patterns per length at most, whatever the corpus. The pieces find their places by their rank among equal lengths.
"""

from __future__ import annotations

import base64
import functools
import json
import math
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import keep_cache
from arealis.sources.scratch import materialize

CAPACITY = 2048
SEPARATOR = 0
CACHE_WORDS = 800_000
# Longer parts, as whole paragraphs of scripts that are written without spaces, are not kept.
CACHED_CHARS = 32
DOCS_AT_ONCE = 256

# A space before a word character always begins a token of a byte-level BPE with the usual splitting pattern.
CUT = re.compile(r" (?=\w)")
# With other white space behind it, or at the end, a space may belong to the token before.
ODD = re.compile(r" (?:\s|\Z)")


def added_tokens(ranks: str) -> dict[str, int]:
    """The tokens that the full tokenizer, the .json file beside the rank file, finds before it splits a text."""
    found = json.loads(Path(ranks).with_suffix(".json").read_text(encoding="utf-8"))["added_tokens"]
    if odd := [token["content"] for token in found if token["lstrip"] or token["rstrip"] or token["single_word"]]:
        raise ValueError(f"added tokens that depend on their surroundings: {odd}")
    return {token["content"]: token["id"] for token in found}


class _Ids(dict):
    """The ids of parts of texts, as bytes, each encoded behind ``before``; those of short parts are kept."""

    def __init__(self, encode: Callable[[str], list[int]], before: str) -> None:
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encode(self.before + part)).tobytes()
        if len(part) <= CACHED_CHARS:
            self[part] = ids
        return ids


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes; the ids of frequent words are kept.

    ``ranks`` is the file of a byte-level BPE's tokens in the order of their ids. It gives the ids of the
    same vocabulary's full tokenizer, four times as fast for words not met before. Texts are parted at the full
    tokenizer's added tokens first, as it does; what lies between them is encoded by itself.
    """

    def __init__(self, ranks: str, pattern: str, cache_words: int = CACHE_WORDS):
        import tiktoken

        with open(ranks, "rb") as lines:
            tokens = {base64.b64decode(token): int(id_) for token, id_ in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=tokens, special_tokens={})
        self.added = {token: array("I", [id_]).tobytes() for token, id_ in added_tokens(ranks).items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.first = _Ids(self.bpe.encode_ordinary, "")
        self.rest = _Ids(self.bpe.encode_ordinary, " ")
        self.cache_words = cache_words

    def clear(self) -> None:
        self.first.clear()
        self.rest.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self.first, self.rest):
            if len(known) > self.cache_words:
                known.clear()
        out = []
        for text in texts:
            if any(token in text for token in self.added):
                spans = self.at_added.split(text)
                out.append(b"".join([self.added[span] if span in self.added else self._plain(span) for span in spans]))
            else:
                out.append(self._plain(text))
        return out

    def _plain(self, text: str) -> bytes:
        """A text is cut at spaces that begin a token; the space goes with the part behind it."""
        if ODD.search(text):
            first, *rest = CUT.split(text)
        else:
            first, *rest = text.split(" ")  # each space stands alone and is followed by no white space
        return self.first[first] + b"".join(map(self.rest.__getitem__, rest))


@functools.lru_cache(maxsize=2)
def _one_encoder(ranks: str, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def _encoder(ranks: str, pattern: str) -> Encoder:
    encoder = _one_encoder(ranks, pattern)
    keep_cache(f"encoder of {ranks}", encoder.clear)
    return encoder


def pieces(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise every row: ``row, key, piece, start, length, ids``.

    A null text is empty. A document is its tokens and the separator; only one longer than ``capacity`` is cut,
    and of its pieces only the first may be shorter. ``ids`` are little-endian unsigned 32-bit bytes.
    """

    kind = docs.schema[key].dataType.simpleString()
    schema = f"row long, key {kind}, piece int, start long, length long, ids binary"
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        end = np.array([SEPARATOR], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                some = batch.slice(at, DOCS_AT_ONCE)
                out = []
                columns = some["row"].to_pylist(), some["key"].to_pylist(), encoder.encode(some["text"].to_pylist())
                for row, id_, ids in zip(*columns, strict=True):
                    ids += end
                    n = len(ids) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        out.append((row, id_, i, a, b - a, ids[4 * a : 4 * b]))
                found = zip(zip(*out, strict=True), arrow, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in found], schema=arrow)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.mapInArrow(cut, schema)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-two-fit over a histogram of lengths: ``[(bins, [(length, pieces per bin), ...]), ...]``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return patterns
        taken: dict[int, int] = {}
        gap = capacity
        at = len(lengths)
        while gap and (at := int(np.searchsorted(lengths[:at], gap, "right"))):
            length = int(lengths[at - 1])
            taken[length] = min(int(left[length]), gap // length)
            gap -= length * taken[length]
            at -= 1
        if gap and taken:
            _replace_smallest(taken, left, gap)
        bins = min(int(left[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            left[length] -= bins * n
        patterns.append((bins, sorted(taken.items(), reverse=True)))


def _replace_smallest(taken: dict[int, int], left: np.ndarray, gap: int) -> None:
    """Put two unpacked pieces in the place of the bin's smallest if they fill the bin more tightly."""
    smallest = min(taken)
    room = smallest + gap
    free = left[: room + 1].copy()
    for length, n in taken.items():
        if length <= room:
            free[length] -= n
    lengths = np.flatnonzero(free)
    first = lengths[lengths <= room // 2]
    if not len(first):
        return
    at = np.searchsorted(lengths, room - first, "right") - 1
    at -= (lengths[at] == first) & (free[first] < 2)  # a single piece cannot be used twice
    second = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
    total = np.where(second > 0, first + second, 0)
    best = int(np.argmax(total))
    if total[best] > smallest:
        taken[smallest] -= 1
        if not taken[smallest]:
            del taken[smallest]
        for length in (int(first[best]), int(second[best])):
            taken[length] = taken.get(length, 0) + 1


def _places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows ``length, first rank, pieces per bin, first bin, first offset``, sorted by length and rank."""
    rank: dict[int, int] = {}
    rows, first_bin = [], 0
    for bins, contents in patterns:
        offset = 0
        for length, n in contents:
            rows.append((length, rank.get(length, 0), n, first_bin, offset))
            rank[length] = rank.get(length, 0) + bins * n
            offset += length * n
        first_bin += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pack all rows: ``key, piece, start, length, ids_crc32, sequence_id, offset, ids``, one row per
    piece.

    Sequences hold at most ``capacity`` tokens, gapless from offset 0. Rows that repeat a key are documents of
    their own; null keys stay null. An empty table gives no rows; an empty text is one separator. Extra columns
    of ``docs`` are ignored. The driver sees one count per length, at most ``capacity`` rows.
    """
    cut = materialize(pieces(docs, ranks, pattern, key, text, capacity), compression="zstd")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan_bins(counts, capacity))
    slices = max(1, math.isqrt(sum(counts.values())))
    # Rank among equal lengths in two levels: a length may hold a third of all pieces.
    narrow = cut.select("row", "piece", "length").withColumn("_slice", F.pmod(F.xxhash64("row", "piece"), F.lit(slices)))
    per_slice = narrow.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("length", "_slice").orderBy("row", "piece"))
    ranked = narrow.withColumn("_rank", inside - 1).join(starts, ["length", "_slice"])

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        order = (places[:, 0] << 48) + places[:, 1]
        row = places[np.searchsorted(order, (size << 48) + at, "right") - 1]
        nth = at - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + nth // row[:, 2], "offset": row[:, 4] + nth % row[:, 2] * size})

    placed = ranked.select("row", "piece", place("length", F.col("_start") + F.col("_rank")).alias("_at"))
    # The digest is taken before the join: who does not ask for the ids does not shuffle them.
    return cut.withColumn("ids_crc32", F.crc32("ids")).join(placed, ["row", "piece"]).select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset", "ids"
    )


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per sequence: ``sequence_id, length``, the keys in it in order, and the ids of its pieces in order.

    A sequence has a bounded number of tokens, and so of pieces; null keys are listed as null, an empty table gives no rows.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(key).alias("key"), "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts")).select(
        "sequence_id", "length", F.col("_parts.key").alias("keys"), F.col("_parts.ids").alias("ids")
    )
