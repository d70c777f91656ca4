"""Runs of repeated word sequences, found by an online sparse diagonal program.

Read the comparison of a text with itself as a matrix: a word and an earlier equal word, ``lag`` words before, is a cell
on the diagonal of that lag. A stretch of period q is a streak of cells on diagonal q, three times as long as q or more.
Going through the words in order, the cells at each word lengthen the streaks of their diagonals, and a streak that gets
no cell ends and, if long enough, is a run.

What keeps it sparse: a streak on a diagonal from ``b`` to ``2 b - 1`` is at least ``3 b`` cells long, so only earlier
occurrences of the ``3 b`` words that begin at a word can begin or carry one on, and of these only the nearest. (If two
lags up to 2 b carry the same 3 b words, their greatest common divisor is a period too, by the theorem of Fine and Wilf;
then no lag but the nearest can be the smallest period.) So a word has at most one cell for each power of two, and
ordinary prose has almost none. Words are compared by number, not by hash: the result is exact.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run has at least this many words, and at least this many periods.
SHORTEST, PERIODS = 6, 4

Run = tuple[int, int, int]  # start, length, period
Words = list[bytes]


def _numbered(words: Words) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(word, len(known)) for word in words], np.int64)


def _pairs(ranks: np.ndarray, apart: int) -> np.ndarray:
    """A number for each pair of ranks so far apart, the same for equal pairs."""
    return ranks[: len(ranks) - apart] * (ranks.max() + 1) + ranks[apart:]


def _nearest_lag(grams: np.ndarray) -> np.ndarray:
    """Distance to the nearest earlier equal gram; 0 without one."""
    order = np.argsort(grams, kind="stable")
    again = grams[order[1:]] == grams[order[:-1]]
    lag = np.zeros(len(grams), np.int64)
    lag[order[1:][again]] = (order[1:] - order[:-1])[again]
    return lag


def _gram_length(base: int) -> int:
    """Cells that any streak on the diagonals from ``base`` to ``2 * base - 1`` has at least."""
    return max(SHORTEST - base, (PERIODS - 1) * base)


def _cells(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Places and lags of the cells that can be part of a run, by place."""
    n, base, width, ranks, found = len(numbers), 1, 1, numbers, []
    while PERIODS * base <= n and _gram_length(base) < n:
        length = _gram_length(base)
        while 2 * width <= length:
            ranks = np.unique(_pairs(ranks, width), return_inverse=True)[1]
            width *= 2
        lag = _nearest_lag(_pairs(ranks, length - width) if length > width else ranks)
        if not lag.any():
            break  # no longer gram can occur twice either
        at = np.flatnonzero((lag >= base) & (lag < 2 * base))
        found += zip(at.tolist(), lag[at].tolist(), strict=True)
        base *= 2
    return sorted(found)


def runs_of(words: Words) -> list[Run]:
    """All runs ``(start, length, period)`` by start, then period.

    A run is a stretch of words with smallest period q of at least SHORTEST words and PERIODS periods that no
    neighbouring word extends.
    """
    if len(words) < SHORTEST:
        return []
    runs: list[Run] = []
    active: dict[int, tuple[int, int]] = {}  # lag: first and last place of its streak of cells

    def end(lag: int) -> None:
        first, last = active.pop(lag)
        cells = last - first + _gram_length(1 << (lag.bit_length() - 1))
        if cells + lag >= max(SHORTEST, PERIODS * lag):
            runs.append((first - lag, cells + lag, lag))

    for place, lag in _cells(_numbered(words)):
        for ended in [q for q, (_, last) in active.items() if last < place - 1]:
            end(ended)
        first, _ = active.get(lag, (place, place))
        active[lag] = first, place
    for lag in list(active):
        end(lag)
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapsed(words: Words, runs: list[Run]) -> Words:
    """The words without those that a run repeats: of each run the first period stays."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def planted(key: object, words: Words) -> Words:
    """The words of a document, in a tenth of all keys with a periodic end; a null key changes nothing."""
    if key is None or not words:
        return words
    code, n = zlib.crc32(str(key).encode()), len(words)
    if code % 10:
        return words
    g = code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _over_texts(docs: DataFrame, key: str, text: str, each: Callable, schema: str) -> DataFrame:
    """Rows that ``each`` makes of (key, words) as lists of columns; keys never leave Arrow as floating point."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (value.as_py().split() for value in batch["text"])
            out = [row for k, words in zip(batch["key"].to_pylist(), texts, strict=True) for row in each(k, words)]
            columns = list(zip(*out, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    empty = docs.sparkSession.createDataFrame([], f"key {kind}, {schema}").toArrow().schema
    names, types = empty.names, empty.types
    return rows.mapInArrow(run, f"key {kind}, {schema}").withColumnRenamed("key", key)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per run: ``key, start, length, period``, in words counted from 0.

    Words are what white space separates. Null and empty texts have no runs; a text of any length is searched whole;
    rows that repeat are searched one by one; rows without a key are searched too. Other columns are ignored, and an
    empty table gives an empty result.
    """

    def each(k: object, words: Words) -> list[tuple]:
        return [(k, *run) for run in runs_of(words)]

    return _over_texts(docs, key, text, each, "start long, length long, period long")


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text``: the words of each text joined by one space, every run cut down to its first period.

    One row per row of ``docs``, null keys and repeated rows included; a null text becomes empty.
    """

    def each(k: object, words: Words) -> list[tuple]:
        return [(k, b" ".join(collapsed(words, runs_of(words))).decode())]

    return _over_texts(docs, key, text, each, "text string").withColumnRenamed("text", text)


def run_report(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words_of: Callable[[object, Words], Words] = lambda key, words: words,
) -> DataFrame:
    """Digest of the runs of each row of ``docs``.

    ``key, n_runs``; ``start, length, period, exponent_milli`` of the longest run (ties: the first start, then the
    smallest period; null without a run); ``runs_sha256`` of all runs as lines, and ``collapsed_sha256`` of the text
    that ``collapse_runs`` gives. ``words_of`` may change a document's words first, as ``planted`` does. Nulls, long texts, repeated rows,
    other columns and empty tables are as in ``find_runs``.
    """

    def each(k: object, words: Words) -> list[tuple]:
        words = words_of(k, words)
        runs = runs_of(words)
        start, length, period = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
        rest = b" ".join(collapsed(words, runs))
        milli = 1000 * length // period if runs else None
        return [(k, len(runs), start, length, period, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(rest).hexdigest())]

    schema = (
        "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
    return _over_texts(docs, key, text, each, schema)
