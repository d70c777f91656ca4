"""Maximal repeats of the whole corpus from the interval trees of enhanced suffix arrays.

Where a repeat of ``length`` bytes may lie, and what must be compared with what, follows from window codes:

1. The code of a window of ``length`` bytes is the least hash of its grams, so equal windows have equal codes. Windows that
   follow each other and share a code are a piece of text, about ``1.4 * length`` bytes long. Pieces overlap by all but one byte of
   a window, so that no window is lost.
2. Pieces whose code occurs once, at one place of one text, hold no repeat and go. Equal pieces, by code and digest (128 bits in all), are one piece with
   many places; such a piece is a repeat as a whole.
3. Different pieces of one code meet in one task. Their suffixes are sorted to an enhanced suffix array (order,
   longest common prefixes, symbols to the left), and one scan with a stack goes through the tree of its
   common-prefix intervals. An interval whose suffixes have different left symbols is a maximal repeat, with all its
   occurrences. Where a piece begins, the symbol is one that nothing else has: what goes on to the left is in the piece before.
4. A code with too many different pieces for one task (a line that a third of all texts hold) is left out of
   consideration with all grams that many of its pieces hold, and its pieces are coded anew by their other grams, until the
   groups are small. Windows of such grams alone keep their least gram as their code.

Memory follows the bounded groups of step 3, and nothing reaches the driver.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.sources.scratch import materialize

LENGTH = 200
LONGEST_PIECE = 1024  # windows
GROUP = 2000  # different pieces of one code that one task compares
DEEPEST = 24  # times that a group is coded anew
COUNTED = 2000  # different pieces of a large group whose grams are counted, or as many as a group may have
OFTEN = 8  # of them that hold a gram that may be left out
BATCH_BYTES = 1 << 20  # pieces in one suffix array, if the group itself is not larger

_U = np.uint64
_FIRST = 7  # symbols of nine bits in the first ranks
_DIVERSE = -1
PIECE = "row long, start long, windows long, code long, again boolean, digest long"
SPAN = "row long, first long, last long"


def _gram(length: int) -> int:
    """The largest power of two up to a third of the window."""
    return 1 << (max(1, length // 3).bit_length() - 1)


@functools.lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], _U)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    out, width, step = _byte_codes()[data], 1, 0x9E3779B97F4A7C15
    while width < gram:
        out = out[:-width] * _U(step) + out[width:]
        width, step = 2 * width, step * step % 2**64
    out ^= out >> _U(32)
    out *= _U(0xBF58476D1CE4E5B9)
    return out ^ (out >> _U(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return values if reach == width else np.minimum(values[: reach - width], values[width - reach :])


def cut_pieces(data: np.ndarray, length: int, excluded: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows and code of each piece, and whether its code's gram recurs in the text.

    Excluded grams are codes of those windows only that have no others.
    """
    gram = _gram(length)
    hashes, width = _gram_hashes(data, gram), length - gram + 1
    if len(excluded):
        others = np.where(np.isin(hashes, excluded), _U(2**64 - 1), hashes)
        codes = _least(others, width)
        codes = np.where(codes == _U(2**64 - 1), _least(hashes, width), codes)
    else:
        codes = _least(hashes, width)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    distinct = np.unique(codes[starts])
    low = hashes[hashes <= distinct[-1]]  # few
    counts = np.bincount(np.searchsorted(distinct, low[np.isin(low, distinct)]), minlength=len(distinct))
    again = counts[np.searchsorted(distinct, codes[starts])] > 1
    counts = np.diff(np.append(starts, len(codes)))
    parts = -(-counts // LONGEST_PIECE)
    if parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + nth * LONGEST_PIECE
        counts = np.diff(np.append(starts, len(codes)))
        again = np.repeat(again, parts)
    return starts, counts, codes[starts], again


class SuffixArray:
    """The windows' suffixes of several pieces, sorted, each ending with its piece.

    ``order`` has their places in the joined pieces, ``common`` the length of the common prefix of each and the next, 0
    if under ``length``.
    """

    def __init__(self, pieces: list[bytes], length: int) -> None:
        self.length = length
        sizes = np.array([len(p) for p in pieces])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.rest = np.repeat(self.ends, sizes) - np.arange(len(self.data))
        ranks = self._ranks(int(sizes.max()))
        windows = np.flatnonzero(self.rest >= length)
        self.order = windows[np.argsort(ranks[-1][1][windows])]
        self.common = self._common(ranks)

    def _ranks(self, longest: int) -> list[tuple[int, np.ndarray]]:
        """Ranks of what begins at each place, by width; past the end of a piece there is nothing, rank 0."""
        symbols = np.append(self.data.astype(_U) + _U(1), np.zeros(_FIRST, _U))
        n = len(self.data)
        key = np.zeros(n, _U)
        for i in range(_FIRST):
            key = (key << _U(9)) | np.where(self.rest > i, symbols[i : i + n], _U(0))
        ranks = [(_FIRST, np.unique(key, return_inverse=True)[1] + 1)]
        while ranks[-1][0] < longest:
            width, rank = ranks[-1]
            after = np.zeros(n, np.int64)
            inside = np.flatnonzero(self.rest > width)
            after[inside] = rank[inside + width]
            ranks.append((2 * width, np.unique(rank * (n + 1) + after, return_inverse=True)[1] + 1))
        return ranks

    def _common(self, ranks: list[tuple[int, np.ndarray]]) -> np.ndarray:
        a, b = self.order[:-1], self.order[1:]
        some = np.ones(len(a), bool)
        fitting = [(width, rank) for width, rank in ranks if width <= self.length]
        for width, rank in fitting[-1:]:  # two overlapping ranks tell whether whole windows are equal
            last = self.length - width
            some = rank[a] == rank[b]
            if last <= width:
                some &= rank[a + last] == rank[b + last]
        at = np.flatnonzero(some)
        a, b = a[at], b[at]
        limit = np.minimum(self.rest[a], self.rest[b])
        size, top = np.zeros(len(a), np.int64), len(self.data) - 1
        for width, rank in reversed(ranks):
            equal = (size < limit) & (rank[np.minimum(a + size, top)] == rank[np.minimum(b + size, top)])
            size += width * equal
        going = np.ones(len(a), bool)
        for _ in range(_FIRST - 1):
            going &= (size < limit) & (self.data[np.minimum(a + size, top)] == self.data[np.minimum(b + size, top)])
            size += going
        size = np.minimum(size, limit)
        common = np.zeros(max(0, len(self.order) - 1), np.int64)
        common[at] = np.where(size >= self.length, size, 0)
        return common

    def maximal_repeats(self) -> list[tuple[int, int, int]]:
        """``(length, i, j)`` of each maximal repeat: it occurs at ``order[i:j]`` and nowhere else.

        One scan with a stack: an entry is an interval that is still open, with the symbol to the left of its
        suffixes as long as they have the same.
        """
        near = np.append(self.common, 0) + np.append(0, self.common)
        shared = np.flatnonzero(near)  # the others share no window
        place = self.order[shared]
        left = np.where(np.isin(place, self.starts), -2 - place, self.data[place - 1].astype(np.int64)).tolist()
        common = np.append(self.common, 0)[shared].tolist()
        found: list[tuple[int, int, int]] = []
        stack: list[list[int]] = []  # common length, first suffix, left symbol
        for k, size in enumerate(common):
            first, symbol = k, left[k]
            while stack and stack[-1][0] > size:
                deep, first, other = stack.pop()
                if other != symbol:
                    symbol = _DIVERSE
                if symbol == _DIVERSE:
                    found.append((deep, int(shared[first]), int(shared[k]) + 1))
            if stack and stack[-1][0] == size:
                if stack[-1][2] != symbol:
                    stack[-1][2] = _DIVERSE
            elif size:
                stack.append([size, first, symbol])
        return found

    def covered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, first and last byte (in the piece, last exclusive) of the stretches that maximal repeats cover."""
        reach = np.zeros(len(self.order), np.int64)
        for size, i, j in self.maximal_repeats():
            np.maximum(reach[i:j], size, out=reach[i:j])
        edges = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(edges, self.order, reach > 0)
        np.add.at(edges, (self.order + reach)[reach > 0], -1)
        inside = np.cumsum(edges[:-1]) > 0
        starts_here, ends_here = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
        starts_here[self.starts], ends_here[self.ends - 1] = True, True
        first = np.flatnonzero(inside & (starts_here | ~np.append(False, inside[:-1])))
        last = np.flatnonzero(inside & (ends_here | ~np.append(inside[1:], False))) + 1
        piece = np.searchsorted(self.ends, first, side="right")
        return piece, first - self.starts[piece], last - self.starts[piece]


def _index(texts: DataFrame, length: int) -> DataFrame:
    """The pieces of all texts ``row, text, excluded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for row, value, excluded in zip(batch["row"].to_pylist(), batch["text"], batch["excluded"], strict=True):
                text = value.as_py()
                if len(text) < length:
                    continue
                without = np.array(excluded.as_py(), np.int64).view(_U)
                starts, counts, codes, again = cut_pieces(np.frombuffer(text, np.uint8), length, without)
                ends = (starts + counts + length - 1).tolist()
                digests = [xxhash.xxh3_64_intdigest(text[i:j]) for i, j in zip(starts.tolist(), ends, strict=True)]
                coded, digested = codes.view(np.int64), np.array(digests, _U).view(np.int64)
                out.append((np.full(len(starts), row), starts, counts, coded, again, digested))
            if out:
                columns = [pa.array(np.concatenate(column)) for column in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "start", "windows", "code", "again", "digest"])

    return texts.select("row", "text", "excluded").mapInArrow(run, PIECE)


def _bodies(texts: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    """The text of each piece beside its columns, and the codes that were excluded when it was cut, with its own."""
    wanted = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "windows", "code", "again", "digest", "n", "kinds")).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, excluded, value, found in zip(
                batch["row"].to_pylist(), batch["excluded"].to_pylist(), batch["text"], batch["pieces"], strict=True
            ):
                text, rows = value.as_py(), found.as_py()
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "row": row,
                            **p,
                            "excluded": [*excluded, p["code"]],
                            "text": text[p["start"] : p["start"] + p["windows"] + length - 1],
                        }
                        for p in rows
                    ],
                    schema=arrow,
                )

    schema = f"{PIECE}, n long, kinds long, excluded array<long>, text binary"
    arrow = texts.sparkSession.createDataFrame([], schema).toArrow().schema
    return texts.join(wanted, "row").select("row", "excluded", "text", "pieces").mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of sorted batches in lists of whole codes (the last column) of about BATCH_BYTES of text (the first)."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*[batch[name].to_pylist() for name in columns], strict=True):
            if held and row[-1] != held[-1][-1] and size >= BATCH_BYTES:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[0])
    if held:
        yield held


def _by_code(bodies: DataFrame) -> DataFrame:
    return bodies.repartition(F.col("code")).sortWithinPartitions("code")


def _search_spans(bodies: DataFrame, length: int) -> DataFrame:
    """What maximal repeats cover in pieces with one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["text", "row", "start", "n", "code"]):
            texts, row, start, n, _ = zip(*group, strict=True)
            piece, first, last = SuffixArray(list(texts), length).covered()
            alone = np.array(n)[piece] == 1
            piece, first, last = piece[alone], first[alone], last[alone]
            at = np.array(start)[piece]
            columns = [np.array(row)[piece], at + first, at + last]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "first", "last"])

    return _by_code(bodies).select("text", "row", "start", "n", "code").mapInArrow(run, SPAN)


def _search_repeats(bodies: DataFrame, length: int) -> DataFrame:
    """Occurrences ``repeat, size, code, digest, at`` of all maximal repeats, by piece and place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["repeat", "size", "code", "digest", "at"]
        for group in _groups(batches, ["text", "digest", "code"]):
            texts, digest, code = zip(*group, strict=True)
            array = SuffixArray(list(texts), length)
            digests, codes = np.array(digest), np.array(code)
            for size, i, j in array.maximal_repeats():
                place = array.order[i:j]
                piece = np.searchsorted(array.ends, place, side="right")
                name = xxhash.xxh3_64_intdigest(array.data[place[0] : place[0] + size].tobytes())
                same = [np.full(j - i, value) for value in (np.array(name, _U).view(np.int64), size)]
                columns = [*same, codes[piece], digests[piece], place - array.starts[piece]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "repeat long, size long, code long, digest long, at long"
    return _by_code(bodies).select("text", "digest", "code").mapInArrow(run, schema)


def _repeats(texts: DataFrame, length: int, group: int, depth: int = 0) -> list[DataFrame]:
    """Tables ``repeat, size, row, start`` of the occurrences of all maximal repeats of ``row, text, excluded``."""
    pieces, kinds = _repeated_pieces(texts, length)
    several = pieces.join(kinds.filter("n > 1").select("code", "digest"), ["code", "digest"], "left_semi")
    found = [several.select(F.col("digest").alias("repeat"), (F.col("windows") + length - 1).alias("size"), "row", "start")]
    small, large = _different_pieces(texts, kinds, length, group, depth)
    in_pieces = [_search_repeats(small, length)]
    if large is not None:
        places = large.select("id", "code", "digest")
        for part in _repeats(_as_texts(large, length, group), length, group, depth + 1):
            part = part.select("repeat", "size", F.col("row").alias("id"), F.col("start").alias("at"))
            in_pieces.append(part.join(places, "id").select("repeat", "size", "code", "digest", "at"))
    for part in in_pieces:
        placed = part.join(pieces.select("code", "digest", "row", "start"), ["code", "digest"])
        found.append(placed.select("repeat", "size", "row", (F.col("start") + F.col("at")).alias("start")))
    return found


def _spans(texts: DataFrame, length: int, group: int, depth: int = 0) -> list[DataFrame]:
    """Tables ``row, first, last`` that together cover what is repeated in ``row, text, excluded``; they may overlap."""
    pieces, kinds = _repeated_pieces(texts, length)
    several = pieces.join(kinds.filter("n > 1").select("code", "digest"), ["code", "digest"], "left_semi")
    found = [several.select("row", F.col("start").alias("first"), (F.col("start") + F.col("windows") + length - 1).alias("last"))]
    small, large = _different_pieces(texts, kinds, length, group, depth)
    found.append(_search_spans(small, length))
    if large is not None:
        inner = [part.withColumnRenamed("row", "id") for part in _spans(_as_texts(large, length, group), length, group, depth + 1)]
        places = large.filter("n = 1").select("id", "row", "start")
        shifted = [F.col("start") + F.col(name) for name in ("first", "last")]
        found += [part.join(places, "id").select("row", shifted[0].alias("first"), shifted[1].alias("last")) for part in inner]
    return found


def _repeated_pieces(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The pieces whose code occurs again, and one row per different piece with its places' number and the first of them."""
    pieces = materialize(_index(texts, length))
    again = F.max("again").alias("again")
    codes = pieces.groupBy("code").agg(F.count(F.lit(1)).alias("n"), again).filter("n > 1 or again").select("code")
    pieces = materialize(pieces.join(codes, "code", "left_semi"))
    first = F.min(F.struct("row", "start", "windows")).alias("_p")
    kinds = pieces.groupBy("code", "digest").agg(F.count(F.lit(1)).alias("n"), again, first)
    return pieces, materialize(kinds.select("code", "digest", "n", "again", "_p.*"))


def _different_pieces(
    texts: DataFrame, kinds: DataFrame, length: int, group: int, depth: int
) -> tuple[DataFrame, DataFrame | None]:
    """The text of one place of each piece that may share strings with others or itself: of small groups, and of large ones."""
    counts = kinds.groupBy("code").agg(F.count(F.lit(1)).alias("kinds"), F.max("again").alias("own"))
    counts = counts.filter("kinds > 1 or own").select("code", "kinds")
    bodies = materialize(_bodies(texts, kinds.join(counts, "code"), length), compression="zstd")
    # A code that comes again cannot be split any more: its pieces are made of crowded grams alone.
    again = F.array_contains(F.slice("excluded", F.lit(1), F.size("excluded") - 1), F.col("code"))
    is_large = (F.col("kinds") > group) & ~again & F.lit(depth < DEEPEST)
    large = bodies.filter(is_large)
    if large.isEmpty():
        return bodies, None
    return bodies.filter(~is_large), materialize(large.withColumn("id", F.monotonically_increasing_id()), compression="zstd")


def _crowded_grams(large: DataFrame, length: int, group: int) -> DataFrame:
    """``code, crowded``: the grams that more than half a group of the different pieces of a large group hold, by estimate.

    They are counted in some pieces of each group, chosen by digest. Whatever the list has, nothing is lost: all pieces of
    a group are coded without the same grams.
    """
    rate = F.ceil(F.col("kinds") / max(group, COUNTED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], list[np.ndarray]] = {}
            columns = [batch[name].to_pylist() for name in ("text", "code", "rate")]
            for text, *name in zip(*columns, strict=True):
                grams = np.unique(_gram_hashes(np.frombuffer(text, np.uint8), _gram(length)))
                found.setdefault(tuple(name), []).append(grams)
            for (code, times), held in found.items():
                grams, n = np.unique(np.concatenate(held), return_counts=True)
                columns = [np.full(len(n), code), np.full(len(n), times), grams.view(np.int64), n]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["code", "rate", "gram", "n"])

    some = large.withColumn("rate", rate).filter(F.pmod(F.xxhash64("digest"), "rate") == 0).select("text", "code", "rate")
    counts = some.mapInArrow(run, "code long, rate long, gram long, n long").groupBy("code", "rate", "gram").agg(F.sum("n").alias("n"))
    crowded = counts.filter((F.col("n") >= OFTEN) & (2 * F.col("n") * F.col("rate") > group))
    return crowded.groupBy("code").agg(F.collect_set("gram").alias("crowded"))


def _as_texts(large: DataFrame, length: int, group: int) -> DataFrame:
    """The pieces of large groups as texts, with all grams that they are to be coded without."""
    texts = large.join(materialize(_crowded_grams(large, length, group)), "code", "left")
    excluded = F.array_union("excluded", F.coalesce("crowded", F.array().cast("array<long>")))
    return texts.select(F.col("id").alias("row"), "text", excluded.alias("excluded"))


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` by row number; reading the table again must give the same order, as files do."""
    whole = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), whole.alias("text"), F.array().cast("array<long>").alias("excluded")
    )


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``row, first, last``: stretches of bytes that strings of ``length`` bytes which occur again cover, as found, not joined.

    ``row`` numbers the rows of ``docs`` as ``monotonically_increasing_id`` does.
    """
    found = _spans(_numbered(docs, text), length, group)
    return functools.reduce(DataFrame.union, found)


def repeat_groups(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """All occurrences ``repeat, size, row, start`` of the maximal repeats of at least ``length`` bytes.

    Rows with equal ``repeat`` (a digest of the string) and ``size`` are the occurrences of one string. Strings are maximal
    within pieces: a longer one is a chain of pieces that overlap by ``length - 1`` bytes. ``row`` is as in ``repeated_spans``.
    """
    found = _repeats(_numbered(docs, text), length, group)
    return functools.reduce(DataFrame.union, found).distinct()


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP
) -> DataFrame:
    """What is left of each text without the bytes that belong to a string of ``length`` bytes which occurs again.

    Returns ``key, n_bytes, n_removed, n_spans, kept`` (binary) for every row of ``docs``. Texts are bytes in UTF-8, and a
    string occurs again if it begins at any other byte of any text, its own included; matches never cross texts.
    Whether a string is repeated is judged on the input. Null texts count as empty; null keys and repeated rows are
    documents of their own (and copies remove each other wholly, if long enough). Texts of any length are searched
    whole; other columns are ignored; an empty table gives an empty result. ``docs`` must read alike each time.
    """
    kind = docs.schema[key].dataType.simpleString()
    spans = repeated_spans(docs, text, length, group).groupBy("row")
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, value, found in zip(batch["key"].to_pylist(), batch["text"], batch["spans"].to_pylist(), strict=True):
                whole, kept, at, runs = value.as_py(), [], 0, 0
                for span in found or ():
                    if span["first"] > at or not runs:
                        kept.append(whole[at : span["first"]])
                        runs += 1
                    at = max(at, span["last"])
                kept.append(whole[at:])
                rest = b"".join(kept)
                out.append((k, len(whole), len(whole) - len(rest), runs, rest))
            columns = zip(*out, strict=True) if out else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    joined = rows.join(spans, "row", "left").select("key", "text", "spans")
    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)


def removal_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``remove_repeats`` with the digest of what is left instead of the bytes."""
    left = remove_repeats(docs, key, text)
    return left.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
