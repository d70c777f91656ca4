"""What each of five filters removes in every order of applying them, duplicates found by radix tries.

1. Every text gets a mask of the filters it fails by itself. Copies combine where they are read: a task keeps a trie of
   the texts it has seen, and only the least id per text goes on undecided; greater ids are duplicates already. So a
   text that holds a third of all rows leaves a task as one row for each trie.
2. Prefixes adapt to the texts: a prefix under which more than a share of a partition lies is made longer until
   it parts. Undecided texts are range-partitioned by prefix.
3. A task inserts the whole texts of one prefix after another into a compressed trie that holds the least id at each
   terminal, and traverses it for the duplicate flags.
4. Masks are counted per part; all orders and the Shapley sums follow from the 32 counts of a part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.sources.scratch import materialize

FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]

# Limits of the filters: fixed values.
FEWEST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"

CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATIONS = bytes(range(0x80, 0xC0))

FIRST_PREFIX, LONGER = 16, 4  # characters of the shortest prefix, and how many times longer the next is
PREFIXES_PER_PARTITION = 4
TRIE_BYTES = 64 << 20  # texts in a trie of the first step
BATCH_ROWS, BATCH_BYTES = 10_000, 8 << 20

Row = tuple[Any, ...]


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails by itself."""
    words = text.split()
    points = len(text.translate(None, CONTINUATIONS))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        BIT["A"] * (len(words) < FEWEST_WORDS)
        | BIT["B"] * (100 * len(set(words)) < DISTINCT_PERCENT * len(words))
        | BIT["C"] * (100 * capitals > CAPITALS_PERCENT * points)
        | BIT["D"] * (len(text.translate(None, SYMBOLS)) < len(text))
    )


class _Node:
    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, _Node] = {}
        self.least: Any = None  # the least id of the text that ends here
        self.rows: list[Row] = []  # rows with that id


def _common(label: bytes, text: bytes, at: int) -> int:
    """Number of bytes that ``label`` and ``text`` from ``at`` have in common at their start."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """A compressed trie over whole texts with the least id, and its rows, at each terminal."""

    def __init__(self) -> None:
        self.root = _Node(b"")
        self.bytes = 0

    def _terminal(self, text: bytes) -> _Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = _Node(text[at:])
                self.bytes += len(text) - at
            elif not text.startswith(child.label, at):
                shared = _common(child.label, text, at)
                upper = node.children[text[at]] = _Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                child = upper
            node, at = child, at + len(child.label)
        return node

    def insert(self, text: bytes, key: Any, row: Row) -> list[Row]:
        """Add a row; returns the rows that are known to be duplicates by now."""
        node = self._terminal(text)
        if not node.rows or key < node.least:
            beaten, node.least, node.rows = node.rows, key, [row]
            return beaten
        if key > node.least:
            return [row]
        node.rows.append(row)
        return []

    def traverse(self) -> Iterator[tuple[bytes, list[Row]]]:
        """Each text and the rows of its least id."""
        path = [(self.root, b"")]
        while path:
            node, before = path.pop()
            text = before + node.label
            if node.rows:
                yield text, node.rows
            path += [(child, text) for child in node.children.values()]


class _Batches:
    """Rows gathered to Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: Row, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= BATCH_ROWS or self.bytes >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(zip(*self.rows, strict=True), self.schema, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in columns], schema=self.schema)
        self.rows, self.bytes = [], 0


def masked(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``id, part, mask, text`` of every row: text is null where the mask is final, and else all but E is decided."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    schema = f"id {kind}, part string, mask int, text binary"
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie = _Batches(arrow), RadixTrie()

        def undecided() -> Iterator[pa.RecordBatch]:
            for whole, rows in trie.traverse():
                for row in rows:
                    yield from out.add((*row, whole), len(whole))

        for batch in batches:
            for k, p, value in zip(batch["id"].to_pylist(), batch["part"].to_pylist(), batch["text"], strict=True):
                whole = value.as_py()
                row = (k, p, own_mask(whole))
                if k is None:
                    yield from out.add((*row, None))
                    continue
                for i, q, mask in trie.insert(whole, k, row):
                    yield from out.add((i, q, mask | BIT["E"], None))
                if trie.bytes > TRIE_BYTES:
                    yield from undecided()
                    trie = RadixTrie()
        yield from undecided()
        yield from out.flush()

    return rows.mapInArrow(run, schema)


def prefix_lengths(rows: DataFrame, partitions: int) -> tuple[DataFrame, Column]:
    """``rows`` with the codes of crowded prefixes, and the length of the adaptive prefix of ``text``.

    A prefix is crowded while more than a share of a partition's bytes, of several texts, begin with it. There are at
    most PREFIXES_PER_PARTITION times the partitions of a length, so their codes can be broadcast. (A code that two
    prefixes share makes both longer, no more.)
    """
    texts = rows.filter(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    bound = total / (PREFIXES_PER_PARTITION * partitions)
    length, column = FIRST_PREFIX, F.lit(FIRST_PREFIX)
    while True:
        code = F.xxhash64(F.substring("text", 1, length)).alias("code")
        whole = F.xxhash64("text")
        groups = texts.groupBy(code).agg(
            F.sum(F.octet_length("text") + 1).alias("size"), F.min(whole).alias("first"), F.max(whole).alias("last")
        )
        crowded = materialize(groups.filter((F.col("size") > bound) & (F.col("first") != F.col("last"))).select("code"))
        if crowded.isEmpty():
            return rows, column
        name = f"_crowded{length}"
        crowded = F.broadcast(crowded.select(F.col("code").alias(name)))
        texts = texts.withColumn(name, code).join(crowded, name, "left_semi").drop(name)
        mark = F.xxhash64(F.substring(F.col("text").cast("string"), 1, length))
        rows = rows.join(crowded, mark == F.col(name), "left")
        length *= LONGER
        column = F.when(F.col(name).isNotNull(), F.lit(length)).otherwise(column)


def filter_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``id, part, mask`` of every row of ``docs``: one bit per filter that it fails.

    A fewer than 100 words; B distinct words under 80 % of all; C capitals over 10 % of all code points; D any of
    ``#$%&*|``; E equal to the text of a smaller key. Words are what white space separates. Null texts count as empty
    and equal each other, a null part as an empty one. Rows that repeat a key and a text are no duplicates of each other.
    A row without a key is neither a duplicate nor makes others one. Texts of any length are compared whole, other
    columns are ignored, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    rows, length = prefix_lengths(materialize(masked(docs, key, text, part)), partitions)
    prefix = F.col("text").cast("string").substr(F.lit(1), length)
    # Rows that are decided only pass through; their spread keeps them from being one key.
    spread = F.when(F.col("text").isNull(), F.xxhash64("id", "part", "mask", F.monotonically_increasing_id())).otherwise(F.lit(0))
    rows = rows.select("id", "part", "mask", "text", prefix.alias("prefix"), spread.alias("spread"))
    rows = rows.repartitionByRange(partitions, "prefix", "spread").sortWithinPartitions("prefix")
    schema = f"id {kind}, part string, mask int"
    arrow = spark.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie, now = _Batches(arrow), RadixTrie(), None
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("id", "part", "mask", "prefix")]
            for k, p, mask, begins, value in zip(*columns, batch["text"], strict=True):
                if begins is None:
                    yield from out.add((k, p, mask))
                    continue
                if begins != now:
                    for _, least in trie.traverse():
                        for row in least:
                            yield from out.add(row)
                    trie, now = RadixTrie(), begins
                for i, q, found in trie.insert(value.as_py(), k, (k, p, mask)):
                    yield from out.add((i, q, found | BIT["E"]))
        for _, least in trie.traverse():
            for row in least:
                yield from out.add(row)
        yield from out.flush()

    return rows.select("id", "part", "mask", "prefix", "text").mapInArrow(run, schema)


def audit(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per part, order of the filters and step, from the masks of ``filter_masks``.

    ``part, filter_order, step``, and the part's documents ``kept`` after the step, ``removed`` by it, ``redundant``
    (failing its filter, but removed before), ``unique_fails`` (failing no other), ``good_lost`` and ``toxic_lost``
    (removed by it, with ``quality`` or ``toxic`` 1 in ``labels``), and ``shapley``: what its filter removes, summed over all
    orders. A key with several labels has those of any; labels without a key or document count nowhere.
    """
    marks = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # Counted before the join, so that a repeated or missing key is a few rows.
    rows = masks.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n")).join(marks, "id", "left")
    counts = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    steps = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(order) for order in ORDERS])))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    done = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), F.lit(b)).otherwise(0) for x, b in BIT.items()), F.lit(0))

    steps = steps.withColumns({"before": F.col("mask").bitwiseAND(bits(done)) != 0, "own": bits(letter)})
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    removed = ~F.col("before") & fails
    orders = F.lit(len(ORDERS)) / F.greatest(F.bit_count("mask"), F.lit(1))  # those in which a failed filter is first

    def total(condition: Column, of: str | Column = "n") -> Column:
        return F.sum(F.when(condition, of if isinstance(of, Column) else F.col(of)).otherwise(0)).cast("long")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~F.col("before") & ~fails).alias("kept"),
        total(removed).alias("removed"),
        total(F.col("before") & fails).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * orders.cast("long")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``audit`` of the masks of all rows of ``docs``; nulls, copies, long texts and empty tables as in ``filter_masks``."""
    return audit(materialize(filter_masks(docs, key, text, part)), labels, key)
