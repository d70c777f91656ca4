"""Quality rules as a bitmask ledger, in DataFrame operations only.

Every rule is evaluated once per document; the ledger keeps the measurements and one failure bit per rule.
Policies are versioned masks over the bits, so a new policy or an ablation reads the ledger and not the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import SPACES, words
from arealis.sources.scratch import materialize

WINDOW = 8
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Name and failure condition over the measurements; the place in the list is the bit. Append only: stored ledgers
# keep their meaning.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "n_repeat_words * 100 > n_words * 30"),
    ("symbols", "n_symbols * 100 > n_words * 30"),
    ("duplicate_lines", "n_dup_lines * 100 > n_lines * 50"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("capitals", "n_capitals * 100 > word_chars * 60"),
    ("stuttering", "n_stutters * 100 > n_words * 50"),
]

# Masks over the bits above. The base policy is part of every other one.
POLICIES = {"base": 0b0000011, "v1": 0b0011111, "v2": 0b1111111}


def _removed(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements to ``docs``; a null text measures as an empty one.

    Words and windows of words are compared by 64-bit hashes, windows by a hash of their words' hashes; lines by content.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    df = docs.withColumns({"_words": words(whole), "_lines": lines})
    df = df.withColumn("_codes", F.transform("_words", lambda word: F.xxhash64(word)))
    n = F.size("_words")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("_codes"), i, WINDOW)))
    df = df.withColumn("_windows", F.when(n > WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    # Windows that occur again stand next to each other once sorted by code. What follows is null elsewhere.
    placed = F.transform("_windows", lambda code, i: F.struct(code.alias("code"), i.alias("at")))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))
    following = F.slice("_sorted", F.lit(2), F.size("_sorted"))
    same = F.zip_with("_sorted", following, lambda a, b: F.coalesce(a["code"] == b["code"], F.lit(False)))
    df = df.withColumn("_same", same)
    before = F.concat(F.array(F.lit(False)), F.col("_same"))
    twice = F.zip_with(F.zip_with("_same", before, lambda a, b: a | b), "_sorted", lambda found, w: F.when(found, w["at"]))
    df = df.withColumn("_at", F.sort_array(F.array_compact(twice)))
    # Each window adds its words up to the next window's first.
    gaps = F.zip_with("_at", F.slice("_at", F.lit(2), F.size("_at")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap), F.lit(0)).cast("long"))
    stutters = F.filter(F.zip_with("_codes", F.slice("_codes", F.lit(2), F.size("_codes")), lambda a, b: a == b), lambda same: same)
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(F.translate(whole, SPACES, "")).cast("long"),
            "n_symbols": _removed(whole, SYMBOLS),
            "n_capitals": _removed(whole, CAPITALS),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stutters": F.size(stutters).cast("long"),
        }
    )
    return df.drop("_words", "_lines", "_codes", "_windows", "_sorted", "_same", "_at")


MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines", "n_stutters",
)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the measurements and ``failures`` (bit i: rule i failed) of every row, as a stored table.

    A null text is empty, an empty text fails ``few_words`` only. Texts of any length are measured whole; repeated
    rows and null keys are rows like any other; other columns are ignored; an empty table gives an empty ledger.
    """
    measured = measure(docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")), "_text")
    bits = [F.when(F.expr(failed), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, failed) in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return materialize(measured.select(F.col("_id").alias(key), *MEASUREMENTS, failures.cast("long").alias("failures")))


def apply_policy(book: DataFrame, version: str) -> DataFrame:
    """Add ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("failures").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablations(book: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects.

    One aggregation over the failure masks; at most one row per mask is left after it. Rows of the ledger count as they
    are, repeated ones and those without a key too; an empty ledger gives no rows.
    """
    mask = F.col("failures").bitwiseAND(F.lit(POLICIES[version]))
    masks = book.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    used = [(i, name) for i, (name, _) in enumerate(RULES) if POLICIES[version] >> i & 1]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, name in used]))
    rows = masks.withColumn("_rule", each).select("mask", "n", "_rule.*")
    return rows.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n"))), F.lit(0)).alias("failed_alone"),
    )


def report(docs: DataFrame, version: str = "v2", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger with the verdicts of the base policy and of ``version``; odd rows and tables are as in ``ledger``."""
    book = apply_policy(ledger(docs, key, text), version)
    return book.withColumn("base_failed", F.col("failures").bitwiseAND(F.lit(POLICIES["base"])) != 0)
