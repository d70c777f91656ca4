"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

A document becomes a short vector of statistics of its whole text. Random Fourier features of it approximate a
Gaussian kernel, so a linear ridge score separates what no single threshold does. The normal equations are
summed over partitions; the driver solves one small system. The raw score is calibrated by isotonic regression
on labelled rows that the ridge fit has not seen.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import clear_caches, held_out
from arealis.sources.scratch import materialize

FEATURES = 192
RIDGE = 1e-2
WIDTH = 1.5
SEED = 5
THRESHOLD = 0.3
HELD_OUT = (5, 0)  # crc32 of the key modulo 5 is 0: never learned from
CALIBRATION = (5, 4)

_LOWER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _STOP, _LOUD, _BAR, _WIDE = range(9)
_CLASSES = {
    _LOWER: b"abcdefghijklmnopqrstuvwxyz",
    _UPPER: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    _DIGIT: b"0123456789",
    _SPACE: b" \t\n\x0b\x0c\r",
    _SYMBOL: b"#*$%&<>@^~_=+\\/{}[]",
    _STOP: b".,;:'\"()-",
    _LOUD: b"!?",
    _BAR: b"|",
    _WIDE: bytes(range(128, 256)),
}
_BYTE_CLASS = np.zeros((256, 9))
for _class, _bytes in _CLASSES.items():
    _BYTE_CLASS[list(_bytes), _class] = 1

STATISTICS = 14


def statistics(text: str | None) -> np.ndarray:
    """Fourteen statistics of the whole text; a null or empty text has zeros."""
    out = np.zeros(STATISTICS)
    words = text.split() if text else []
    if not words:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _BYTE_CLASS
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    visible = max(1.0, len(raw) - count[_SPACE])
    out[0] = np.log1p(n)
    out[1] = np.log1p((len(text) - count[_SPACE]) / n)
    out[2] = np.log1p(len(set(words))) / np.log1p(n)
    out[3] = sum(map(operator.eq, words, islice(words, 1, None))) / n
    out[4] = sum(map(operator.eq, words, islice(words, 2, None))) / n
    out[5] = count[_UPPER] / max(1.0, count[_UPPER] + count[_LOWER])
    out[6] = min(3.0, count[_SYMBOL] / n)
    out[7] = min(3.0, count[_LOUD] / n)
    out[8] = min(3.0, count[_BAR] / n)
    out[9] = count[_DIGIT] / visible
    out[10] = count[_STOP] / visible
    out[11] = 1 - len(set(lines)) / len(lines)
    out[12] = np.log1p(n / len(lines))
    out[13] = (count[_LOWER] + count[_UPPER] + count[_WIDE]) / visible
    return out


@dataclass
class QualityModel:
    """What scoring needs; a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    coef: np.ndarray
    steps_x: np.ndarray
    steps_y: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.phase
        return np.hstack([np.cos(z) * np.sqrt(2 / z.shape[1]), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coef

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps_x, self.steps_y)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the non-decreasing fit of y over sorted x."""
    blocks: list[list[float]] = []  # first x, last x, mean, weight
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a, a, b, w])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            first, last, mean, total = blocks.pop()
            old = blocks[-1]
            old[2] = (old[2] * old[3] + mean * total) / (old[3] + total)
            old[1], old[3] = last, old[3] + total
    knots = [(edge, b[2]) for b in blocks for edge in dict.fromkeys((b[0], b[1]))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, x``: the statistics of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_caches()
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(found, pa.list_(pa.float64()))], ["key", "x"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        measure, f"key {kind}, x array<double>"
    )


def fit(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> QualityModel:
    """Fit on the labelled rows whose key is not held out. Rows without a label or a key do not count.

    With no label at all every score is 0.5; with labels of one kind only every score is that kind's.
    """
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y")).dropna()
    marks = marks.groupBy("key").agg(F.max("y").alias("y")).filter(~held_out(F.col("key"), *HELD_OUT))
    rows = measured.join(marks, "key").withColumn("calibrate", held_out(F.col("key"), *CALIBRATION))
    train = materialize(rows)
    rng = np.random.default_rng(SEED)
    d = STATISTICS
    at = [F.col("x")[i] for i in range(d)]
    moments = train.agg(*[f(c) for c in at for f in (F.avg, F.stddev_pop)], F.avg("y")).first()
    prior = 0.5 if moments[-1] is None else float(moments[-1])
    model = QualityModel(
        mean=np.array([m or 0.0 for m in moments[:-1:2]]),
        scale=np.array([s if s and s > 1e-6 else 1.0 for s in moments[1::2]]),
        weights=rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d)),
        phase=rng.uniform(0, 2 * np.pi, FEATURES),
        coef=np.zeros(FEATURES + 1),
        steps_x=np.array([0.0]),
        steps_y=np.array([prior]),
    )
    if prior in (0.0, 1.0) or moments[-1] is None:
        return model
    model.coef = _ridge(train.filter(~F.col("calibrate")), model)

    raw = F.pandas_udf(lambda x: pd.Series(model.raw(np.stack(x)) if len(x) else []), "double")
    bins = (
        train.filter("calibrate")
        .groupBy(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), raw("x"))), 3).alias("raw"))
        .agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
        .orderBy("raw")
        .toPandas()  # one row per thousandth of the raw score, 3,001 at most
    )
    if len(bins):
        model.steps_x, model.steps_y = isotonic(bins["raw"].to_numpy(), bins["y"].to_numpy(), bins["n"].to_numpy(float))
    return model


def _ridge(train: DataFrame, model: QualityModel) -> np.ndarray:
    """Solve the normal equations; each partition adds one matrix, summed row by row."""
    size = FEATURES + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = model.features(np.stack(batch["x"]))
                total += z.T @ np.column_stack([z, batch["y"].to_numpy(float)])
        yield pd.DataFrame({"i": range(size), "v": list(total)})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "v": [np.sum(np.stack(part["v"]), axis=0)]})

    sums = train.select("x", "y").mapInPandas(partial, "i int, v array<double>")
    rows = sums.groupBy("i").applyInPandas(add, "i int, v array<double>").toPandas().sort_values("i")
    if not len(rows):
        return np.zeros(size)
    system = np.stack(rows["v"])
    n = system[-1, size - 1]  # the constant feature counts the rows
    return np.linalg.solve(system[:, :size] + RIDGE * max(n, 1) / size * np.eye(size), system[:, size])


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for every row.

    A null text counts as empty, and empty texts are scored by their statistics, all zero. A null key is scored and
    never learned from. Texts of any length are measured whole; rows that repeat are scored alike; of several labels of a key
    the greatest counts; other columns are ignored; an empty table gives no rows.
    """
    measured = materialize(text_statistics(docs, key, text))
    model = fit(measured, labels, key)
    score = F.pandas_udf(lambda x: pd.Series(model.score(np.stack(x)) if len(x) else []), "double")
    scored = measured.select(F.col("key").alias(key), held_out(F.col("key"), *HELD_OUT).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all columns and without a shuffle of texts.

    Null keys, null, empty and long texts and repeated rows are scored like all others; an empty table stays empty.
    """
    marked = labels.select(F.col(key).alias("_key")).distinct()
    learnable = docs.select(key, text).join(marked, F.col(key) == F.col("_key"), "left_semi")
    model = fit(materialize(text_statistics(learnable, key, text)), labels, key)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(t) for t in texts])) if len(texts) else [])

    return docs.filter(score(F.col(text)) >= THRESHOLD)
