"""Toxicity classifier: a convolutional text network over hashed word embeddings, trained in numpy.

A word's embedding is the sum of three hashed rows: the word, its first four and its first five characters, so
unseen forms of a known stem are known too. Filters of width one to three slide over the whole text, the maximum
of each feeds a logistic layer. The threshold is chosen per language, which is told from the text itself by its
function words; scores are shifted so that every language's threshold is 0.7.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import held_out
from arealis.sources.scratch import materialize

HELD_OUT = (3, 1)  # crc32 of the key modulo 3 is 1: never learned from
THRESHOLD = 0.7
# At most so many labelled rows of each kind are learned from, the first by hash of the key.
MAX_ROWS = 2500
BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
BATCH = 64
RATE = 0.05
SHRINK = 5.0
SEED = 9
# Longer texts are not learned from, so that the sample fits the driver whatever the texts; all are scored whole.
MAX_BYTES = 1 << 17
CACHE_WORDS = 200_000
AT_ONCE = 256
PLACES = 1 << 15  # of words that are pooled at once, if no text has more
BINS = 256  # of a logit, per unit, in the histograms that the thresholds are chosen on

OFFSETS = sum(WIDTHS)
POOLED = FILTERS * len(WIDTHS)
EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_"

# Frequent function words: fixed values.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on are with as by this be at from",
    "fr": "le la les de des du et un une est que qui pour dans sur pas avec au aux",
    "de": "der die das und den dem ein eine ist nicht mit auf von zu für im sich auch",
    "es": "el los las del y un una es en por con para se no su al lo como más",
}
LANGUAGES = list(FUNCTION_WORDS)
_LANGUAGE_OF = {
    word: [word in words.split() for words in FUNCTION_WORDS.values()] for text in FUNCTION_WORDS.values() for word in text.split()
}


def _buckets(word: str) -> tuple[int, int, int]:
    parts = (word, "4" + word[:4], "5" + word[:5])
    return tuple(xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass"), seed=i) % BUCKETS for i, p in enumerate(parts))


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class ToxicityModel:
    """Embeddings, filters, logistic layer and one threshold (a logit) per language, the last for texts of none."""

    embed: np.ndarray
    filters: np.ndarray  # one DIM x FILTERS matrix for each word of each width
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    cut: np.ndarray
    rows: dict = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)
    speech: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"rows": {}, "table": None, "speech": None}

    def _learn_words(self, texts: list[list[str]]) -> None:
        """Keep, for each word, what it adds to every filter at every place, so texts need sums only."""
        if self.table is None or len(self.rows) > CACHE_WORDS:
            self.rows = {}
            self.table = np.zeros((1, OFFSETS * FILTERS), np.float32)  # row 0 is the padding
            self.speech = np.zeros((1, len(LANGUAGES)), np.float32)
        new = list(dict.fromkeys(word for words in texts for word in words if word not in self.rows))
        if not new:
            return
        bare = [word.strip(EDGE) for word in new]
        vectors = self.embed[np.array([_buckets(word) for word in bare])].sum(1)
        added = np.hstack([vectors @ f for f in self.filters]).astype(np.float32)
        spoken = np.array([_LANGUAGE_OF.get(word, [False] * len(LANGUAGES)) for word in bare], np.float32)
        self.rows.update((word, len(self.table) + i) for i, word in enumerate(new))
        self.table, self.speech = np.vstack([self.table, added]), np.vstack([self.speech, spoken])

    def logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The logit and the language (a place in LANGUAGES, or one beyond) of each text."""
        z, language = np.zeros(len(texts)), np.zeros(len(texts), int)
        self._learn_words(texts)
        # Texts go end to end, each followed by padding, in stretches of bounded size.
        pad, first = [0] * max(WIDTHS), 0
        while first < len(texts):
            last, n = first, 0
            while last < len(texts) and (last == first or n + len(texts[last]) + len(pad) <= PLACES):
                n += len(texts[last]) + len(pad)
                last += 1
            some = texts[first:last]
            rows = self.rows
            ids = np.array([i for words in some for i in chain(map(rows.__getitem__, words), pad)], np.int64)
            starts = np.cumsum([0, *(len(words) + len(pad) for words in some[:-1])])
            pooled = np.maximum(_pool(self.table[ids], starts) + self.bias, 0)
            z[first:last] = pooled @ self.out + self.out_bias
            spoken = np.add.reduceat(self.speech[ids], starts)
            language[first:last] = np.where(spoken.max(1) > 0, spoken.argmax(1), len(LANGUAGES))
            first = last
        return z, language

    def score(self, texts: list[str | None]) -> np.ndarray:
        z, language = self.logits([tokens(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(z - self.cut[language] + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _pool(added: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maximum of each filter over all places of each text; ``added`` has the places in rows, ``starts`` where texts begin.

    A text's own places end where its padding does, so that no filter reaches into the next text.
    """
    out, first = [], 0
    ends = np.append(starts[1:], len(added))
    for width in WIDTHS:
        n = len(added) - width + 1
        total = added[:n, first * FILTERS : (first + 1) * FILTERS].copy()
        for j in range(1, width):
            total += added[j : j + n, (first + j) * FILTERS : (first + j + 1) * FILTERS]
        for j in range(1, width):  # places whose window leaves the text
            total[(ends - j)[ends - j < n]] = -np.inf
        out.append(np.maximum.reduceat(total, starts))
        first += width
    return np.hstack(out)


def train(texts: list[list[str]], y: np.ndarray) -> ToxicityModel:
    """Adagrad on the logistic loss; the gradient runs through the places that win the maxima."""
    rng = np.random.default_rng(SEED)
    words = sorted({word.strip(EDGE) for text in texts for word in text})
    place = {word: i for i, word in enumerate(words)}
    buckets = np.array([_buckets(word) for word in words] or [(0, 0, 0)])
    docs = [np.array([place[word.strip(EDGE)] for word in text], int) for text in texts]
    model = ToxicityModel(
        embed=rng.normal(size=(BUCKETS, DIM)) * 0.05,
        filters=rng.normal(size=(OFFSETS, DIM, FILTERS)) * 0.3,
        bias=np.zeros(POOLED),
        out=rng.normal(size=POOLED) * 0.1,
        out_bias=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))),
        cut=np.zeros(len(LANGUAGES) + 1),
    )
    model.embed[:, 0] = _evidence(docs, y, buckets)
    state = [model.embed, model.filters, model.bias, model.out]
    squares = [np.full_like(x, 1e-4) for x in state]
    bias_square = 1e-4
    for _ in range(EPOCHS if len(docs) else 0):
        for batch in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            grads = [np.zeros_like(x) for x in (model.filters, model.bias, model.out)]
            touched, pulls, bias_grad = [], [], 0.0
            used = np.unique(np.concatenate([docs[i] for i in batch])) if len(batch) else []
            vectors = np.zeros((len(words) + 1, DIM))
            vectors[used] = model.embed[buckets[used]].sum(1)
            for i in batch:
                ids = np.concatenate([docs[i], [len(words)] * max(WIDTHS)])
                best, at = _winners(vectors[ids], model.filters)
                pooled = np.maximum(best + model.bias, 0)
                p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.out_bias, -30, 30)))
                d = (p - y[i]) / len(batch)
                grads[2] += d * pooled
                bias_grad += d
                back = d * model.out * (pooled > 0)
                grads[1] += back
                first = 0
                for k, width in enumerate(WIDTHS):
                    mine = slice(k * FILTERS, (k + 1) * FILTERS)
                    for j in range(width):
                        word = ids[at[mine] + j]
                        grads[0][first + j] += vectors[word].T * back[mine]
                        touched.append(word)
                        pulls.append(model.filters[first + j].T * back[mine][:, None])
                    first += width
            word, pull = np.concatenate(touched), np.concatenate(pulls)
            real = word < len(words)
            rows = buckets[word[real]].reshape(-1)
            unique, where = np.unique(rows, return_inverse=True)
            embed_grad = np.zeros((len(unique), DIM))
            np.add.at(embed_grad, where, np.repeat(pull[real], 3, axis=0))
            squares[0][unique] += embed_grad**2
            model.embed[unique] -= RATE * embed_grad / np.sqrt(squares[0][unique])
            for x, square, grad in zip(state[1:], squares[1:], grads, strict=True):
                square += grad**2
                x -= RATE * grad / np.sqrt(square)
            bias_square += bias_grad**2
            model.out_bias -= RATE * bias_grad / np.sqrt(bias_square)
    return model


def _evidence(docs: list[np.ndarray], y: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Start of the first embedding dimension: log ratio of a bucket's document frequency in the two kinds."""
    count = np.zeros((2, BUCKETS))
    for ids, kind in zip(docs, y, strict=True):
        count[int(kind), np.unique(buckets[np.unique(ids)])] += 1
    n = np.array([[max(1, (y == 0).sum())], [max(1, (y == 1).sum())]])
    share = (count + 0.5) / (n + 1)
    seen = count.sum(0)
    return np.log(share[1] / share[0]) * seen / (seen + SHRINK) / 3


def _winners(vectors: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best, at, first = [], [], 0
    for width in WIDTHS:
        n = len(vectors) - width + 1
        total = sum(vectors[j : j + n] @ filters[first + j] for j in range(width))
        at.append(total.argmax(0))
        best.append(total.max(0))
        first += width
    return np.concatenate(best), np.concatenate(at)


def best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float | None:
    """The logit that gives the best F1, in the middle of the gap it lies in; None without both kinds."""
    if len(np.unique(y)) < 2:
        return None
    weight = np.ones(len(y)) if weight is None else weight
    order = np.argsort(-z, kind="stable")
    z, y, weight = z[order], y[order], weight[order]
    hits = np.cumsum(weight * y)
    f1 = 2 * hits / (np.cumsum(weight) + hits[-1])
    f1[:-1][z[:-1] == z[1:]] = -1  # equal logits cannot be parted
    i = int(np.argmax(f1))
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i]) - 1.0


def _marks(labels: DataFrame, key: str, label: str) -> DataFrame:
    """``key, y`` of the labelled rows that may be learned from."""
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).dropna()
    return marks.groupBy("key").agg(F.max("y").alias("y")).filter(~held_out(F.col("key"), *HELD_OUT))


def _sample(docs: DataFrame, marks: DataFrame, key: str, text: str) -> list[tuple]:
    """Labelled ``(key, y, text)`` to train on by key, at most MAX_ROWS of each kind with at most MAX_BYTES of text each.

    A key with several texts has the first of them in order. Repeated rows are one before they leave Spark.
    """
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    fitting = texts.filter(F.octet_length("text") <= MAX_BYTES)
    known = marks.join(fitting.select("key").distinct(), "key", "left_semi")
    by_hash = [F.xxhash64("key", F.lit(SEED)), F.col("key")]
    chosen = known.filter("y = 1").orderBy(*by_hash).limit(MAX_ROWS)
    chosen = materialize(chosen.union(known.filter("y = 0").orderBy(*by_hash).limit(MAX_ROWS)))
    rows = fitting.join(F.broadcast(chosen), "key")  # chosen has 2 * MAX_ROWS rows at most
    rows = rows.groupBy("key").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    return sorted((r.key, r.y, r.text) for r in rows.collect())


def logits_of(model: ToxicityModel, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, z, language`` of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                z, language = model.logits([tokens(t.as_py()) for t in some["text"]])
                columns = [some["key"], pa.array(z, pa.float64()), pa.array(language, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "z", "language"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(measure, f"key {docs.schema[key].dataType.simpleString()}, z double, language int")


def choose_cuts(model: ToxicityModel, logits: DataFrame, marks: DataFrame, trained: DataFrame) -> None:
    """Set the thresholds by all labelled rows but the ones trained on, from histograms per language.

    A kind's rows count by the share of them that is left, so that the mix of kinds is that of all rows. If the rows
    left lack a kind, the ones trained on count too.
    """
    scored = logits.groupBy("key").agg(F.min(F.struct("z", "language")).alias("s")).join(marks, "key")
    scored = scored.join(F.broadcast(trained.withColumn("trained", F.lit(True))), "key", "left")
    place = F.floor(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("s.z"))) * BINS).alias("bin")
    counted = scored.groupBy(F.col("s.language").alias("language"), "y", F.coalesce("trained", F.lit(False)).alias("trained"), place)
    bins = counted.agg(F.count(F.lit(1)).alias("n")).orderBy("language", "y", "trained", "bin").toPandas()
    bins["y"] = (bins["y"] == 1).astype(int)
    left = bins[~bins["trained"].astype(bool)]
    if left["y"].nunique() < 2:
        left = bins
    share = left.groupby("y")["n"].sum() / bins.groupby("y")["n"].sum()
    z, marks_ = (left["bin"].to_numpy(float) + 0.5) / BINS, left["y"].to_numpy(int)
    n, language = left["n"].to_numpy(float), left["language"].to_numpy(int)
    weight = n / left["y"].map(share).to_numpy(float)
    common = best_cut(z, marks_, weight)
    for i in range(len(LANGUAGES) + 1):
        mine = language == i
        enough = (n * marks_)[mine].sum() >= 5
        cut = best_cut(z[mine], marks_[mine], weight[mine]) if enough else None
        model.cut[i] = common if cut is None else cut


def fit_and_measure(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str = "toxic") -> tuple[ToxicityModel, DataFrame]:
    """Train on four fifths of the sample, choose the thresholds on all other labelled rows; the model and all logits.

    Without labels of both kinds every text scores below the threshold (no or one kind only, clean) or above
    (toxic only).
    """
    marks = materialize(_marks(labels, key, label))
    rows = _sample(docs, marks, key, text)
    y = np.array([row[1] for row in rows], int)
    if len(np.unique(y)) < 2:
        model = train([], np.zeros(0, int))
        model.cut[:] = -20.0 if len(y) and y[0] == 1 else 20.0
        return model, logits_of(model, docs, key, text)
    fold = np.array([zlib.crc32(f"fold {k}".encode()) % 5 == 0 for k, _, _ in rows], bool)
    if len(np.unique(y[fold])) < 2 or len(np.unique(y[~fold])) < 2:
        fold = np.zeros(len(y), bool)
    learned = [row for row, f in zip(rows, fold, strict=True) if not f]
    model = train([tokens(row[2]) for row in learned], y[~fold])
    logits = materialize(logits_of(model, docs, key, text))
    kind = docs.schema[key].dataType.simpleString()
    trained = docs.sparkSession.createDataFrame([(row[0],) for row in learned], f"key {kind}")
    choose_cuts(model, logits, marks, trained)
    return model, logits


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """The model alone; see fit_and_measure."""
    return fit_and_measure(docs, labels, key, text, label)[0]


def score(model: ToxicityModel) -> Column:
    """A column function: the score of a text column."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        held = list(texts)
        parts = [model.score(held[i : i + 256]) for i in range(0, len(held), 256)]
        return pd.Series(np.concatenate(parts) if parts else [])

    return scored


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for every row, over whole texts.

    A null text is empty and scores by its lack of words; null keys are scored too and never learned from; rows
    that repeat are scored alike; other columns are ignored; an empty table gives no rows.
    """
    model, logits = fit_and_measure(docs, labels, key, text)
    cut = F.element_at(F.array(*[F.lit(float(c)) for c in model.cut]), F.col("language") + 1)
    shifted = F.col("z") - cut + float(np.log(THRESHOLD / (1 - THRESHOLD)))
    shifted = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), shifted))
    scored = logits.select(
        F.col("key").alias(key), held_out(F.col("key"), *HELD_OUT).alias("held_out"), (1 / (1 + F.exp(-shifted))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
