import zlib

import numpy as np
import pytest

from arealis.llm import quality, toxicity
from arealis.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def judged(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_on_held_out_rows(spark):
    pairs = judged(spark, "op5_quality", "quality")
    assert all(r.predicted == (r.score >= 0.3) for r, _ in pairs)
    assert np.mean([r.predicted == y for r, y in pairs]) >= 0.95
    assert np.mean([r.predicted for r, y in pairs if y == 1]) >= 0.98


def test_toxicity_on_held_out_rows(spark):
    """Few toxic rows are learned from here, and a label may lack a toxic word; most English rows are clear."""
    pairs = judged(spark, "op9_toxicity", "toxic")
    assert all(r.predicted == (r.score >= 0.7) for r, _ in pairs)
    assert np.mean([r.predicted for r, y in pairs if y == 1]) >= 0.6
    assert np.mean([r.predicted for r, y in pairs if y == 0]) <= 0.05


@pytest.mark.parametrize("score", [quality.score_documents, toxicity.score_documents])
def test_awkward_rows(awkward, nothing, marks, score):
    rows = score(awkward, marks).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert score(nothing, marks).count() == 0
    unlabelled = score(awkward, marks.limit(0)).collect()
    assert len(unlabelled) == awkward.count() and len({r.predicted for r in unlabelled}) == 1


def test_keep_good_keeps_columns(awkward, nothing, marks):
    kept = quality.keep_good(awkward, marks)
    assert kept.columns == awkward.columns
    assert set(map(str, kept.collect())) <= set(map(str, awkward.collect()))
    assert quality.keep_good(nothing, marks).count() == 0


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 0.8, 0.4, 1.0]), np.array([1.0, 1, 1, 2]))
    assert np.interp([0, 1, 2, 3], x, y).tolist() == pytest.approx([0, 0.6, 0.6, 1])
    assert (np.diff(y) >= 0).all()


def test_best_cut_lies_in_the_gap():
    assert toxicity.best_cut(np.array([0.0, 1, 5, 6]), np.array([0, 0, 1, 1])) == 3
    assert toxicity.best_cut(np.array([2.0, 2, 2]), np.array([1, 0, 1])) == 1
    assert toxicity.best_cut(np.array([1.0]), np.array([1])) is None


def test_gradient_reaches_rare_stems():
    """Words of one stem are toxic; a form never met before scores high as well."""
    rng = np.random.default_rng(1)
    plain = [f"w{i}ord" for i in range(200)]
    texts, y = [], []
    for i in range(300):
        words = list(rng.choice(plain, 30))
        if i % 3 == 0:
            words[int(rng.integers(30))] = f"zarq{i}"
        texts.append(words)
        y.append(int(i % 3 == 0))
    model = toxicity.train(texts, np.array(y))
    z, _ = model.logits([[*rng.choice(plain, 30), "zarqunseen"], list(rng.choice(plain, 30))])
    assert z[0] > z[1] + 2


def test_thresholds_are_chosen_on_all_labelled_rows(spark, monkeypatch):
    """With few rows trained on, as many of either kind, the thresholds still see the mix of all rows."""
    folder = "/root/testdata/sf0.01"
    seen = []
    best = toxicity.best_cut
    monkeypatch.setattr(toxicity, "MAX_ROWS", 15)
    monkeypatch.setattr(toxicity, "best_cut", lambda z, y, *w: seen.append((y, *w)) or best(z, y, *w))
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    toxicity.fit(docs, labels)
    marks = labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    marks = marks.filter(~toxicity.held_out(marks["doc_id"], *toxicity.HELD_OUT)).dropDuplicates(["doc_id"])
    y, weight = seen[0]
    assert weight.sum() == pytest.approx(marks.count())
    assert (weight * y).sum() == pytest.approx(marks.filter("toxic = 1").count())


def test_quality_model_equals_dense_least_squares(spark):
    """Statistics, ridge and isotonic fit again on the driver, from all labelled rows at once."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(quality.text_statistics(docs), labels)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 5]
    x = np.stack([quality.statistics(r.text) for r in rows])
    y = np.array([float(marks[r.doc_id]) for r in rows])
    apart = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 == 4 for r in rows])
    assert model.mean == pytest.approx(x.mean(0)) and model.scale == pytest.approx(np.where(x.std(0) > 1e-6, x.std(0), 1))
    z = model.features(x)
    a, b = z[~apart], y[~apart]
    lam = quality.RIDGE * len(a) / z.shape[1]
    coef = np.linalg.lstsq(np.vstack([a, np.sqrt(lam) * np.eye(z.shape[1])]), np.concatenate([b, np.zeros(z.shape[1])]), rcond=None)[0]
    assert z @ model.coef == pytest.approx(z @ coef, abs=1e-6)
    raw = np.round(np.clip(z[apart] @ model.coef, -1, 2), 3)
    fitted = plain_isotonic(raw, y[apart])
    assert np.interp(raw, model.steps_x, model.steps_y) == pytest.approx(fitted, abs=1e-6)
    scored = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    assert [scored[r.doc_id] for r in rows] == pytest.approx(np.interp(z @ model.coef, model.steps_x, model.steps_y), abs=1e-6)


def plain_isotonic(x, y):
    """The minimax form: greatest over starts of the least over ends of the mean in between."""
    out = np.zeros(len(x))
    levels = np.unique(x)
    for i, v in enumerate(x):
        out[i] = max(min(y[(x >= a) & (x <= b)].mean() for b in levels[levels >= v]) for a in levels[levels <= v])
    return out


def test_toxicity_scores_equal_a_plain_convolution(spark):
    """Word by word, filter by filter, without caches, batches or pooling over joined texts."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()] + [None, "", "one", "two words", "the le der"]
    got = model.score(texts)
    for text, score in zip(texts, got, strict=True):
        words = [w.strip(toxicity.EDGE) for w in (text or "").lower().split()]
        vectors = [model.embed[list(toxicity._buckets(w))].sum(0) for w in words] + [np.zeros(toxicity.DIM)] * max(toxicity.WIDTHS)
        pooled, first = [], 0
        for width in toxicity.WIDTHS:
            places = range(len(vectors) - width + 1)
            each = [sum(vectors[p + j] @ model.filters[first + j] for j in range(width)) for p in places]
            pooled += list(np.max(each, axis=0))
            first += width
        z = np.maximum(np.array(pooled) + model.bias, 0) @ model.out + model.out_bias
        spoken = [sum(w in toxicity.FUNCTION_WORDS[lang].split() for w in words) for lang in toxicity.LANGUAGES]
        language = int(np.argmax(spoken)) if max(spoken) else len(toxicity.LANGUAGES)
        shifted = np.clip(z - model.cut[language] + np.log(0.7 / 0.3), -30, 30)
        assert score == pytest.approx(1 / (1 + np.exp(-shifted)), abs=1e-4)


def test_pooling_does_not_reach_into_the_next_text():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(50, toxicity.OFFSETS * toxicity.FILTERS))
    starts = np.array([0, 4, 7, 30])
    alone = [toxicity._pool(part, np.array([0]))[0] for part in np.split(table, starts[1:])]
    assert toxicity._pool(table, starts) == pytest.approx(np.array(alone))
