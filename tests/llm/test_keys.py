"""Keys above 2^53 beside a null key come back exactly, from every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from arealis.llm import (
    exact_dedup,
    filter_audit,
    html_extract,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    repeats,
    rules,
    sharding,
    toxicity,
    warc,
)

BIG = 2**53
KEYS = [BIG + 1, BIG + 3, BIG + 5, None]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def docs(spark):
    text = "a text of some words that is long enough to be a shingle or two "
    rows = [(k, text * 3 + str(i % 2), "en", "web") for i, k in enumerate(KEYS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, i % 2, i % 2) for i, k in enumerate(KEYS)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    "apply",
    [
        lambda d, _: near_dedup.near_duplicates(d),
        lambda d, _: exact_dedup.exact_duplicates(d),
        lambda d, l: quality.score_documents(d, l),
        lambda d, _: packing.pack(d, *TOKENIZER),
        lambda d, _: mixing.mix_report(d),
        lambda d, _: rules.report(d),
        lambda d, l: toxicity.score_documents(d, l),
        lambda d, _: sharding.shuffle_into_shards(d),
        lambda d, _: filter_audit.filter_masks(d).withColumnRenamed("id", "doc_id"),
        lambda d, _: periodic_runs.run_report(d),
        lambda d, _: repeats.removal_report(d),
    ],
    ids="near exact quality packing mixing rules toxicity sharding filters runs repeats".split(),
)
def test_documents(docs, labels, apply):
    assert sorted((r.doc_id for r in apply(docs, labels).collect()), key=str) == sorted(KEYS, key=str)


def test_kept_documents(docs, labels):
    for kept in (exact_dedup.drop_copies(docs), near_dedup.drop_near_duplicates(docs), mixing.mix(docs), quality.keep_good(docs, labels)):
        assert {r.doc_id for r in kept.collect()} <= set(KEYS)


def test_pages(spark):
    rows = [(k, "http://a.example/", f"<article><p>{'text ' * 30}{i % 2}</article>") for i, k in enumerate(KEYS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert got == {k: "text " * 30 + str(i % 2) for i, k in enumerate(KEYS)}
    for some in (pages, pages.filter("page_id is not null")):
        read = warc.records(warc.read_warc(spark, warc.write_warc(some))).collect()
        refers = {r.page_id: r.refers_to for r in read}
        assert refers.items() <= {BIG + 1: None, BIG + 3: None, BIG + 5: BIG + 1, None: BIG + 3}.items()
        assert len(read) == some.count() and all(r.record_type == ("response" if r.refers_to is None else "revisit") for r in read)


def test_archives_are_rolled_by_bytes(spark):
    """Pages that hardly compress: no file is much longer than asked for, and all records come back."""
    html = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(40)])
    pages = spark.range(0, 200, 1, 2).select(F.col("id").alias("page_id"), F.lit("http://a").alias("url"), html.alias("html"))
    path = warc.write_warc(pages, file_bytes=50_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length").collect()
    assert len(files) > 8 and max(r.length for r in files) < 60_000
    read = warc.read_warc(spark, path)
    assert warc.gaps(read).count() == 0
    assert sorted(r.page_id for r in warc.records(read).select("page_id").collect()) == list(range(200))


def test_texts_without_spaces_are_not_kept_by_the_encoder():
    encoder = packing.Encoder(*TOKENIZER, cache_words=10_000)
    texts = ["漢字" * 500 + str(i) for i in range(20)] + ["QUJD" * 1000 + f" short words {i}" for i in range(20)]
    ids = encoder.encode(texts)
    assert sum(len(word) for known in (encoder.first, encoder.rest) for word in known) < 2000
    assert ids == packing.Encoder(*TOKENIZER).encode(texts)
    plain = encoder.bpe.encode_ordinary
    assert [len(x) // 4 for x in ids[:20]] == [len(plain(t)) for t in texts[:20]]


def test_repeated_labelled_rows_are_one_in_the_sample(spark):
    rows = [(i % 7, f"text number {i % 7} " * 3) for i in range(700)] + [(8, "long " * 100_000), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(9)], "key long, y int")
    sample = toxicity._sample(docs, marks, "doc_id", "text")
    assert sample == [(i, i % 2, f"text number {i} " * 3) for i in range(7)]
