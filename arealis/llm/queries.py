"""The registered queries of the training-data operators, and the pipeline over them.

Each query applies its operator to the whole of its table with the parameters meant for production.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
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
from arealis.llm.common import read_table

# The vocabulary of byte_bpe_50k.json as ranks: the same ids.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, folder, "documents"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Both digest columns come from the archives: from the payload, or from a revisit's header."""
    archive = warc.write_warc(read_table(spark, folder, "pages"))
    return warc.records(warc.read_warc(spark, archive)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, folder, "pages"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), *TOKENIZER).drop("ids")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.report(read_table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.shuffle_into_shards(read_table(spark, folder, "documents"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return shards.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_report(read_table(spark, folder, "documents"), words_of=periodic_runs.planted)


def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removal_report(read_table(spark, folder, "documents"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_warc": op3_warc,
    "op4_html_extract": op4_html_extract,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repeats": op13_repeats,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    # Equal texts, the largest doc_id stays.
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    # Of equal payloads of 100 bytes or more, the smallest page_id is the response.
    "op3_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
        r AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d),
        m AS (SELECT *, n >= 100 AND first <> page_id AS again FROM r)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM m
    """,
    # Every rule written out again; windows of eight words are compared as text.
    "op8_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
        l AS (SELECT doc_id, list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
        windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS window_text
              FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) > 7)),
        twice AS (SELECT doc_id, unnest(generate_series(i, i + 7)) AS place FROM
              (SELECT *, count(*) OVER (PARTITION BY doc_id, window_text) AS c FROM windows) WHERE c > 1),
        covered AS (SELECT doc_id, count(DISTINCT place) AS c FROM twice GROUP BY doc_id),
        m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                coalesce(c, 0)::BIGINT AS n_repeat_words,
                len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_capitals,
                len(ls)::BIGINT AS n_lines,
                len(list_filter(generate_series(1, len(ws) - 1), lambda i: ws[i] = ws[i + 1]))::BIGINT AS n_stutters
              FROM w JOIN l USING (doc_id) LEFT JOIN covered USING (doc_id)),
        f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
                + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
                + (CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END)
                + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
                + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)
                + (CASE WHEN 100 * n_capitals > 60 * word_chars THEN 32 ELSE 0 END)
                + (CASE WHEN 100 * n_stutters > 50 * n_words THEN 64 ELSE 0 END) AS bits FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, n_lines, n_stutters,
               bits::BIGINT AS failures, bits = 0 AS kept,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
        FROM f
    """,
    # Every order is written out from the five letters; each document's own failures come first.
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x
                WHEN 'A' THEN len(ws) < 100
                WHEN 'B' THEN 100 * len(list_distinct(ws)) < 80 * len(ws)
                WHEN 'C' THEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t)
                WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
                ELSE w.doc_id > first END) AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
              FROM w LEFT JOIN l USING (doc_id)),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM f GROUP BY part, fails),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT o, unnest(generate_series(1, 5)) AS step FROM orders),
        s AS (SELECT part, o, step, n, good, toxic, fails, list_contains(fails, o[step:step]) AS own,
                len(list_filter(fails, lambda x: contains(o[1:step - 1], x))) > 0 AS before FROM c, steps),
        r AS (SELECT part, o AS filter_order, step, o[step:step] AS x,
                coalesce(sum(n) FILTER (NOT before AND NOT own), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (NOT before AND own), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (before AND own), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (own AND len(fails) = 1), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (NOT before AND own), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (NOT before AND own), 0)::BIGINT AS toxic_lost
              FROM s GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
        FROM r
    """,
    # All pairs of equal words at a lag up to a quarter of the text; stretches of pairs; those in one of less period go.
    "op12_periodic_runs": r"""
        WITH codes AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS raw,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM documents),
        places AS (SELECT doc_id, raw, len(raw) AS n, h, h // 10 AS g, (h // 10) % len(raw) AS a FROM codes),
        periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM places),
        d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(generate_series(0, n - 1),
                lambda i: CASE WHEN i < a THEN raw[i + 1] ELSE raw[a + (i - a) % p + 1] END) ELSE raw END AS ws FROM periods),
        w AS (SELECT doc_id, n, unnest(generate_series(0, n - 1)) AS i, unnest(ws) AS word FROM d WHERE n >= 6),
        pairs AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM w x JOIN w y
              ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
        islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
        long AS (SELECT doc_id, q, min(i) - q AS s, count(*) + q AS len FROM islands GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long o WHERE o.doc_id = r.doc_id AND o.q < r.q
              AND o.s <= r.s AND o.s + o.len >= r.s + r.len)),
        dropped AS (SELECT doc_id, list(DISTINCT i) AS gone FROM
              (SELECT doc_id, unnest(generate_series(s + q, s + len - 1)) AS i FROM runs) GROUP BY doc_id),
        best AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                first({'s': s, 'len': len, 'q': q} ORDER BY len DESC, s, q) AS r FROM runs GROUP BY doc_id),
        kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM w LEFT JOIN dropped USING (doc_id)
              WHERE gone IS NULL OR NOT list_contains(gone, i) GROUP BY w.doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, r.s::BIGINT AS start, r.len::BIGINT AS length, r.q::BIGINT AS period,
               (1000 * r.len // r.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(CASE WHEN n < 6 THEN array_to_string(ws, ' ') ELSE coalesce(t, '') END) AS collapsed_sha256
        FROM d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    # Every string of 200 bytes of every text, as hexadecimal digits.
    "op13_repeats": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        blocks AS (SELECT doc_id, b, len(h) // 2 - 199 AS n, substr(h, 2 * b + 1, 1422) AS block
              FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199, 512)) AS b FROM d WHERE len(h) >= 400)),
        s AS (SELECT doc_id, i, md5_number(substr(block, 2 * (i - b) + 1, 400)) AS code
              FROM (SELECT *, unnest(range(b, least(b + 512, n))) AS i FROM blocks)),
        twice AS (SELECT code FROM s GROUP BY code HAVING count(*) > 1),
        hits AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
              FROM s WHERE code IN (SELECT code FROM twice)),
        marked AS (SELECT *, sum(CASE WHEN prior IS NULL OR i > prior + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span
              FROM hits),
        spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM marked GROUP BY doc_id, span),
        gaps AS (SELECT *, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM spans),
        r AS (SELECT d.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, substr(any_value(h), 1, 2 * min(a)) ||
                string_agg(CASE WHEN next IS NULL THEN substr(h, 2 * b + 1) ELSE substr(h, 2 * b + 1, 2 * (next - b)) END, '' ORDER BY a) AS rest
              FROM gaps JOIN d USING (doc_id) GROUP BY d.doc_id)
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
        FROM d LEFT JOIN r USING (doc_id)
    """,
}
