import re
from collections import Counter

from arealis.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if count[window] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measurements_match_brute_force(spark, awkward):
    again = "a b c d e f g h i j\n" * 3 + "x y z\n\n \nx y z\n#|<>&"
    overlap = " ".join(["w"] * 23) + " ü end"
    more = awkward.union(awkward.limit(2).replace(1, 50, ["doc_id"]).fillna(again).replace("", overlap, ["text"]))
    got = rules.report(more).collect()
    want = {r.doc_id: brute(r.text) for r in more.collect()}
    texts = Counter((r.doc_id, brute(r.text)) for r in more.collect())
    assert len(want) > 5
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == texts


def test_policies_read_the_ledger(awkward, nothing):
    book = rules.ledger(awkward)
    for version, mask in rules.POLICIES.items():
        rows = rules.apply_policy(book, version).collect()
        assert all(r.kept == (r.failures & mask == 0) for r in rows)
    report = rules.report(awkward).collect()
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in report)
    assert not any(r.kept for r in report if r.base_failed)
    alone = {r.rule: (r.failed, r.failed_alone) for r in rules.ablations(book, "v2").collect()}
    bits = [r.failures for r in book.collect()]
    for i, (name, _) in enumerate(rules.RULES):
        assert alone.get(name, (0, 0)) == (sum(b >> i & 1 for b in bits), sum(b == 1 << i for b in bits))
    assert rules.report(nothing).count() == 0


def test_good_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1")
    book = rules.report(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    assert book.filter("not kept and not base_failed").count() == 0
