"""The quality ledger and host reputation."""

import random
from collections import Counter

from gondola.llm import host_reputation, quality_ledger as q
from helpers import WORD, docs, edge_texts, prose


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_against_brute_force(spark):
    rng = random.Random(1)
    texts = edge_texts(rng) + [prose(rng, rng.randint(0, 80), "ab") for _ in range(60)] + ["a b c " * 50, "x\ny\nx\n\nx y\n#|&"]
    out = q.ledger(docs(spark, texts)).collect()
    assert len(out) == len(texts)
    for row in out:
        assert brute(row.text) == (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)


def test_policies_and_ablation(spark):
    rng = random.Random(2)
    good = " ".join(f"{prose(rng, 1)}{k}" for k in range(60))
    table = docs(spark, [good, "short", "a b c " * 40, " ".join(f"w{k} ###" for k in range(60)), None])
    judged = q.apply_policy(q.ledger(table))
    assert [r.doc_id for r in judged.where("kept").collect()] == [0]
    assert [r.doc_id for r in q.kept_rows(table).collect()] == [0]
    rows = {r["rule"]: r for r in q.ablation(q.ledger(table)).collect()}
    assert rows["few_words"].n_failed == 2 and rows["few_words"].n_alone == 2
    assert rows["symbols"].n_alone == 0 or rows["symbols"].n_failed == 1
    assert q.apply_policy(q.ledger(table), ("base", 1)).where("kept").count() == 2


def test_ledger_empty_and_clashing(spark):
    table = docs(spark, ["one two"]).selectExpr("*", "7 AS n_words", "'x' AS kept", "1 AS row")
    assert q.kept_rows(table).columns == table.columns and q.kept_rows(table).count() == 0
    assert q.ledger(table).first().n_words == 2
    assert q.ledger(docs(spark, [])).count() == 0


PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


def judge(spark, urls, labels, **k):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    rows = host_reputation.judge(pages, spark.createDataFrame(labels, LABELS), **k).collect()
    return {r.page_id: r for r in sorted(rows, key=lambda r: r.page_id)}


def test_url_parts_and_rules(spark):
    urls = [
        "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "http://x.com/fr/a", "http://x.com/de/",
        "http://org?q", "no scheme", None, "http://h.net", "http://myexample.org/es/", "://", "a://b://c/d", "http://é.com/fr/",
    ]
    rows = judge(spark, urls, [])
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows.values()] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("x.com", "/fr/a", "com/fr/", "allow"), ("x.com", "/de/", "com/de/", "block"), ("org", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("h.net", "", None, "allow"),
        ("myexample.org", "/es/", "org/", "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"),
        ("é.com", "/fr/", "com/fr/", "allow"),
    ]


def test_reputation_shrinks_to_the_domain(spark):
    urls = [f"http://bad.x.net/{k}" for k in range(40)] + [f"http://good{k % 9}.y.net/" for k in range(90)] + ["http://new.x.net/", "http://new.y.net/"]
    labels = [(k, 0, 0) for k in range(40)] + [(k, 1, 0) for k in range(40, 130)] + [(5, 1, 0), (None, 0, 1), (999, 0, 0)]
    rows = judge(spark, urls, labels)
    assert rows[0].verdict == "block" and rows[0].n_labels == 40 and rows[0].n_bad == 40
    assert rows[60].verdict == "allow"
    assert rows[130].n_labels == 0 and rows[130].bad_mean > rows[131].bad_mean
    assert rows[130].bad_bound < rows[0].bad_bound


def test_no_pages(spark):
    assert judge(spark, [], [(1, 0, 0)]) == {}
