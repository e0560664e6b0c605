"""Personal data, benchmark passages, main text of pages, the pipeline."""

import random
import re

from gondola.llm import html_subsequence as html, weak_pii as pii, winnow_contamination as wc
from helpers import docs, edge_texts, lower, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def naive_spans(text):
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_base_spans_against_the_patterns():
    rng = random.Random(12)
    parts = ["1", "2", "25", ".", ".", "@", "a", "-", " ", "+", "(", "00", "4111111111111111", "b.c", "@x.y", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == naive_spans(text), text
    for blob in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" * 100_000, "@" * 100_000):
        pii.base_spans(blob)  # in linear time


def test_detection(spark):
    rng = random.Random(13)
    texts = [f"{prose(rng, 5)} mail joe{k}@mail.example.com or 10.0.{k}.7 call +1 (212) 555-01{k + 10} {prose(rng, 4)}" for k in range(60)]
    two_cards = "pay 4111111111111111 5500005555555559 now"  # one run of digits to the base pattern
    texts += [f"card 4111 1111 1111 1111 {prose(rng, 3)}" for _ in range(30)] + [two_cards, None, "", "clean words only"]
    found, model = pii.detect(docs(spark, texts).selectExpr("*", "1 AS spans", "2 AS candidates"))
    rows = {r.doc_id: r.spans for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in rows[i] if s.base] == naive_spans(text or "")
    assert [len(rows[i]) for i in (91, 92, 93)] == [0, 0, 0]
    assert [two_cards[s.start : s.end].strip() for s in rows[90]] == ["4111111111111111", "5500005555555559"]
    assert model.reliability[0, 0, 1, pii.YES] > 0.9
    assert pii.detect(docs(spark, []))[0].count() == 0


def test_reliabilities_are_recovered():
    rng = random.Random(14)
    counts = {}
    for _ in range(20_000):
        real = rng.random() < 0.6
        right = [rng.random() < p for p in (0.95, 0.8, 0.7)]
        cast = [pii.YES if real == r else pii.NO for r in right] + [pii.NONE, pii.NONE]
        counts[c] = counts.get(c := pii.code(0, cast, [False] * 4), 0) + 1
    model = pii.fit(counts)
    for j, p in enumerate((0.95, 0.8, 0.7)):
        assert abs(model.reliability[0, j, 1, pii.YES] - p) < 0.05
    assert pii.decode(pii.code(3, [1, 2, 0, 1, 2], [1, 0, 0, 1])) == (3, [1, 2, 0, 1, 2], [1, 0, 0, 1])


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def naive_hits(texts, items):
    windows, sizes = {}, set()
    for name, text in items:
        words = TOKEN.findall(lower(text))
        n = min(10, len(words))
        if words:
            sizes.add(n)
            for i in range(len(words) - n + 1):
                windows.setdefault(tuple(words[i : i + n]), set()).add(str(name))
    for text in texts:
        words, hit, names = TOKEN.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        yield len(words), len(hit), sorted(names)


def test_contamination_against_brute_force(spark):
    rng = random.Random(15)
    items = [(k, prose(rng, rng.choice([0, 1, 4, 9, 10, 11, 30]), "ab")) for k in range(25)] + [(90, None), (91, "!!"), (92, "dup one"), (92, "dup two")]
    texts = edge_texts(rng) + [prose(rng, 40, "ab") for _ in range(20)]
    texts += [f"{prose(rng, 5)} {t.upper()}, {prose(rng, 3)}" for _, t in items if t] + ["dup one dup two"] * 3
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = list(naive_hits(texts, items))
    for block_bytes in (1 << 20, 200):
        out = wc.annotate(docs(spark, texts).selectExpr("*", "1 AS contamination", "2 AS n_hit"), bench, block_bytes=block_bytes)
        rows = {r.doc_id: r.contamination for r in out.collect()}
        assert [(rows[i].n_words, rows[i].n_hit, rows[i].item_ids) for i in range(len(texts))] == wanted
    assert wc.annotate(docs(spark, []), bench).count() == 0
    assert wc.annotate(docs(spark, ["a"]), bench.limit(0)).first().contamination.n_hit == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><h1>Title &amp; more &copy</h1><p>One<b>two</b>  three&nbsp;four.<br>five<p class="lead">Second <a href="x">link</a>.
<div class="ad-box"><div>Buy now</div></div><ul><li>item a<li>item b</ul><form><p>Your mail</p></form><!-- x > y -->
<p>Last &lt;p&gt; block</p></article><section id="comments"><h2>Comments</h2><p>Great post, thanks for this long comment</p></section>
</main><aside>side</aside><footer>&copy; x</footer></body></html>"""
TEXT = "Title & more ©\nOnetwo three four. five\nSecond link.\nitem a\nitem b\nLast <p> block"


def test_main_text(spark):
    pages = [PAGE, None, "", "no tags at all", "<p></p>", PAGE.split("</article>")[0], "<article>&am</article> &#65", PAGE]
    table = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in html.extract_pages(table.selectExpr("*", "1 AS text")).collect()}
    assert rows[0].text == rows[7].text == TEXT and rows[5].text == TEXT
    assert [rows[i].text for i in (1, 2, 3, 4)] == ["", "", "no tags at all", ""]
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert html.extract_pages(table.limit(0)).count() == 0


def test_best_region_is_the_maximum():
    rng = random.Random(16)
    weights = {"word": 1.0, "tag": -1.5, "dropped": -0.5}
    for _ in range(200):
        page = "".join(rng.choice(["<p>", "</p>", "<div>", "<td>", "a b ", "c", "<b>", "<br>"]) for _ in range(rng.randint(0, 12)))
        kept = list(html.tokens(page))
        score = [len(t.split()) if k == "text" else -1.5 for k, _, t, _ in kept]
        best = max((sum(score[i:j]) for i in range(len(score)) for j in range(i, len(score) + 1)), default=0)
        got = html.extract(page, weights)
        assert bool(got) == (best > 0)


def test_dropped_elements_end_and_wrappers_stay():
    text = "one two three four five six seven eight nine ten"

    def kept(page):
        return html.extract(page, {"word": 1.0, "tag": -0.1, "dropped": -0.1})

    for page in (
        f'<p class="ad">Buy<p>{text}</p><p>{text}</p>',
        f'<ul><li class="share">Buy</ul><p>{text}</p><p>{text}</p>',
        f'<ul><li class="share">Buy<li>{text}</ul><p>{text}</p>',
        f'<div><div class="ad">Buy<article><p>{text}</p><p>{text}</p></article></div>',
        f"<nav>Buy<main><p>{text}</p><p>{text}</p></main>",
        f"<body><header>Buy<article><p>{text}<p>{text}</article></body>",
        f'<div class="has-sidebar"><div class="sidebar">Buy</div><p>{text}</p><p>{text}</p></div>',
        f'<div id="page-header-fixed"><article><p>{text}</p><p>{text}</p></article></div><div class="ad">Buy {text}</div>',
        f'<table><tr><td class="ad">Buy<td><p>{text}</p><tr><td>{text}</table>',
        f'<section><span class="ad">Buy</section><p>{text}</p><p>{text}</p>',
        f"<main><p>{text}</p><p>{text}</p></main><div class=comments><article>Buy {text}</article></div>",
    ):
        assert kept(page) == f"{text}\n{text}", page


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    rng = random.Random(17)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    good = [" ".join(f"{prose(rng, 1, 'abcdefghijklmnop')}{k}" for k in range(120)) for _ in range(3)]
    texts = [good[0], good[0] + " end", good[1], good[2] + " " + bench, "short", None, ""]
    table = docs(spark, texts).selectExpr("*", "'x' AS n_words")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, sf)
        sizes.append(out.select("doc_id").distinct().count())
        if name != "packing":
            assert out.columns == table.columns
            table = out
            empty = stage(spark, table.limit(0), sf)
            assert empty.count() == 0 and empty.columns == table.columns
    assert sizes == [4, 4, 3, 2, 2]
