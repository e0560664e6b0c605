"""SimHash groups, components, line and substring dedup."""

import random
from itertools import combinations

import numpy as np
import xxhash

import corpus_pipeline
from gondola.llm import chunk_dedup, line_winnow, simhash_index as si
from gondola.llm.components import components
from helpers import WORD, docs, edge_texts, lower, prose


def naive_fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, bits=4):
    """Smallest id of each one's group, by comparing all pairs."""
    label = dict(zip(ids, ids))
    moved = True
    while moved:
        moved = False
        for a, b in combinations(range(len(ids)), 2):
            if bin(prints[a] ^ prints[b]).count("1") <= bits:
                low = min(label[ids[a]], label[ids[b]])
                moved |= label[ids[a]] != low or label[ids[b]] != low
                label[ids[a]] = label[ids[b]] = low
    return label


def test_position_sets_cover_all_fours():
    chosen = si.position_sets()
    assert len(chosen) == 20
    assert all(any(set(t) <= set(four) for t in chosen) for four in combinations(range(8), 4))


def test_simhash_against_all_pairs(spark):
    rng = random.Random(7)
    texts = edge_texts(rng) + [prose(rng, 60) for _ in range(15)]
    for k in range(25):  # near copies, in chains
        words = texts[-1 - k % 5].split(" ")
        words[rng.randrange(len(words))] = "changed" + str(k)
        texts.append(" ".join(words))
    ids = rng.sample(range(1000), len(texts))
    rows = {r.doc_id: r for r in si.near_duplicates(docs(spark, texts, ids)).collect()}
    prints = [naive_fingerprint(t) for t in texts]
    assert [int(rows[i].fingerprint, 16) for i in ids] == prints
    label = groups(ids, prints)
    assert {i: rows[i].component_id for i in ids} == label and len(set(label.values())) < len(ids)
    kept = si.first_of_group(docs(spark, texts, ids)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label.values()))


def test_long_posting_lists_are_split(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    points = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(120)}
    points |= {rng.getrandbits(64) for _ in range(30)}
    signed = np.array(sorted(points), np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    wanted = groups(signed, sorted(points))
    for block in (7, 4096):
        found = {r.node: r.root for r in components(si.links(table, block=block)).collect()}
        by_root = {}
        for p in signed:
            by_root.setdefault(found.get(p, p), set()).add(wanted[p])
        assert all(len(x) == 1 for x in by_root.values()) and len(by_root) == len(set(wanted.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(21)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_row_stays_of_repeated_rows(spark):
    table = docs(spark, ["a b c d e"] * 4 + [None, ""], [3, 3, 5, None, 9, 8]).selectExpr("*", "1 AS count", "2 AS fingerprint")
    kept = si.first_of_group(table)
    assert kept.columns == table.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("3", "a b c d e"), ("8", "")]
    assert si.first_of_group(docs(spark, [])).count() == 0 and si.near_duplicates(docs(spark, [])).count() == 0


def naive_lines(rows, span=2, min_words=10, long_words=50):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        words = [len(WORD.findall(x)) for x in lines]
        full = [k for k, n in enumerate(words) if n]
        windows = [[k] for k in full if words[k] >= long_words]
        windows += [full[j : j + span] for j in range(len(full) - span + 1)]
        gone = set()
        for w in sorted(windows):
            if len(w) == 1 or sum(words[k] for k in w) >= min_words:
                content = tuple(lines[k] for k in w)
                gone |= set(w) if content in seen else set()
                seen.add(content)
        out[i] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.choice([1, 4, 7, 60])) for _ in range(12)] + ["", " ", "x"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += [t for t in edge_texts(rng) if t is not None]
    table = docs(spark, texts).selectExpr("*", "1 AS removed", "2 AS hash", "3 AS n_removed")
    rows = line_winnow.dedup_lines(table).collect()
    assert {r.doc_id: (r.n_removed, r.text) for r in rows} == naive_lines(list(enumerate(texts)))
    assert rows[0].removed == 1 and rows[0].hash == 2 and len(rows) == len(texts)


def naive_runs(rows, span=2, min_words=10, long_words=50):
    """All runs of any length are compared: the longest shared with an earlier place goes."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        words = [len(WORD.findall(x)) for x in lines]
        full = [k for k, n in enumerate(words) if n]
        gone = set()
        for a in range(len(full)):
            for b in range(a + 1, len(full) + 1):
                run = full[a:b]
                least = long_words if len(run) < span else min_words
                if sum(words[k] for k in run) >= least:
                    content = tuple(lines[k] for k in run)
                    gone |= set(run) if content in seen else set()
                    seen.add(content)
        out[i] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_whole_runs_of_short_lines(spark):
    rng = random.Random(19)
    verse = "\n".join(prose(rng, 1 + k % 4) for k in range(40))
    texts = [prose(rng, 20) + "\n" + verse + "\n" + prose(rng, 20), verse + "\n" + prose(rng, 20), "x\n" + verse + "\ny"]
    rows = {r.doc_id: r for r in line_winnow.dedup_lines(docs(spark, texts), whole_runs=True).collect()}
    assert rows[0].text == texts[0] and rows[1].text == texts[1].split("\n")[-1] and rows[2].text == "x\ny"
    pool = [prose(rng, rng.choice([1, 2, 3, 4, 9, 60])) for _ in range(6)] + ["", " "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 16))) for _ in range(40)]
    rows = line_winnow.dedup_lines(docs(spark, texts), whole_runs=True).collect()
    assert {r.doc_id: (r.n_removed, r.text) for r in rows} == naive_runs(list(enumerate(texts)))


def test_matches_are_extended_to_whole_runs(spark):
    """A shared run of long and short lines is one run, from its first line to its last; op9's
    rule counts words in it. Lines below ten words together meet no window with that minimum."""
    rng = random.Random(21)
    run = [prose(rng, n) for n in (2, 3, 12, 1, 2, 2, 60, 3, 1)]
    own = [prose(rng, 30) for _ in range(4)]
    texts = ["\n".join([own[0], *run, own[1]]), "\n".join([own[2], own[3], "", *run[:4], " ", *run[4:], "end"])]
    found = line_winnow.extended(line_winnow.matches(docs(spark, texts))).collect()
    assert [(r.doc_id, r.first, r.words, r.origin.doc_id, r.origin.first) for r in found] == [
        (1, 2, [2, 3, 12, 1, 2, 2, 60, 3, 1], 0, 1)
    ]
    rows = {r.doc_id: (r.n_removed, r.text) for r in line_winnow.dedup_lines(docs(spark, texts)).collect()}
    assert rows == naive_lines(list(enumerate(texts))) and rows[1][0] == 6
    whole = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs(spark, texts), whole_runs=True).collect()}
    assert whole == {0: texts[0], 1: "\n".join([own[2], own[3], "", " ", "end"])}


def test_lines_of_other_windows(spark):
    rng = random.Random(22)
    pool = [prose(rng, rng.choice([1, 3, 5, 60])) for _ in range(8)] + ["", " "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(40)]
    for limits in ({"span": 3, "min_words": 8}, {"span": 4, "min_words": 12}, {"span": 1, "min_words": 1, "long_words": 1000}):
        rows = line_winnow.dedup_lines(docs(spark, texts), **limits).collect()
        assert {r.doc_id: (r.n_removed, r.text) for r in rows} == naive_lines(list(enumerate(texts)), **limits)


def test_pipeline_deletes_repeats_in_short_lines(spark):
    rng = random.Random(20)
    verse = "\n".join(prose(rng, 3) for _ in range(30))
    own = [prose(rng, 30) for _ in range(2)]
    table = docs(spark, [own[0] + "\n" + verse, verse + "\n" + own[1]])
    rows = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert rows[0].text.endswith(verse) and rows[1].text == own[1] and rows[1].n_chars == len(own[1])


def test_lines_nulls_and_repeated_rows(spark):
    text = "\n".join(f"line {k} of a text that has words enough" for k in range(5))
    rows = line_winnow.dedup_lines(docs(spark, [text, text, text, None], [1, 1, 2, None])).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.text) for r in rows) == [
        ("1", 0, text), ("1", 0, text), ("2", 5, ""), ("None", 0, None),
    ]
    assert line_winnow.dedup_lines(docs(spark, [])).count() == 0


def naive_cuts(t):
    out, s = [], 0
    while s < len(t):
        e = None
        for i in range(s + 32, min(len(t), s + 1024) + 1):
            h = 0
            for b in t[i - 32 : i]:
                h = ((h << 1) + int(chunk_dedup.GEAR[b])) & 0xFFFFFFFF
            if h >> 27 == 0 and (i == len(t) or t[i] & 0xC0 != 0x80):
                e = i
                break
        if e is None:
            e = min(len(t), s + 1024)
            while e < len(t) and t[e] & 0xC0 == 0x80:
                e += 1
        out.append(e)
        s = e
    return out


def test_cuts_against_the_definition():
    rng = random.Random(10)
    texts = ["".join(rng.choice("abé ü\U0001f600ñcd\n") for _ in range(rng.randint(0, 300))).encode() for _ in range(12)]
    texts += [b"", ("é" * 900).encode(), b"a" * 2500]
    assert chunk_dedup.cuts(texts) == [naive_cuts(t) for t in texts]


def naive_removed(texts):
    """Bytes deleted of each text: chunks by a dictionary, their runs extended byte by byte."""
    first, removed = {}, {}
    coded = [(t or "").encode() for t in texts]
    for i, data in enumerate(coded):
        spans, start = {}, 0
        for end in naive_cuts(data):
            if first.setdefault(data[start:end], (i, start)) != (i, start):
                spans[start] = end, first[data[start:end]]
            start = end
        stops = {end for end, _ in spans.values()}
        more = []
        for start, (end, (j, at)) in spans.items():
            other = coded[j]
            if start not in stops:
                a, b = start, at
                while a and b and data[a - 1] == other[b - 1]:
                    a, b = a - 1, b - 1
                while a < len(data) and data[a] & 0xC0 == 0x80:
                    a += 1
                more.append((a, start - a))
            if end not in spans:
                a, b = end, at + end - start
                while a < len(data) and b < len(other) and data[a] == other[b]:
                    a, b = a + 1, b + 1
                while a < len(data) and data[a] & 0xC0 == 0x80:
                    a -= 1
                more.append((end, a - end))
        both = sorted([*((s, e - s) for s, (e, _) in spans.items()), *more])
        removed[i] = sum(b - a for a, b in chunk_dedup.runs(both))
    return removed


def test_short_passages_go_whole(spark):
    rng = random.Random(51)
    texts = []
    for _ in range(60):
        passage = prose(rng, 51, "abcdefgé日")
        texts += [prose(rng, rng.randint(1, 30)) + " " + passage + " " + prose(rng, 20), prose(rng, rng.randint(1, 30)) + passage]
    rows = {r.doc_id: r for r in chunk_dedup.dedup_substrings(docs(spark, texts), window=16).collect()}
    assert {i: r.n_removed for i, r in rows.items()} == naive_removed(texts)
    missed = sum(rows[i].n_removed < 51 for i in range(1, len(texts), 2))
    assert missed <= 1
    # What two long texts without a cut share, beyond many windows.
    texts = ["x" + prose(rng, 40) + "a" * 5000, "yz" + prose(rng, 40) + "a" * 5000 + "b"]
    rows = chunk_dedup.dedup_substrings(docs(spark, texts), window=16).collect()
    assert {r.doc_id: r.n_removed for r in rows} == naive_removed(texts)


def test_substrings(spark):
    rng = random.Random(11)
    passage = prose(rng, 80)
    own = [prose(rng, 60) for _ in range(6)]
    texts = [own[0] + " " + passage + " " + own[1], own[2] + "é " + passage, passage + own[3], own[4], None, "", own[5], own[5]]
    table = docs(spark, texts).selectExpr("*", "1 AS n_removed", "2 AS spans")
    rows = {r.doc_id: r for r in chunk_dedup.dedup_substrings(table).collect()}
    assert sum(passage in (r.text or "") for r in rows.values()) == 1 and passage in rows[0].text
    for i in (0, 3, 4, 5, 6):
        assert rows[i].text == texts[i] and rows[i].n_removed == 0
    assert rows[1].text.startswith(own[2]) and rows[2].text.endswith(own[3]) and rows[7].text == ""
    assert rows[1].n_removed > 100 and rows[0].spans == 2
    removed = naive_removed(texts)
    assert removed == {i: r.n_removed for i, r in rows.items()}
    again = chunk_dedup.dedup_substrings(docs(spark, [passage, passage, passage], [1, 1, None])).collect()
    assert sorted((str(r.doc_id), r.text) for r in again) == [("1", ""), ("1", ""), ("None", passage)]
    assert chunk_dedup.dedup_substrings(docs(spark, [])).count() == 0
