"""Entropy balancing of sources."""

import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gondola.llm import entropy_mixing, queries
from helpers import WORD

SCHEMA = "doc_id long, text string, source string"


def words(n):
    return " ".join(["w"] * n)


def wanted_targets(sizes):
    """Shares by weight with a limit, by whole fractions."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        free = sum(weight[s] for s in order if s not in stopped)
        share = Fraction(rest, free) if free else 0
        more = {s for s in order if s not in stopped and weight[s] * share > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in stopped else weight[s] * share for s in order}
        stopped |= more


def dual_tilt(pairs, target, mean):
    """By bisection."""
    low, high = -200.0, 200.0
    for _ in range(200):
        t = (low + high) / 2
        if sum(n * x * min(3, math.exp(min(t * x / mean, 50))) for x, n in pairs) < target:
            low = t
        else:
            high = t
    return t


def check(rows, docs):
    sizes, held = {}, {}
    for doc_id, text, source in docs:
        n = len(WORD.findall(text or ""))
        sizes[source] = sizes.get(source, 0) + n
        held.setdefault(source, []).append(n)
    targets = wanted_targets(sizes)
    assert len(rows) == len(docs)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(targets[r.source]), rel=1e-9)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, n in taken.items():
        some = [x for x in held[source] if x]
        assert abs(n - float(targets[source])) <= max(some, default=0)
    for source, target in targets.items():
        pairs = [(x, 1) for x in held[source] if x]
        if not pairs or target >= 3 * sizes[source]:
            continue
        mean = sum(x * x for x, _ in pairs) / sum(x for x, _ in pairs)
        t = dual_tilt(pairs, float(target), mean)
        for r in rows:
            if r.source == source and r["size"]:
                assert r.rate == pytest.approx(min(3, math.exp(t * r["size"] / mean)), rel=1e-5)


def test_mix_against_brute_force(spark):
    rng = random.Random(11)
    docs = [(k, words(rng.choice([0, 1, 3, 40, rng.randint(1, 300)])), rng.choice("abcdé")) for k in range(300)]
    docs += [(1000 + k, words(20), None) for k in range(5)] + [(2000, None, "a"), (None, words(7), "a"), (2001, "", "void")]
    docs += [(3000, words(5000), "z"), (3001, words(5000), "z")]
    found = entropy_mixing.mix(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()
    check(found, docs)


def test_hot_size_in_buckets(spark):
    docs = [(k, words(10), "a" if k % 3 else "b") for k in range(3000)] + [(9000, words(31), "a")]
    frame = spark.createDataFrame(docs, SCHEMA)
    found = entropy_mixing.mix(frame, bucket=50).collect()
    check(found, docs)
    whole = {r.source: r.copies for r in found if r["size"] == 10}
    for source in "ab":
        copies = [r.copies for r in found if r.source == source and r["size"] == 10]
        assert max(copies) - min(copies) <= 1
    assert whole
    again = entropy_mixing.mix(frame.repartition(7), bucket=50).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_given_targets_ties_and_empty(spark):
    docs = [(1, words(10), "a"), (1, words(10), "a"), (1, words(10), "a"), (2, words(10), "b"), (3, words(4), "c")]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("size", F.lit("clash")).withColumn("rate", F.lit(1))
    targets = spark.createDataFrame([("a", 20.0), ("b", 99.0)], "source string, target double")
    found = entropy_mixing.mix(frame, targets=targets).collect()
    assert sorted((r.doc_id, r.source, r.taken) for r in found) == [(1, "a", 0), (1, "a", 10), (1, "a", 10), (2, "b", 30), (3, "c", 0)]
    assert entropy_mixing.mix(frame.limit(0)).collect() == []
    void = entropy_mixing.mix(spark.createDataFrame([(1, None, None), (2, " \n", "x")], SCHEMA)).collect()
    assert [(r.size if False else r["size"], r.target, r.taken) for r in void] == [(0, 0.0, 0)] * 2


def test_diffusion_follows_the_rates():
    assert entropy_mixing.diffuse([100, 10, 1], [1, 4, 7], [0.4, 1.0, 1.0], 3) == [0, 8, 7]
    assert entropy_mixing.diffuse([5], [3], [3.0], 3) == [9]


def test_query_on_the_given_table(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries.op11_source_mixing(spark, sf).collect()
    sizes = {d: len(re.findall(WORD, t or "")) for d, t, _ in docs}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    source = {d: s for d, _, s in docs}
    total = {}
    for r in rows:
        total.setdefault((source[r.doc_id], r.target), []).append(r.taken)
    for (_, target), taken in total.items():
        assert abs(sum(taken) - target) <= 0.01 * target + 40
    assert any(0 < r.taken != r["size"] for r in rows)
