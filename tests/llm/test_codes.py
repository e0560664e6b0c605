"""Vector codes by cover-tree Lloyd rounds."""

import collections
import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from gondola.llm import covertree_codes as codes, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) of each row and the codebooks' digest, by comparing
    every part with every entry."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    x = np.floor(np.array([r[1] for r in rows], np.float64) * 4096).astype(np.int64)
    size = x.shape[1] // parts
    cut = x.reshape(len(x), parts, size)
    books = cut[:entries].transpose(1, 0, 2).copy()

    def assign():
        return np.stack([((cut[:, p, None] - books[p]) ** 2).sum(2).argmin(1) for p in range(parts)], axis=1)

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                of = cut[found[:, p] == e, p]
                if len(of):
                    books[p, e] = [int(v) // len(of) for v in of.sum(axis=0)]
    found = assign()
    error = sum(((cut[:, p] - books[p][found[:, p]]) ** 2).sum(1) for p in range(parts))
    by_label = collections.Counter()
    for r, e in zip(rows, error):
        by_label[r[2]] += int(e)
    out = [(r[0], "".join(f"{c:02x}" for c in f), int(e), by_label[r[2]]) for r, f, e in zip(rows, found, error)]
    return out, hashlib.sha256(",".join(str(v) for v in books.reshape(-1)).encode()).hexdigest()


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_tree_covers_and_separates():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-300, 300, (500, 4)), np.zeros((200, 4), np.int64)])
    tree = codes.Tree(points)
    assert sorted(tree.order) == list(range(700))
    for k in range(len(tree.first)):
        rows = tree.order[tree.first[k] : tree.first[k] + tree.count[k]]
        away = np.sqrt(((points[rows] - points[tree.centre[k]]) ** 2).sum(1))
        assert away.max() <= tree.radius[k] and (tree.sums[k] == points[rows].sum(0)).all()
        if tree.children[k]:
            below = range(tree.child[k], tree.child[k] + tree.children[k])
            assert sum(tree.count[c] for c in below) == tree.count[k]
            centres = points[tree.centre[list(below)]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) + np.eye(len(centres)) * 1e9
            assert apart.min() > tree.radius[k] / 2 * (1 - 1e-6)
    back = codes.Tree.unpack(tree.pack(), points)
    assert all((getattr(back, f) == getattr(tree, f)).all() for f in (*codes.Tree.FIELDS, "sums"))


def test_walk_equals_all_comparisons_and_takes_subtrees():
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (9, 5))
    points = np.repeat(centres, 200, axis=0) + rng.integers(-40, 40, (1800, 5))
    tree = codes.Tree(points)
    for entries in (centres, np.concatenate([centres, centres[:3]]), points[:16], points[:1]):
        found = codes.Assigned(tree, points, entries, True)
        wanted = codes.squared(points, entries).argmin(1)
        assert (found.labels == wanted).all()
        for e in range(len(entries)):
            assert found.count[e] == (wanted == e).sum()
            assert (found.sums[e] == points[wanted == e].sum(0)).all()
    assert codes.Assigned(tree, points, centres, False).whole > 0.9 * len(points)


@pytest.mark.parametrize("block", [37, 8192])
def test_codes_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = [(int(k) * 3, [float(v) for v in rng.normal(0, 0.2, 16).astype("f4")], int(k % 4) or None) for k in rng.permutation(300)]
    rows += [(9999 + k, rows[5][1], 2) for k in range(40)]  # copies
    bad = [(1, None, 1), (2, [0.0] * 15 + [None], 1), (4, [float("nan")] + [0.0] * 15, 1), (5, [float("inf")] * 16, 2)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    for name in ("code", "error", "points", "x"):
        frame = frame.selectExpr("*", f"'clash' AS {name}")
    found, books = codes.compress(frame, block=block)
    wanted, digest = brute(rows)
    assert order(found.select("vec_id", "code", "error", "label_error").collect()) == order(wanted)
    assert codes.digest(books) == digest
    back = {r.vec_id: r.vector for r in codes.decompress(found, books).collect()}
    error = {r.vec_id: r.error for r in found.collect()}
    for vec_id, x, _ in rows[:20]:
        apart = np.floor(np.array(x) * 4096) - np.array(back[vec_id]) * 4096
        assert round((apart**2).sum()) == error[vec_id]


def test_few_ties_nulls_and_empty(spark):
    rows = [(7, [0.5] * 8, None), (7, [0.5] * 8, None), (None, [-0.5] * 8, None)]
    found, books = codes.compress(spark.createDataFrame(rows, SCHEMA))
    wanted, digest = brute(rows)
    assert order(found.select("vec_id", "code", "error", "label_error").collect()) == order(wanted)
    assert codes.digest(books) == digest and books.shape == (8, 3, 1)
    assert {r.code for r in found.collect()} == {"00" * 8, "02" * 8}  # of equal entries the first
    empty, _ = codes.compress(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert empty.collect() == []
    for width in ([0.0] * 12, [0.0] * 16, [20000.0] * 8):
        with pytest.raises(Exception, match="components"):
            codes.compress(spark.createDataFrame(rows + [(0, width, 1)], SCHEMA))[0].collect()


def test_query_on_the_given_table(spark, sf):
    table = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    wanted, digest = brute([(r["vec_id"], r["embedding"], r["label"]) for r in table])
    rows = queries.op12_vector_codes(spark, sf).collect()
    assert order(r[:4] for r in rows) == order(wanted)
    assert {r.codebooks_sha256 for r in rows} == {digest}
