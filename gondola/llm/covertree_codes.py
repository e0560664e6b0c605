"""Vector codes by product quantization, its codebooks found by Lloyd rounds over cover trees.

Components are whole numbers. A vector is cut into equal consecutive parts, each of which is
replaced by the index of the nearest entry of its codebook.

Every task cuts its vectors into blocks and builds, once, a cover tree per block and part: a
node covers all points within its radius of its centre, and its children are centres more than
half of that apart, down to small leaves. Each node carries the number and the sum of its
points, got by differences of cumulative sums, as its points lie side by side. In a round a node
at distance d of its nearest entry keeps the entries within d + 2 * radius; all others are
farther from each of its points, by the triangle inequality. Where one entry is left, the whole
subtree is its, and number and sum are added at once. Only nodes with several entries left go on
to their children, and at last to exact comparisons of single points. Distances to compare are
squared whole numbers, so ties are exact; square roots, used to drop entries only, get a margin.

A round sends at most entries x dimensions sums per task, and as many come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.sources.shared import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Vectors of a block, and the points up to which a node is a leaf.
BLOCK = 8192
LEAF = 8
# Components stay below 2^26, so that squared distances of any 1,024 of them are exact.
LARGEST = 1 << 26
_FAR = np.iinfo(np.int64).max


class Tree:
    """A cover tree over the rows of `points`: `order` puts the points of each node side by side,
    from `first` on, `count` of them; children of a node are consecutive nodes."""

    FIELDS = ("order", "first", "count", "child", "children", "centre", "radius")

    def __init__(self, points: np.ndarray):
        n = len(points)
        order = np.arange(n)
        first, count, radius, child, children, centre = [], [], [], [], [], []

        def add(start, size, at, far):
            first.append(start), count.append(size), centre.append(at), radius.append(far)
            child.append(0), children.append(0)

        exact = points.astype(np.float64)
        norms = (exact * exact).sum(axis=1)
        waiting = []
        if n:
            far = self._distances(exact, norms, order, 0)
            add(0, n, 0, far.max())
            waiting.append((0, far))
        for node, far in waiting:  # grows while it is read: breadth first
            start, size = first[node], count[node]
            if size <= LEAF or radius[node] == 0:
                continue
            reach = radius[node] / 2
            members = order[start : start + size]
            own = far <= reach
            parts = [(centre[node], members[own], far[own])]
            rest = members[~own]
            while len(rest):
                at = rest[0]
                away = self._distances(exact, norms, rest, at)
                near = away <= reach
                parts.append((at, rest[near], away[near]))
                rest = rest[~near]
            child[node], children[node] = len(first), len(parts)
            for at, of, away in parts:
                order[start : start + len(of)] = of
                add(start, len(of), at, away.max())
                waiting.append((len(first) - 1, away))
                start += len(of)
        self.order, self.first, self.count = order, np.array(first, np.int64), np.array(count, np.int64)
        self.child, self.children = np.array(child, np.int64), np.array(children, np.int64)
        self.centre = np.array(centre, np.int64)
        self.radius = np.nextafter(np.array(radius, np.float32), np.float32(np.inf))
        self._add_up(points)

    def _add_up(self, points: np.ndarray) -> None:
        upto = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points[self.order], axis=0, out=upto[1:])
        self.sums = upto[self.first + self.count] - upto[self.first]

    @staticmethod
    def _distances(points, norms, among, at):
        squares = norms[among] + norms[at] - 2 * (points[among] @ points[at])
        return np.sqrt(np.maximum(squares, 0))

    def pack(self) -> list[bytes]:
        """Arrays as bytes; places in 16 bits where the block is small enough."""
        place = "<u2" if len(self.order) < 1 << 16 else "<u4"
        return [getattr(self, f).astype("<f4" if f == "radius" else place).tobytes() for f in self.FIELDS]

    @classmethod
    def unpack(cls, fields: list[bytes], points: np.ndarray) -> "Tree":
        tree = cls.__new__(cls)
        place = "<u2" if len(points) < 1 << 16 else "<u4"
        for name, data in zip(cls.FIELDS, fields):
            kept = np.frombuffer(data, "<f4" if name == "radius" else place)
            setattr(tree, name, kept if name == "radius" else kept.astype(np.int64))
        tree._add_up(points)
        return tree


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers, points by entries."""
    out = np.empty((len(points), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        apart = points - entry
        np.einsum("ij,ij->i", apart, apart, out=out[:, k])
    return out


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each span, one after another."""
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return np.arange(int(count.sum())) + shift


class Assigned:
    """What a walk down the tree finds: numbers and sums per entry, and the labels if wanted.
    `whole` counts the points that were assigned with their subtree."""

    def __init__(self, tree: Tree, points: np.ndarray, entries: np.ndarray, label: bool):
        k = len(entries)
        self.count = np.zeros(k, np.int64)
        self.sums = np.zeros((k, points.shape[1]), np.int64)
        self.labels = np.empty(len(points), np.uint8) if label else None
        self.whole = 0
        nodes = np.zeros(min(len(tree.first), 1), np.int64)
        open_ = np.ones((len(nodes), k), bool)
        while len(nodes):
            squares = np.where(open_, squared(points[tree.centre[nodes]], entries), _FAR)
            away = np.sqrt(squares.astype(np.float64))
            reach = away.min(axis=1) + 2.0 * tree.radius[nodes].astype(np.float64)
            # A margin for the rounding of square roots and of the radius.
            open_ = open_ & (away <= (reach * (1 + 1e-9) + 1e-6)[:, None])
            nearest = squares.argmin(axis=1)
            sure = open_.sum(axis=1) == 1
            self._subtrees(tree, nodes[sure], nearest[sure])
            leaf = ~sure & (tree.children[nodes] == 0)
            self._points(tree, points, entries, nodes[leaf], open_[leaf])
            down = ~sure & ~leaf
            below = nodes[down]
            open_ = np.repeat(open_[down], tree.children[below], axis=0)
            nodes = _spans(tree.child[below], tree.children[below])

    def _subtrees(self, tree, nodes, entry):
        np.add.at(self.count, entry, tree.count[nodes])
        np.add.at(self.sums, entry, tree.sums[nodes])
        self.whole += int(tree.count[nodes].sum())
        if self.labels is not None and len(nodes):
            rows = tree.order[_spans(tree.first[nodes], tree.count[nodes])]
            self.labels[rows] = np.repeat(entry, tree.count[nodes])

    def _points(self, tree, points, entries, nodes, open_):
        if not len(nodes):
            return
        rows = tree.order[_spans(tree.first[nodes], tree.count[nodes])]
        open_ = np.repeat(open_, tree.count[nodes], axis=0)
        some = points[rows]
        nearest = np.where(open_, squared(some, entries), _FAR).argmin(axis=1)
        self.count += np.bincount(nearest, minlength=len(entries))
        np.add.at(self.sums, nearest, some)
        if self.labels is not None:
            self.labels[rows] = nearest


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * x) of every component; null for a vector that is null or holds a null or a
    component that is not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when(finite, F.transform(x, lambda v: F.floor(v * SCALE).cast("long")))


def _blocks(frames: Iterator[pa.RecordBatch], width: int, parts: int, block: int, label_type: pa.DataType):
    """Rows of vectors to rows of blocks with their trees. `width` components a vector."""
    held: list[pa.Table] = []

    def close(table: pa.Table):
        n = table.num_rows
        data = np.asarray(pa.concat_arrays(table.column(2).chunks).flatten(), np.int64)
        if data.size != n * width:
            raise ValueError(f"every vector must have {width} components")
        if data.size and max(int(data.max()), -int(data.min())) >= LARGEST:
            raise ValueError(f"components of {LARGEST // SCALE} and more are not supported")
        points = data.reshape(n, width)
        size = width // parts
        trees = [f for p in range(parts) for f in Tree(points[:, p * size : (p + 1) * size]).pack()]
        ends = pa.array([0, n], pa.int32())
        columns = [
            pa.ListArray.from_arrays(ends, pa.concat_arrays(table.column(0).cast(pa.int64()).chunks)),
            pa.ListArray.from_arrays(ends, pa.concat_arrays(table.column(1).cast(label_type).chunks)),
            pa.array([points.astype(_kind(points)).tobytes()], pa.binary()),
            pa.array([trees], pa.list_(pa.binary())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["vec_ids", "labels", "points", "trees"])

    for frame in frames:
        held.append(pa.Table.from_batches([frame]))
        while sum(t.num_rows for t in held) >= block:
            table = pa.concat_tables(held)
            yield close(table.slice(0, block))
            held = [table.slice(block)]
    if sum(t.num_rows for t in held):
        yield close(pa.concat_tables(held))


def _kind(points: np.ndarray) -> str:
    return "<i2" if not points.size or max(int(points.max()), -int(points.min())) < 1 << 15 else "<i4"


def _rows(frames: Iterator[pa.RecordBatch], *columns: str):
    for frame in frames:
        for k in range(frame.num_rows):
            yield tuple(frame.column(c)[k].as_py() for c in columns)


def _walk(n: int, points: bytes, trees: list[bytes], codebooks: np.ndarray, label: bool):
    """The part's columns and `Assigned`, part by part."""
    parts, _, size = codebooks.shape
    width = parts * size
    data = np.frombuffer(points, f"<i{len(points) // (n * width)}").astype(np.int64).reshape(n, width)
    each = len(Tree.FIELDS)
    for p in range(parts):
        some = np.ascontiguousarray(data[:, p * size : (p + 1) * size])
        tree = Tree.unpack(trees[p * each : (p + 1) * each], some)
        yield some, Assigned(tree, some, codebooks[p], label)


def _totals(frames: Iterator[pa.RecordBatch], codebooks: np.ndarray):
    """Numbers and sums of a task: rows (part, entry, position, n, total)."""
    parts, entries, size = codebooks.shape
    count, sums = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
    for n, points, trees in _rows(frames, "n", "points", "trees"):
        for p, (_, found) in enumerate(_walk(n, points, trees, codebooks, False)):
            count[p] += found.count
            sums[p] += found.sums
    part, entry, position = (x.reshape(-1) for x in np.indices(codebooks.shape))
    held = np.repeat(count.reshape(-1), size)
    used = held > 0
    columns = [part, entry, position, held, sums.reshape(-1)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c[used], pa.int64()) for c in columns], names=["part", "entry", "position", "n", "total"]
    )


def _codes(frames: Iterator[pa.RecordBatch], codebooks: np.ndarray, label_type: pa.DataType):
    for ids, labels, points, trees in _rows(frames, "vec_ids", "labels", "points", "trees"):
        code, error = [], 0
        for p, (some, found) in enumerate(_walk(len(ids), points, trees, codebooks, True)):
            apart = some - codebooks[p][found.labels]
            error = error + np.einsum("ij,ij->i", apart, apart)
            code.append(found.labels)
        text = np.stack(code, axis=1).tobytes().hex()
        each = 2 * len(code)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(labels, label_type),
                pa.array([text[k : k + each] for k in range(0, len(text), each)], pa.string()),
                pa.array(error, pa.int64()),
            ],
            names=["vec_id", "label", "code", "error"],
        )


def blocks(vectors: DataFrame, label_type: str, width: int, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """Blocks with their trees, from (vec_id, label, whole numbers); a function of each input
    partition, to be stored before it is used."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(vectors.schema["label"].dataType)
    return vectors.mapInArrow(
        lambda frames: _blocks(frames, width, parts, block, kind),
        f"vec_ids array<long>, labels array<{label_type}>, points binary, trees array<binary>",
    )


def lloyd(stored: DataFrame, codebooks: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts, entries, components) after some rounds over the stored blocks. An
    entry becomes the floor of its points' mean; one without points stays."""
    schema = "part long, entry long, position long, n long, total long"
    for _ in range(rounds):
        now = codebooks
        found = (
            stored.select(F.size("vec_ids").alias("n"), "points", "trees").mapInArrow(lambda frames: _totals(frames, now), schema)
            .groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        )
        codebooks = codebooks.copy()
        for part, entry, position, n, total in found.collect():
            codebooks[part, entry, position] = total // n
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks). codes has vec_id, label, code, error, label_error, a row for each row
    whose vector is whole: rows with a null vector, a null or a component that is not finite go.

    Codebooks start as the vectors of the smallest vec_ids; fewer rows give fewer entries. Rows
    with the same vec_id are kept each, and start in the order of their components; a null
    vec_id comes last. label_error adds up the errors of equal labels, null labels together. An
    empty table gives no rows. Only vec_id, label and the vector are read. Vectors of differing
    lengths, or of a length that does not divide into the parts, and components of 16,384 and
    more raise ValueError. An action: the blocks are written once and read in every round."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    label_type = table.schema["label"].dataType.simpleString()
    vectors = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", whole_numbers(F.col(f"`{vector}`")).alias("x")
    ).where(F.col("x").isNotNull())
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    width = len(first[0].x) if first else parts
    if width % parts or not width:
        raise ValueError(f"vectors of {width} components do not divide into {parts} equal parts")
    if any(len(row.x) != width for row in first):
        raise ValueError(f"every vector must have {width} components")
    if any(abs(v) >= LARGEST for row in first for v in row.x):
        raise ValueError(f"components of {LARGEST // SCALE} and more are not supported")
    start = np.array([row.x for row in first], np.int64).reshape(-1, parts, width // parts)
    stored = materialize(blocks(vectors, label_type, width, parts, block), "vector-blocks")
    codebooks = lloyd(stored, start.transpose(1, 0, 2).copy(), rounds) if first else start.transpose(1, 0, 2)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(table.schema["label"].dataType)
    schema = f"vec_id long, label {label_type}, code string, error long"
    coded = materialize(stored.mapInArrow(lambda frames: _codes(frames, codebooks, kind), schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined, codebooks


def decompress(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, vector): the entries that the codes name, in the scale of the vectors."""
    listed = F.lit([[[int(v) for v in entry] for entry in part] for part in codebooks.tolist()])
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    parts = [F.get(F.get(listed, F.lit(p)), index(p)) for p in range(len(codebooks))]
    return codes.select("vec_id", F.transform(F.concat(*parts), lambda v: v / F.lit(float(SCALE))).alias("vector"))
