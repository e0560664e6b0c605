"""Benchmark decontamination by winnowing.

Words of a text become numbers of the benchmark's vocabulary (0 for words it lacks). Of every
window of consecutive k-grams the one of the smallest hash is a fingerprint, the rightmost on a
tie; k-grams with a word outside the vocabulary rank last and match nothing. Any run of
`span = window + k - 1` words that a document and an item share therefore contains a
fingerprint of both. Fingerprints of a document are joined with those of the items, and each
match is extended word by word both ways; runs of `span` words or more are hits. Items shorter
than `span` are matched whole, by the hash of all their words, and compared word by word.

The items are dealt to blocks by the hash of their id so that each block has a bounded size,
and each block is compared with all documents in one pass over them. A benchmark of one block
(the usual case) needs no shuffle of documents at all. Words are compared as numbers of an
exact dictionary, so that no hash decides about a hit.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gondola.llm.names import quoted

SPAN = 10
GRAM = 5
# Text of the items that one pass over the documents compares with.
BLOCK_BYTES = 16 << 20

# Bytes that are no word: ASCII other than digits and letters; capitals are lowered.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_LAST = np.uint64(2**64 - 1)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """One hash per k-gram of ids; the largest value where one of them is 0."""
    n = max(len(ids) - k + 1, 0)
    h = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for j in range(k):
        part = ids[j : j + n]
        h = _mix(h * np.uint64(31) + part.astype(np.uint64) + np.uint64(1))
        known &= part > 0
    return np.where(known, np.minimum(h, _LAST - np.uint64(1)), _LAST)


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the fingerprints: the rightmost minimum of every window, in order."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, window):
        part = hashes[j : j + n]
        take = part <= best
        best[take] = part[take]
        at[take] += j - (at[take] - np.arange(n)[take])
    at = at[best != _LAST]
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


class Items:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, items: list[tuple[str, str | None]], span: int = SPAN, gram: int = GRAM):
        self.span, self.gram = span, gram
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        learn = self.vocabulary
        rows = [np.array([learn.setdefault(w, len(learn) + 1) for w in words(t)], np.int64) for _, t in items]
        # All items' words with zeros between them, where no run goes on.
        gap = np.zeros(1, np.int64)
        self.flat = np.concatenate([gap, *(x for row in rows for x in (row, gap))])
        starts = 1 + np.concatenate(([0], np.cumsum([len(r) + 1 for r in rows])[:-1])).astype(np.int64) if rows else []
        prints, places, owners = [], [], []
        short = defaultdict(list)
        for k, (row, start) in enumerate(zip(rows, starts)):
            if len(row) >= span:
                h = gram_hashes(row, gram)
                at = winnowed(h, span - gram + 1)
                prints.append(h[at])
                places.append(at + start)
                owners.append(np.full(len(at), k))
            elif len(row):
                short[len(row)].append((gram_hashes(row, len(row))[0], int(start), k))
        self.index = self._sorted(prints, places, owners)
        self.short = {
            n: self._sorted(*([np.array([x[j]], np.uint64 if j == 0 else np.int64) for x in rows] for j in range(3)))
            for n, rows in short.items()
        }

    @staticmethod
    def _sorted(prints, places, owners):
        h = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        flat = [np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (places, owners)]
        return h[order], *flat

    def numbers(self, text: str | None) -> list[int]:
        get = self.vocabulary.get
        return [get(w, 0) for w in words(text)]

    @staticmethod
    def _joined(index, hashes, at):
        """Pairs of (place in the documents, place in the items, item) of equal hash."""
        h, places, owners = index
        low = np.searchsorted(h, hashes, "left")
        count = np.searchsorted(h, hashes, "right") - low
        which = np.repeat(np.arange(len(hashes)), count)
        within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        pick = low[which] + within
        return at[which], places[pick], owners[pick]

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs shared with items: first word, word after the last, item. `ids` begins and ends
        with 0 and has one between documents. The same run may come more than once."""
        hashes = gram_hashes(ids, self.gram)
        at = winnowed(hashes, self.span - self.gram + 1)
        d, b, owner = self._joined(self.index, hashes[at], at)
        # The first k words are compared too: equal hashes are only candidates.
        equal = np.ones(len(d), bool)
        for j in range(self.gram):
            equal &= ids[d + j] == self.flat[b + j]
        d, b, owner = d[equal], b[equal], owner[equal]
        left, right = d.copy(), d + self.gram
        for step, edge in ((-1, left), (1, right)):
            live = np.arange(len(d))
            x = d - 1 if step < 0 else d + self.gram
            y = b - 1 if step < 0 else b + self.gram
            while len(live):
                on = (ids[x] == self.flat[y]) & (ids[x] > 0)
                live, x, y = live[on], x[on] + step, y[on] + step
                edge[live] += step
        long = right - left >= self.span
        found = [(left[long], right[long], owner[long])]
        for n, index in self.short.items():
            hashes = gram_hashes(ids, n)
            at = np.flatnonzero(np.isin(hashes, index[0]))
            d, b, owner = self._joined(index, hashes[at], at)
            equal = np.ones(len(d), bool)
            for j in range(n):
                equal &= ids[d + j] == self.flat[b + j]
            found.append((d[equal], d[equal] + n, owner[equal]))
        return tuple(np.concatenate(x) for x in zip(*found))


SCHEMA = (
    "n_words long, n_hit long, n_items long, item_ids array<string>, "
    "hits array<struct<first: long, after: long>>"
)


def _compare(batch_of_texts: list, items: Items):
    """Per text: words, hit words, items, the hit runs merged."""
    ids, sizes = [0], []
    for text in batch_of_texts:
        numbers = items.numbers(text)
        ids += numbers
        ids.append(0)
        sizes.append(len(numbers))
    first, after, owner = items.matches(np.array(ids, np.int64))
    starts = 1 + np.concatenate(([0], np.cumsum(np.array(sizes[:-1], np.int64) + 1))).astype(np.int64)
    doc = np.searchsorted(starts, first, "right") - 1
    runs, names = defaultdict(set), defaultdict(set)
    for d, a, b, k in zip(doc.tolist(), (first - starts[doc]).tolist(), (after - starts[doc]).tolist(), owner.tolist()):
        runs[d].add((a, b))
        names[d].add(items.names[k])
    for d, n in enumerate(sizes):
        merged = merge(runs[d]) if d in runs else []
        yield n, sum(b - a for a, b in merged), len(names.get(d, ())), sorted(names.get(d, ())), merged


def merge(runs) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted(runs):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [tuple(x) for x in merged]


def annotate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, into: str = "contamination") -> DataFrame:
    """The documents with a column `into` of n_words, n_hit (words inside a shared run of `span`
    words, or inside a whole shorter item), n_items, item_ids (sorted) and hits (word ranges).

    Null and empty texts have no words. Items without words match nothing; items of the same
    id count once; a null id is the empty string. Repeated rows are judged each, an empty table
    or benchmark gives no rows or no hits. A column of the documents with that name is
    replaced. An action: the size of the benchmark is summed, and one block of its items after
    the other, each of about `block_bytes`, is sent to the tasks. With several blocks the
    hits of a row are merged as arrays of that row, in one narrow pass per block."""
    spark = docs.sparkSession
    chosen = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    )
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    names = [c for c in docs.columns if c.lower() != into.lower()]
    others = [quoted(c) for c in names if c.lower() != "text"]
    out = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    kinds = pa.struct([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("item_ids", pa.list_(pa.string())),
        ("hits", pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
    ])
    schema = T.StructType([*out.schema.fields, T.StructField("found", T.StructType.fromDDL(SCHEMA))])
    for block in range(blocks):
        rows = [tuple(r) for r in chosen.where(place == block).collect()]
        sent = spark.sparkContext.broadcast(rows)
        more = block > 0

        def run(frames, sent=sent, more=more):
            items = Items(sent.value, span, gram)
            for frame in frames:
                for k in range(0, frame.num_rows, 512):
                    part = frame.slice(k, 512)
                    found = list(_compare(part.column(1).to_pylist(), items))
                    if more:
                        found = [_merged(x, y) for x, y in zip(part.column(2).to_pylist(), found)]
                    made = pa.array([
                        {"n_words": n, "n_hit": hit, "n_items": c, "item_ids": names,
                         "hits": [{"first": a, "after": b} for a, b in runs]}
                        for n, hit, c, names, runs in found
                    ], kinds)
                    yield pa.RecordBatch.from_arrays([*part.columns[:2], made], names=["row", "text", "found"])

        out = out.mapInArrow(run, schema)
    columns = [(F.col("text") if c.lower() == "text" else F.col("row")[c]).alias(c) for c in names]
    return out.select(*columns, F.col("found").alias(into))


def _merged(old: dict, new: tuple):
    n, _, _, names, runs = new
    names = sorted({*old["item_ids"], *names})
    runs = merge([*((r["first"], r["after"]) for r in old["hits"]), *runs])
    return n, sum(b - a for a, b in runs), len(names), names, runs

