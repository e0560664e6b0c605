"""SimHash near-duplicates by an inverted index over byte positions.

A document's fingerprint has 64 bits, each set in more than half of its word shingles' hashes.
Two fingerprints of 8 bytes that differ in at most 4 bits share at least 4 bytes at their
positions. The index posts each distinct fingerprint under some sets of three positions with
their bytes. The sets are chosen so that any 4 positions contain one of them: of the 56 sets 20
suffice, so no such pair is missed. Within a posting list the shared positional bytes of each
pair are tallied, pairs with 4 or more are verified by their differing bits, and only a
spanning forest of the verified links leaves the task: a list of n makes less than n links.

Copies share one fingerprint and are posted once. A list longer than `BLOCK` is dealt to one
task per pair of its blocks. Components are found over distinct fingerprints and joined back.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.components import components
from gondola.sources.shared import materialize

SHINGLE = 4
SEED = 42
MAX_BITS = 4
# Fingerprints of one posting list that a task compares with each other.
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set in more than half of the shingles' hashes; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(data, SEED)]
    else:
        hashes = [digest(data[i:j], SEED) for i, j in zip(starts, ends[shingle - 1 :])]
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[k : k + (1 << 16)], "<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def position_sets() -> list[tuple[int, int, int]]:
    """Sets of three byte positions of which any four positions contain one. The positions are
    put on a circle of three groups; a set lies within a group, or has two positions in one
    group and one in the next."""
    group = {p: p % 3 for p in range(8)}
    chosen = []
    for three in combinations(range(8), 3):
        at = [group[p] for p in three]
        pairs = [g for g in set(at) if at.count(g) == 2]
        if len(set(at)) == 1 or pairs and (pairs[0] + 1) % 3 in at:
            chosen.append(three)
    return chosen


def _byte(fingerprint: Column, position: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * position).bitwiseAND(F.lit(255).cast("long"))


def postings(fingerprints: DataFrame) -> DataFrame:
    """(key, fingerprint): one row per set of positions."""
    f = F.col("fingerprint")
    keys = []
    for k, three in enumerate(position_sets()):
        key = F.lit(k).cast("long")
        for p in three:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(f, p))
        keys.append(key)
    return fingerprints.select("fingerprint", F.explode(F.array(*keys)).alias("key"))


def _forest(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all points that a chain of verified pairs connects."""
    n = len(points)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    low = np.uint64(0x0101010101010101)
    for k in range(0, n, 256):
        x = points[k : k + 256, None] ^ points[None, k:]
        y = x | (x >> np.uint64(4))
        y |= y >> np.uint64(2)
        y |= y >> np.uint64(1)
        shared = 8 - np.bitwise_count(y & low)
        i, j = np.nonzero(shared >= 8 - max_bits)
        near = np.bitwise_count(x[i, j]) <= max_bits
        for a, b in zip((i[near] + k).tolist(), (j[near] + k).tolist()):
            if a < b and (ra := find(a)) != (rb := find(b)):
                root[rb] = ra
                links.append((a, b))
    return links


def _link(frames, max_bits: int):
    for frame in frames:
        lists = frame.column(0)
        flat = np.asarray(lists.flatten()).view(np.uint64)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        u, v = [], []
        for a, b in zip([0, *ends[:-1]], ends):
            points = flat[a:b]
            for i, j in _forest(points, max_bits):
                u.append(points[i])
                v.append(points[j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)], names=["u", "v"]
        )


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect all within `max_bits`, through
    chains of such. An action: keys of long lists are counted first."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the sets of positions guarantee up to 4 differing bits")
    posted = postings(fingerprints)
    long_lists = materialize(
        posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block), "long-lists"
    )
    short = posted.join(long_lists, "key", "left_anti").groupBy("key")
    lists = short.agg(F.collect_list("fingerprint").alias("points")).select("points")
    if not long_lists.isEmpty():
        blocks = F.ceil(F.col("n") / block)
        dealt = (
            posted.join(long_lists, "key").withColumn("n", blocks.cast("int"))
            .withColumn("b", F.pmod(F.xxhash64("fingerprint"), F.col("n")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .groupBy("key", F.least("b", "other").alias("b1"), F.greatest("b", "other").alias("b2"))
        )
        lists = lists.union(dealt.agg(F.collect_list("fingerprint")).select("collect_list(fingerprint)"))
    return lists.where(F.size("points") > 1).mapInArrow(
        lambda frames: _link(frames, max_bits), "u long, v long"
    )


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fingerprint as a signed long) of every row."""

    def run(frames):
        for frame in frames:
            found = [fingerprint(t.as_py(), shingle) for t in frame.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*frame.columns[:2], pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "fingerprint"],
            )

    text = F.col("text").cast("string")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return chosen.mapInArrow(run, "doc_id long, text_hash long, fingerprint long")


def _least(found: DataFrame, key: Column, max_bits: int) -> DataFrame:
    """(fingerprint, least): the smallest key of the component of every fingerprint."""
    distinct = materialize(found.groupBy("fingerprint").agg(F.min(key).alias("first")), "distinct")
    linked = components(links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select("fingerprint", "least")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of the documents: doc_id, fingerprint (16 hex digits), component_id, the smallest
    doc_id that links of at most `max_bits` differing bits lead to, itself included.

    Documents without words (null or empty texts) have the fingerprint zero and are linked like
    any other. Rows with the same doc_id have a row each; null ids are never the smallest, and a
    component of null ids alone has a null id. An empty table gives no rows. An action: the
    fingerprints, links and rounds are written to the shared folder."""
    found = materialize(fingerprints(docs, shingle).drop("text_hash"), "fingerprints")
    labels = _least(found, F.col("doc_id"), max_bits).withColumnRenamed("least", "component_id")
    return found.join(labels, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: the row with the smallest doc_id; rows without one come
    last, and of several rows with that doc_id, or without any, the one with the smallest hash
    of its text stays, or of all its columns where the texts are alike too. An empty table
    gives no rows. An action.

    The documents are read once more and joined with the rows that go, told by doc_id and text
    hash: these are written first, so their size decides between a broadcast and one shuffle."""
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    judged = found.join(_least(found, key, max_bits), "fingerprint").select(
        "doc_id", "text_hash", key.eqNullSafe(F.col("least")).alias("first")
    )
    judged = materialize(judged.groupBy("doc_id", "text_hash", "first").count().where("NOT first OR count > 1"), "gone")
    text = F.col("text").cast("string")
    places = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.struct("*").alias("row")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    kept = places.join(judged, same, "left_anti").select("row")
    alike = judged.where("first")
    if not alike.isEmpty():  # rows that agree in doc_id and text: one of them
        whole = places.join(alike, same, "left_semi").groupBy("id", "hash")
        kept = kept.union(whole.agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row"))
    return kept.select("row.*")
