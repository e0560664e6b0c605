"""Substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text: h = (h << 1) + G[byte], so that its 32 bits
depend on the last 32 bytes. A chunk ends where the upper `BITS` bits are zero, at a character's
end, at least `MIN_SIZE` bytes after the last cut; cuts follow the content, so an insertion
moves the chunks near it only. Chunks are compared by 128 bits of hash. A passage that two texts
share begins before its first common chunk and ends behind its last one: runs of repeated chunks
are extended both ways, byte by byte, as far as the text agrees with that around the first place
of the run's outermost chunk. The first place of a chunk stays, later places are deleted where
they make up, extended, at least `MIN_RUN` bytes in a row: shorter coincidences, which ordinary
prose has, are left alone.

A place is (doc_id, hash of the text, byte). Keys that occur once, most of all, are dropped by a
count with partial sums before anything wider is shuffled; a chunk of any number of places is
aggregated before the shuffle and joined, never gathered. For the extension, `WINDOW` bytes beside
each end of a run travel, not texts; where all of them agree, a next round takes a longer window
from there. The hash of a whole batch of texts is
computed by five additions of shifted vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from gondola.llm.names import quoted
from gondola.sources.shared import materialize

BITS = 5
MIN_SIZE = 32
MAX_SIZE = 1024
MIN_RUN = 100
WINDOW = 256

GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        moved = h.copy()
        moved[step:] += h[:-step] << np.uint32(step)
        h = moved
    return h


def cuts(texts: list[bytes], bits: int = BITS, least: int = MIN_SIZE, most: int = MAX_SIZE) -> list[list[int]]:
    """Per text the ends of its chunks. Only the last chunk may be below `least` bytes; a chunk
    without a cut ends after `most` bytes, or up to 3 more for a character to end. `least` is 32
    or more: then no hash of a possible cut reaches back into another text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return [[] for _ in texts]
    start_of_character = np.append((data[1:] & 0xC0) != 0x80, True)
    possible = (np.flatnonzero((gear(data) >> np.uint32(32 - bits) == 0) & start_of_character) + 1).tolist()
    possible.append(len(data) + most + 4)
    out, at, k = [], 0, 0
    for text in texts:
        end, found, start = at + len(text), [], at
        while start < end:
            while possible[k] < start + least:
                k += 1
            cut = possible[k]
            if cut > start + most:
                cut = start + most
                while cut < end and not start_of_character[cut - 1]:
                    cut += 1
            start = min(cut, end)
            found.append(start - at)
        out.append(found)
        at = end
    return out


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, size, key, digest) of every chunk, in bytes."""
    schema = "doc_id long, text_hash long, start long, size long, key long, digest long"

    def run(frames):
        digest = xxhash.xxh3_128_digest
        for frame in frames:
            for k in range(0, frame.num_rows, 512):
                part = frame.slice(k, 512)
                texts = [(t or "").encode("utf-8", "replace") for t in part.column(2).to_pylist()]
                ends = cuts(texts)
                counts = [len(e) for e in ends]
                stop = np.array([e for found in ends for e in found], np.int64)
                start = np.array([s for found in ends if found for s in (0, *found[:-1])], np.int64)
                hashes = b"".join(
                    digest(text[a:b]) for text, found in zip(texts, ends) for a, b in zip([0, *found], found)
                )
                pairs = np.frombuffer(hashes, "<i8").reshape(-1, 2)
                rows = np.repeat(np.arange(part.num_rows), counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)), pa.array(start),
                     pa.array(stop - start), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                    names=["doc_id", "text_hash", "start", "size", "key", "digest"],
                )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(run, schema)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, spans): the chunks of every document that stand at an earlier place
    too, and the extensions of their runs, as an array of (start, size) in order. An action: the
    repeated chunks and the extensions are written."""
    found = chunks(docs)
    often = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    place = F.struct("doc_id", "text_hash", "start")
    again = materialize(found.join(often, "key", "left_semi").withColumn("place", place), "repeated-chunks")
    first = again.groupBy("key", "digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    later = again.join(first.where("first <> last"), ["key", "digest"]).where("place > first")
    listed = later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "size", "first"))).alias("spans")
    )
    listed = materialize(listed, "repeated-spans")
    spans = listed.select("doc_id", "text_hash", F.explode("spans").alias("s")).select(
        "doc_id", "text_hash", "s.start", "s.size"
    )
    ends = listed.mapInArrow(_ends, END_SCHEMA)
    while True:
        grown = materialize(_agreeing(docs, ends, window), "extended-runs")
        left = F.col("side") < 0
        start = F.when(left, F.col("at") - F.col("length")).otherwise(F.col("at"))
        spans = spans.union(
            grown.where("length > 0").select("doc_id", "text_hash", start.alias("start"), F.col("length").alias("size"))
        )
        moved = F.col("side") * F.col("length")
        ends = grown.where("further").select(
            "doc_id", "text_hash", (F.col("at") + moved).alias("at"), "side",
            "of_id", "of_hash", (F.col("of_at") + moved).alias("of_at"),
        )
        if ends.isEmpty():
            break
        window *= 8
    return spans.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans")
    )


END_SCHEMA = "doc_id long, text_hash long, at long, side int, of_id long, of_hash long, of_at long"


def _ends(frames):
    """Both ends of each run of adjoining chunks, with the place in the first text of the chunk there."""
    names = [c.split()[0] for c in END_SCHEMA.split(", ")]
    kinds = [pa.int32() if c == "side" else pa.int64() for c in names]
    for frame in frames:
        for k in range(frame.num_rows):
            doc_id, text_hash, spans = (frame.column(c)[k].as_py() for c in range(3))
            starts = {s["start"] for s in spans}
            stops = {s["start"] + s["size"] for s in spans}
            rows = []
            for s in spans:
                start, size, of = s["start"], s["size"], s["first"]
                for at, side, others in ((start, -1, stops), (start + size, 1, starts)):
                    if at not in others:
                        of_at = of["start"] + (size if side > 0 else 0)
                        rows.append((doc_id, text_hash, at, side, of["doc_id"], of["text_hash"], of_at))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)


def _agreeing(docs: DataFrame, ends: DataFrame, window: int) -> DataFrame:
    """The ends with `length`, the bytes beside them that agree with those beside the first
    place, whole characters and at most `window`, and `further`, whether more may agree."""
    place = ["doc_id", "text_hash", "at", "side"]
    first = ends.select(F.col("of_id").alias("doc_id"), F.col("of_hash").alias("text_hash"), F.col("of_at").alias("at"), "side")
    wanted = ends.select(*place).union(first).distinct().groupBy("doc_id", "text_hash")
    listed = wanted.agg(F.collect_list(F.struct("at", "side")).alias("places"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text")
    )
    joined = texts.join(
        listed, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    ).select("doc_id", "text_hash", "text", "places")
    schema = "doc_id long, text_hash long, at long, side int, bytes binary, all boolean"

    def cut(frames):
        names = [c.split()[0] for c in schema.split(", ")]
        for frame in frames:
            for k in range(frame.num_rows):
                doc_id, text_hash, text, places = (frame.column(c)[k].as_py() for c in range(4))
                data, at, side = text.encode("utf-8", "replace"), [], []
                beside, whole = [], []
                for p in places:
                    at.append(p["at"])
                    side.append(p["side"])
                    a, b = (max(p["at"] - window, 0), p["at"]) if p["side"] < 0 else (p["at"], min(p["at"] + window, len(data)))
                    whole.append(a == 0 if p["side"] < 0 else b == len(data))
                    while 0 < a < b and data[a] & 0xC0 == 0x80:
                        a += 1
                    while a < b < len(data) and data[b] & 0xC0 == 0x80:
                        b -= 1
                    beside.append(data[a:b])
                n = len(at)
                values = ([doc_id] * n, [text_hash] * n, at, side, beside, whole)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, kinds)], names=names)

    # Rows that agree in doc_id and text give the same bytes.
    beside = materialize(joined.mapInArrow(cut, schema).dropDuplicates(place), "run-sides")

    def same(c, of):
        return F.col(c).eqNullSafe(F.col(of))

    theirs = beside.select(*(F.col(c).alias(f"their_{c}") for c in beside.columns))
    own = ends.join(
        beside.select(*(F.col(c).alias(f"my_{c}") for c in beside.columns)),
        same("doc_id", "my_doc_id") & same("text_hash", "my_text_hash") & same("at", "my_at") & same("side", "my_side"),
    ).where(F.length("my_bytes") > 0)
    both = own.join(
        theirs.where(F.length("their_bytes") > 0),
        same("of_id", "their_doc_id") & same("of_hash", "their_text_hash") & same("of_at", "their_at") & same("side", "their_side"),
    ).select(*ends.columns, "my_bytes", "their_bytes", "my_all", "their_all")

    names = ends.columns

    def compare(frames):
        for frame in frames:
            compared = ("side", "my_bytes", "their_bytes", "my_all", "their_all")
            sides, mine, theirs, my_all, their_all = (frame.column(c).to_pylist() for c in compared)
            length, further = [], []
            for side, a, b, a_all, b_all in zip(sides, mine, theirs, my_all, their_all):
                n, most = common(a, b, side), min(len(a), len(b))
                further.append(n > 0 and n == most and not (a_all and n == len(a) or b_all and n == len(b)))
                length.append(n)
            columns = [*frame.columns[: len(names)], pa.array(length, pa.int64()), pa.array(further, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "length", "further"])

    return both.mapInArrow(compare, f"{END_SCHEMA}, length long, further boolean")


def common(a: bytes, b: bytes, side: int) -> int:
    """How many bytes of `a`, whole characters, agree with `b` from the start on (side 1) or up
    to the end (side -1)."""
    most = min(len(a), len(b))
    x, y = (np.frombuffer(s[:most] if side > 0 else s[len(s) - most :], np.uint8) for s in (a, b))
    different = np.flatnonzero(x != y)
    if side > 0:
        n = int(different[0]) if len(different) else most
        while 0 < n < len(a) and a[n] & 0xC0 == 0x80:
            n -= 1
    else:
        n = most - 1 - int(different[-1]) if len(different) else most
        while n and a[len(a) - n] & 0xC0 == 0x80:
            n -= 1
    return n


def runs(spans, least: int = MIN_RUN) -> list[tuple[int, int]]:
    """Adjoining and overlapping spans put together as (start, end), those below `least` bytes left out."""
    merged: list[list[int]] = []
    for start, size in spans:
        if merged and merged[-1][1] >= start:
            merged[-1][1] = max(merged[-1][1], start + size)
        else:
            merged.append([start, start + size])
    return [(a, b) for a, b in merged if b - a >= least]


def dedup_substrings(docs: DataFrame, min_run: int = MIN_RUN, window: int = WINDOW) -> DataFrame:
    """The documents without repeated substrings, and n_removed, the bytes deleted.

    A document stays a row when all of it goes (its text is then empty). A null text stays null,
    texts without repeats stay as they are. Rows that agree in doc_id and text are one place
    and keep or lose their chunks alike. A null doc_id comes before all others. An empty table
    gives no rows. A column of the documents named n_removed is replaced."""
    names = [c for c in docs.columns if c.lower() != "n_removed"]
    others = F.struct(*(quoted(c) for c in names if c.lower() != "text")).alias("row")
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("hash"), others)
    spans = repeats(docs, window).withColumnRenamed("doc_id", "id")
    joined = marked.join(
        spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left"
    ).select("row", "text", "spans")
    schema = T.StructType([*joined.schema.fields[:2], T.StructField("n_removed", T.LongType())])

    def run(frames):
        for frame in frames:
            texts, removed = frame.column(1).to_pylist(), []
            for k, spans in enumerate(frame.column(2).to_pylist()):
                cut = runs([(s["start"], s["size"]) for s in spans or ()], min_run)
                removed.append(sum(b - a for a, b in cut))
                if cut:
                    data = texts[k].encode("utf-8", "replace")
                    ends = [0, *(b for _, b in cut)]
                    starts = [*(a for a, _ in cut), len(data)]
                    texts[k] = b"".join(data[a:b] for a, b in zip(ends, starts)).decode("utf-8", "replace")
            columns = [frame.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_removed"])

    cleaned = joined.mapInArrow(run, schema)
    made = (F.col("text") if c.lower() == "text" else F.col("row")[c] for c in names)
    return cleaned.select(*(x.alias(c) for x, c in zip(made, names)), "n_removed")
