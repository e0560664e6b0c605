"""A store of token ids coded by a static range asymmetric numeral system (rANS).

Documents are put in ascending order of doc_id by a range partitioning, tokenized, and cut into
blocks of whole documents. Token counts of all blocks give one shared frequency table. Each
block is coded on its own, as segments of equal length, each of which has its own words and its
own checkpoint (the states of its lanes and the place of its first word): a reader may start at
any segment of any block, and all segments of a block are decoded side by side. Each block
carries a checksum of every other column and one of each segment's ids; all lanes must end in
the state in which coding began.

Files: `<path>/frequencies` (symbol, frequency) and `<path>/blocks`, one row per block. Both are
Parquet, so that Spark's commit protocol makes repeated tasks safe and any store can hold them.
A block's row:

    part, seq         the range partition and the block's place in it
    start             ids of all documents before the block
    doc_ids           its documents, ascending
    doc_tokens        the number of ids of each
    lanes, steps      a segment's id number t * lanes + l is step t of lane l
    states            64-bit states of all lanes, segment by segment (the checkpoints)
    word_starts       the place of each segment's first word
    words             32-bit words read by the decoder, segment by segment
    segment_crcs      checksums of the segments' ids, as 32-bit numbers
    row_crc32         checksum of all columns before it
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.llm import wordpiece_ids
from gondola.sources.shared import materialize, new_path

END_ID = 2
BLOCK_TOKENS = 1 << 18
SEGMENT_TOKENS = 1 << 16
LANES = 256
# Frequencies sum to 2^SCALE; states stay between 2^31 and 2^63 and move 32 bits at a time.
SCALE = 20
LOW = np.uint64(1 << 31)
_32 = np.uint64(32)

RAW_SCHEMA = (
    "part int, seq int, offset long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "ids binary, symbols array<int>, counts array<long>"
)
BLOCK_SCHEMA = (
    "part int, seq int, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "lanes int, steps int, states binary, word_starts array<long>, words binary, "
    "segment_crcs array<long>, row_crc32 long"
)
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies in proportion to the counts, at least 1 where a symbol occurs, summing to
    2^scale. The remainder goes to, or is taken from, the most frequent symbols."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.int64)
    share = counts.astype(object) * (1 << scale) // total
    freq = np.where(counts > 0, np.maximum(share.astype(np.int64), 1), 0)
    order = np.argsort(-counts, kind="stable")
    left = (1 << scale) - int(freq.sum())
    if left > 0:
        freq[order[0]] += left
    for s in order:
        if left >= 0:
            break
        take = min(-left, int(freq[s]) // 2)
        freq[s] -= take
        left += take
    return freq


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
        self.common = int(freq.argmax()) if len(freq) else 0

    @staticmethod
    def shape(n: int) -> tuple[int, int, int]:
        """Segments, steps and lanes for n ids: segments of equal length, fewer lanes when the
        block is small."""
        segments = max(1, -(-n // SEGMENT_TOKENS))
        lanes = LANES
        while lanes > 1 and n < 64 * lanes * segments:
            lanes //= 2
        return segments, -(-n // (segments * lanes)), lanes

    def encode(self, ids: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        """lanes, steps, states, word starts, words. The last places of a block may be filled
        with the commonest symbol, which a reader drops by n_tokens."""
        segments, steps, lanes = self.shape(len(ids))
        grid = np.full(segments * steps * lanes, self.common, np.int64)
        grid[: len(ids)] = ids
        grid = np.ascontiguousarray(grid.reshape(segments, steps, lanes).transpose(1, 0, 2))
        grid = grid.reshape(steps, segments * lanes)
        owner = np.repeat(np.arange(segments), lanes)
        x = np.full(segments * lanes, LOW)
        high, scale = np.uint64(63 - SCALE), np.uint64(SCALE)
        words, owners = [], []
        for row in grid[::-1]:
            f = self.freq[row]
            full = np.flatnonzero(x >= (f << high))
            if len(full):
                words.append(x[full].astype(np.uint32))  # the low 32 bits
                owners.append(owner[full])
                x[full] >>= _32
            q = x // f
            x = (q << scale) + (x - q * f) + self.cum[row]
        if not words:
            return lanes, steps, x, np.zeros(segments, np.int64), np.zeros(0, np.uint32)
        flat = np.concatenate(words[::-1])
        own = np.concatenate(owners[::-1])
        starts = np.concatenate(([0], np.cumsum(np.bincount(own, minlength=segments))[:-1]))
        return lanes, steps, x, starts, flat[np.argsort(own, kind="stable")]

    def decode(self, lanes, steps, states, starts, words, n: int) -> np.ndarray | None:
        """The first n ids of these segments, in order; None if a lane does not end where coding began."""
        segments = len(starts)
        x = states.copy()
        at = np.asarray(starts, np.int64).copy()
        out = np.empty((steps, segments * lanes), np.int32)
        scale, mask = np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
        for t in range(steps):
            slot = x & mask
            s = self.symbol[slot]
            out[t] = s
            x = self.freq[s] * (x >> scale) + slot - self.cum[s]
            low = x < LOW
            if low.any():
                by_segment = low.reshape(segments, lanes)
                place = (at[:, None] + np.cumsum(by_segment, axis=1) - 1).reshape(-1)[low]
                x[low] = (x[low] << _32) | words.take(place, mode="clip")
                at += by_segment.sum(axis=1)
        if (x != LOW).any():
            return None
        return out.reshape(steps, segments, lanes).transpose(1, 0, 2).reshape(-1)[:n]


def _tokenize(frames: Iterator[pa.RecordBatch], path: str, end_id: int, block_tokens: int):
    from pyspark import TaskContext

    part, seq, offset = TaskContext.get().partitionId(), 0, 0
    enc = wordpiece_ids.encoder(path)
    width, end = enc.dtype.itemsize, np.array([end_id], enc.dtype).tobytes()
    doc_ids, lengths, held, total = [], [], [], 0
    counts = np.zeros(enc.size, np.int64)

    def close(last=False):
        nonlocal seq, offset, doc_ids, lengths, held, total, counts
        ids = b"".join(held)
        counts += np.bincount(np.frombuffer(ids, enc.dtype), minlength=enc.size)
        symbols = np.flatnonzero(counts) if last else np.zeros(0, np.int64)
        row = (part, seq, offset, total, doc_ids, lengths, ids, symbols.astype(np.int32), counts[symbols])
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = [c.split()[0] for c in RAW_SCHEMA.split(", ")]
        seq, offset, doc_ids, lengths, held, total = seq + 1, offset + total, [], [], [], 0
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    for frame in frames:
        keys, texts = frame.column(0).to_pylist(), frame.column(1)
        for k in range(0, len(texts), 256):
            for j, ids in enumerate(enc.encode(texts.slice(k, 256).to_pylist())):
                doc_ids.append(keys[k + j])
                held.append(ids + end)
                lengths.append(len(ids) // width + 1)
                total += lengths[-1]
                if total >= block_tokens:
                    yield close()
    if doc_ids or seq:
        yield close(last=True)  # with the task's counts; without documents if the one before took all


def _add_up(frames):
    """A task's counts by symbol, from those of its blocks."""
    counts = np.zeros(0, np.int64)
    for frame in frames:
        symbols, n = (np.asarray(frame.column(c).flatten(), np.int64) for c in range(2))
        more = np.bincount(symbols, weights=n, minlength=len(counts)).astype(np.int64)
        more[: len(counts)] += counts
        counts = more
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], names=["symbol", "n"]
    )


def _crc(values: dict) -> int:
    """Checksum of a block's columns up to the segments' checksums."""
    crc = 0
    for name in (c.split()[0] for c in BLOCK_SCHEMA.split(", ")[:-1]):
        x = values[name]
        if not isinstance(x, bytes):
            # A null doc_id is told from any number by its own byte.
            x = b"".join(b"\0" if v is None else b"\1" + v.to_bytes(8, "little", signed=True) for v in (x if isinstance(x, list) else [x]))
        crc = zlib.crc32(x, zlib.crc32(len(x).to_bytes(8, "little"), crc))
    return crc


def _segment_crcs(ids: np.ndarray, segments: int, size: int) -> list[int]:
    data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return [zlib.crc32(data[4 * k * size : 4 * (k + 1) * size]) for k in range(segments)]


def _encode(frames, freq: np.ndarray, part_starts: dict[int, int], dtype: str):
    coder = Coder(freq)
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.int64()]
    for frame in frames:
        for row in (frame.slice(k, 1).to_pylist()[0] for k in range(frame.num_rows)):
            ids = np.frombuffer(row["ids"], dtype)
            if not len(ids):  # a task's counts alone
                continue
            lanes, steps, states, starts, words = coder.encode(ids)
            values = {
                "part": row["part"], "seq": row["seq"], "start": part_starts[row["part"]] + row["offset"],
                "n_tokens": len(ids), "doc_ids": row["doc_ids"], "doc_tokens": row["doc_tokens"],
                "lanes": lanes, "steps": steps, "states": states.astype("<u8").tobytes(),
                "word_starts": starts.tolist(), "words": words.astype("<u4").tobytes(),
                "segment_crcs": _segment_crcs(ids, len(starts), steps * lanes),
            }
            values["row_crc32"] = _crc(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([values[c]], k) for c, k in zip(names, kinds)], names=names
            )


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str = wordpiece_ids.DEFAULT_TOKENIZER,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the store (an action). Reads doc_id and text only.

    A null or empty text has the end id alone. Rows with the same doc_id are kept each, in the
    order of their texts; a null doc_id comes first. An empty table gives an empty store. Counts
    and block sizes per range partition, and one count per symbol of the vocabulary, go to the
    driver: their number depends on the partitioning and the tokenizer, not on the documents."""
    spark = docs.sparkSession
    where = wordpiece_ids.tokenizer_path(tokenizer)
    dtype = wordpiece_ids.Encoder(where).dtype.str
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    raw = materialize(
        ordered.mapInArrow(lambda x: _tokenize(x, where, end_id, block_tokens), RAW_SCHEMA),
        "token-blocks",
    )
    counted = (
        raw.select("symbols", "counts").mapInArrow(_add_up, "symbol int, n long")
        .groupBy("symbol").agg(F.sum("n").alias("n")).orderBy("symbol").collect()
    )
    counts = np.zeros(counted[-1].symbol + 1 if counted else 0, np.int64)
    for symbol, n in counted:
        counts[symbol] = n
    freq = scaled(counts)
    starts, before = {}, 0
    for part, n in raw.groupBy("part").agg(F.sum("n_tokens")).orderBy("part").collect():
        starts[part], before = before, before + n
    (
        raw.drop("symbols", "counts").mapInArrow(lambda x: _encode(x, freq, starts, dtype), BLOCK_SCHEMA)
        .sortWithinPartitions("part", "seq").write.parquet(f"{path}/blocks")
    )
    rows = [(s, int(f)) for s, f in enumerate(freq) if f]
    (
        spark.createDataFrame(rows, "symbol int, frequency long")
        .coalesce(1).write.parquet(f"{path}/frequencies")
    )


def read_frequencies(spark: SparkSession, path: str) -> np.ndarray:
    """The shared table; its size is bounded by the vocabulary."""
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    freq = np.zeros(max((r.symbol for r in rows), default=-1) + 1, np.int64)
    for symbol, f in rows:
        freq[symbol] = f
    return freq


def decode_segments(coder: Coder, row: dict, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a block's segments from `first` up to `last`, not included; of all by default.
    Segments are decoded side by side, and no others are read. Raises if anything is damaged."""
    place = f"block {row['part']}/{row['seq']}"
    if _crc(row) != row["row_crc32"]:
        raise ValueError(f"{place}: it is damaged")
    lanes, steps = row["lanes"], row["steps"]
    size, segments = steps * lanes, len(row["word_starts"])
    last = segments if last is None else min(last, segments)
    states = np.frombuffer(row["states"], "<u8")[first * lanes : last * lanes]
    n = min(row["n_tokens"], last * size) - first * size
    ids = coder.decode(lanes, steps, states, row["word_starts"][first:last], np.frombuffer(row["words"], "<u4"), n)
    if ids is None or _segment_crcs(ids, last - first, size) != row["segment_crcs"][first:last]:
        raise ValueError(f"{place}: its ids are damaged, or the frequencies are not its own")
    return ids


def _decode(frames, freq: np.ndarray, with_ids: bool):
    coder = Coder(freq)
    for frame in frames:
        for row in (frame.slice(k, 1).to_pylist()[0] for k in range(frame.num_rows)):
            ids = decode_segments(coder, row)
            data = memoryview(ids.astype("<u4").tobytes())
            ends = np.cumsum(row["doc_tokens"], dtype=np.int64)
            begins = ends - row["doc_tokens"]
            columns = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["start"] + begins, pa.int64()),
                pa.array(row["doc_tokens"], pa.int64()),
                pa.array([zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(begins, ends)], pa.int64()),
            ]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([ids[i:j].tolist() for i, j in zip(begins, ends)], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 and, if asked for, the ids. Damaged blocks raise."""
    freq = read_frequencies(spark, path)
    schema = DOC_SCHEMA + (", ids array<int>" if with_ids else "")
    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.mapInArrow(lambda x: _decode(x, freq, with_ids), schema)


def store_path(spark: SparkSession) -> str:
    return new_path(spark, "token-store")
