"""Cost-balanced packing of tokenized documents into sequences of a fixed token capacity.

A piece of n tokens costs LINEAR * n + QUADRATIC * n * n, the two parts of a transformer layer:
work per token, and attention within the piece. Documents are taken in descending cost, and
each goes to the sequence of lowest cost that still has room for it. Where none has, it is cut
and fills the sequence of lowest cost that has any room. As many sequences are open as the
tokens need: the free places of a group's sequences add up to less than one sequence.

A group is a run of documents of one input partition, closed when its tokens reach a fixed
number. Packing therefore needs no shuffle, holds one group in memory at a time, and gives the
same sequences again when a lost task is repeated over the same partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.llm import wordpiece_ids

CAPACITY = 2048
END_ID = 1
# Tokens after which a group is closed: 512 sequences, so that padding stays below 0.2 %.
GROUP_TOKENS = 1 << 20
LINEAR = 1.0
QUADRATIC = 1.0 / 4096

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, cost double"
)


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Place documents of these lengths (each at least 1) into sequences. Gives the pieces as
    (document, start in it, length, sequence, offset in the sequence) and the number of
    sequences. Whole sequences are cut off a long document first; what remains is shorter than
    a sequence. Ties in cost take the earlier document and the earlier sequence."""
    pieces, rest, sequences = [], [], 0
    for d, n in enumerate(lengths):
        full = n // capacity
        pieces += [(d, k * capacity, capacity, sequences + k, 0) for k in range(full)]
        sequences += full
        if n % capacity:
            rest.append((n % capacity, d, full * capacity))
    count = -(-sum(n for n, _, _ in rest) // capacity)
    used = np.zeros(count, np.int64)
    spent = np.zeros(count)
    for n, d, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        while n:
            room = used + n <= capacity
            take = n
            if not room.any():
                room = used < capacity
            at = int(np.where(room, spent, np.inf).argmin())
            take = min(n, capacity - int(used[at]))
            pieces.append((d, start, take, sequences + at, int(used[at])))
            used[at] += take
            spent[at] += cost(take)
            start, n = start + take, n - take
    return pieces, sequences + count


def _pack(frames: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, group: int):
    from pyspark import TaskContext

    encode = wordpiece_ids.encoder(path).encode
    dtype = wordpiece_ids.encoder(path).dtype
    end = np.array([end_id], dtype).tobytes()
    # Sequence numbers of a task start at its partition's own multiple of 2^40.
    first = TaskContext.get().partitionId() << 40
    docs: list[tuple[int | None, bytes]] = []
    held = 0

    def close():
        nonlocal first, docs, held
        pieces, sequences = assign([len(ids) // dtype.itemsize for _, ids in docs], capacity)
        wide: dict[int, bytes] = {}
        rows = []
        for d, start, n, sequence, offset in sorted(pieces):
            doc_id, ids = docs[d]
            if d not in wide:
                wide = {d: np.frombuffer(ids, dtype).astype("<u4").tobytes()}
            crc = zlib.crc32(memoryview(wide[d])[4 * start : 4 * (start + n)])
            total = len(ids) // dtype.itemsize
            rows.append((doc_id, start, n, crc, total, first + sequence, offset, float(cost(n))))
        first, docs, held = first + sequences, [], 0
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.float64()]
        columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for frame in frames:
        ids_of, texts = frame.column(0).to_pylist(), frame.column(1)
        for k in range(0, len(texts), 256):
            for j, ids in enumerate(encode(texts.slice(k, 256).to_pylist())):
                docs.append((ids_of[k + j], ids + end))
                held += len(ids) // dtype.itemsize + 1
                if held >= group:
                    yield close()
    if docs:
        yield close()


def pack(
    docs: DataFrame,
    tokenizer: str = wordpiece_ids.DEFAULT_TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start and length in its document's ids, ids_crc32 of the
    piece's ids as little-endian 32-bit numbers, doc_tokens, sequence_id, offset, cost.

    Reads doc_id and text only. A null or empty text has the end id alone. Rows with the same
    doc_id are packed each on their own; a null doc_id stays null. An empty table gives no
    rows. A very long document takes whole sequences of its own first."""
    path = wordpiece_ids.tokenizer_path(tokenizer)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(
        lambda frames: _pack(frames, path, capacity, end_id, group_tokens), SCHEMA
    )


def padding(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokens, sequences, and padding up to the capacity (none at a power of two)."""
    used = F.col("used")
    two = F.bin(used).rlike("^10*$")
    return (
        pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
        .agg(
            F.sum("used").alias("tokens"),
            F.count("*").alias("sequences"),
            F.sum(F.when(two, 0).otherwise(capacity - used)).alias("padding"),
        )
    )
