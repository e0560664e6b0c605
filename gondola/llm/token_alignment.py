"""Alignment of two public tokenizers' ids over the same bytes: byte-level A, sentencepiece B.

Both see a space and the text. Tokenizer spans give the coarse cuts: A's character offsets, put
into bytes, and the byte spans of B's proto. Where tokens share a character, the spans of A
overlap and those of B's byte pieces are empty; there the lengths of the tokens' decoded bytes
say where each ends. Offsets where both end cut a text into groups; pairs of overlapping tokens
are its links.

Neither tokenizer joins characters across the place before a space or line end that follows a
character which is not white space, nor a letter with a mark where only marks come before the
next white space. Texts are cut there, and each distinct segment is tokenized and aligned once
per task, as long as a bounded memory of segments holds it.

Links are counted over the corpus by pair of ids. A block of documents is stored with its
distinct segments and pairs, and the counts come back to it by pair, are added up by segment and
then by document: what is shuffled are the distinct pairs of each block, not every link.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.sources.shared import materialize

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
# Text of a block, and what a task remembers; segments are forgotten together when they need more.
BLOCK_BYTES = 4 << 20
MEMORY_BYTES = 112 << 20

_SEGMENT = re.compile(r"[ \n]*[^ \n\0]+|[ \n]+")
_MARKS = r"[!-/:-@\[-^`{-~]"
# A run of marks between a letter and white space.
_STOP = re.compile(rf"{_MARKS}(?<=[A-Za-z]{_MARKS}){_MARKS}*(?=[ \n]|$)")
_OTHER_SPACE = re.compile(r"[^\S \n]|\0")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_MARK = "▁"

BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, digests array<string>, held array<int>, segment binary, size binary, "
    "pair binary, pairs array<long>, n array<long>"
)
SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others, in order, for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class _Table:
    """Byte strings side by side, gathered by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        return self.data[_spans(self.start[numbers], self.length[numbers])]


class Aligned:
    """Aligned segments by number: groups as text, each after a `;` (None where a tokenizer
    changes the segment), counts of A's tokens, B's tokens, groups and links, and the links."""

    def __init__(self):
        self.texts: list[bytes | None] = []
        self.counts = np.zeros((1 << 12, 4), np.int32)
        self.first = np.zeros(1 << 12, np.int64)
        self.links = np.empty(1 << 14, np.int64)
        self.used = 0

    def room(self, segments: int) -> None:
        self.texts += [None] * (segments - len(self.texts))
        self.counts, self.first = _room(self.counts, segments), _room(self.first, segments)

    def add(self, numbers: np.ndarray, texts: list[bytes], counts: np.ndarray, links: np.ndarray) -> None:
        """Segments one after another with their links; those numbered -1 are left out."""
        self.links = _room(self.links, self.used + len(links))
        self.links[self.used : self.used + len(links)] = links
        known = numbers >= 0
        first = self.used + np.cumsum(counts[:, 3]) - counts[:, 3]
        self.counts[numbers[known]], self.first[numbers[known]] = counts[known], first[known]
        self.used += len(links)
        for k, x in zip(numbers.tolist(), texts):
            if k >= 0:
                self.texts[k] = x

    def links_of(self, numbers: np.ndarray) -> np.ndarray:
        return self.links[_spans(self.first[numbers], self.counts[numbers, 3].astype(np.int64))]

    def row(self, k: int) -> tuple | None:
        if self.texts[k] is None:
            return None
        return self.texts[k], *self.counts[k].tolist(), self.links_of(np.array([k])).tobytes()


def _room(x: np.ndarray, size: int) -> np.ndarray:
    if size <= len(x):
        return x
    more = np.zeros((max(size, 3 * len(x) // 2), *x.shape[1:]), x.dtype)
    more[: len(x)] = x
    return more


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        letters = byte_letters()
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_single = np.array([self.b.is_byte(i) for i in range(n)])
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if single else p.replace(_MARK, " ").encode()
            for p, single in zip(pieces, self.b_single)
        ]
        # Cuts are safe where no piece has a space after something else, nor a line end.
        normal = [p for p, single in zip(pieces, self.b_single) if not single]
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}|\n", p) for p in normal)
        self.stops = not any(re.search(rf"[A-Za-z]{_MARKS}", p) for p in normal)
        self.space = self.b.piece_to_id(_MARK)
        self.a_bytes, self.b_bytes = _Table(a_bytes), _Table(b_bytes)
        # The first token of A in a group follows a `;`, the first of B a `|`, all others a comma.
        self.written = _Table([
            f"{c}{i}".encode() for c, x in (*zip(";,", [a_bytes] * 2), *zip("|,", [b_bytes] * 2)) for i in range(len(x))
        ])

    def segments(self, text: str) -> list[str]:
        """The text behind a space, in segments that both tokenizers take on their own."""
        whole = " " + text
        if not self.cuts:
            return [whole]
        if _OTHER_SPACE.search(whole):
            return _CUT.split(whole)
        return _SEGMENT.findall(_STOP.sub("\0\\g<0>", whole) if self.stops else whole)

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and the byte offsets where they end, and the same of B; None where a
        tokenizer's bytes are not the text's. The text starts with a space, which B adds by
        itself, or with a line end, before which the space that B adds is dropped."""
        data = text.encode()
        coded = self.a.encode(text, add_special_tokens=False)
        if text == " ":  # B adds nothing to nothing
            pieces = ()
            b_ids, coarse_b = [self.space], np.ones(1, np.int64)
        else:
            skip = 0 if text[0] == " " else 1
            pieces = self.b.encode(text if skip else text[1:], return_type="proto").pieces[skip:]
            b_ids = [p.id for p in pieces]
            coarse_b = np.array([p.end for p in pieces], np.int64) + (1 - skip)
        a, b = np.array(coded.ids, np.int64), np.array(b_ids, np.int64)
        raw = np.frombuffer(data, np.uint8)
        if not (np.array_equal(self.a_bytes.gather(a), raw) and np.array_equal(self.b_bytes.gather(b), raw)):
            return None
        spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        first, upto = spans[:, 0], spans[:, 1]
        if len(data) != len(text):
            starts = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(data))
            shared = np.append(first[1:] < upto[:-1], False)
            a_ends = np.where(shared, np.cumsum(self.a_bytes.length[a]), starts[upto])
        else:  # no character of one byte is shared
            a_ends = upto
        single = self.b_single[b]
        b_ends = np.where(single, np.cumsum(self.b_bytes.length[b]), coarse_b) if single.any() else coarse_b
        return a, a_ends, b, b_ends

    def align(self, segments: list[str]) -> list[tuple | None]:
        """Of each segment (groups as text, tokens of A, of B, groups, links, the links a << 32 | b
        as bytes); None where a tokenizer changes it."""
        found = Aligned()
        self.align_into(found, segments, 0)
        return list(map(found.row, range(len(segments))))

    def align_into(self, found: Aligned, segments: list[str], number: int) -> None:
        """Adds segments under consecutive numbers. Those that end in a character other than
        white space are put together again, as one text, those of marks behind a letter."""
        found.room(number + len(segments))
        text, numbers, marks = [], [], []
        for k, s in enumerate(segments, number):
            if s[-1].isspace():
                self._align(found, [s], [k])
            elif s[0] in " \n":
                text.append(s)
                numbers.append(k)
            else:
                marks += (" a", -1), (s, k)
        if marks:
            more, at = zip(*marks)
            text += more
            numbers += at
        if text:
            self._align(found, text, numbers)

    def _align(self, found: Aligned, segments: list[str], numbers: list[int]) -> None:
        tokens = self.ends("".join(segments))
        if tokens is None:  # one of them or more
            half = len(segments) // 2
            half += segments[half][0] not in " \n"  # marks stay behind their letter
            if len(segments) > 1 and half < len(segments):
                self._align(found, segments[:half], numbers[:half])
                self._align(found, segments[half:], numbers[half:])
            return
        a, a_ends, b, b_ends = tokens
        lengths = [len(s) if s.isascii() else len(s.encode()) for s in segments]
        upto = np.cumsum(lengths)
        end_a, end_b = np.zeros((2, int(upto[-1]) + 1), np.int32)
        end_a[a_ends] = end_b[b_ends] = 1
        # How many tokens of A, and of B, and groups end up to each byte.
        both, either = end_a & end_b, end_a | end_b
        upto_a, upto_b, upto_both = np.cumsum(end_a), np.cumsum(end_b), np.cumsum(both)
        # Between two neighbouring ends of either side lies one link.
        at = np.flatnonzero(either)
        links = a[(upto_a - end_a)[at]] << 32 | b[(upto_b - end_b)[at]]
        # Tokens by group, those of A first.
        groups = np.append(0, np.flatnonzero(both))
        group_a, group_b = (upto_both - both)[a_ends], (upto_both - both)[b_ends]
        n, m = len(self.a_bytes.length), len(self.b_bytes.length)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + upto_b[groups[group_a]]] = a + n * (np.diff(group_a, prepend=-1) == 0)
        order[np.arange(len(b)) + upto_a[groups[group_b + 1]]] = b + 2 * n + m * (np.diff(group_b, prepend=-1) == 0)
        written = self.written.gather(order).tobytes()
        size = np.append(0, np.cumsum(self.written.length[order]))
        counts = np.diff([x[upto] for x in (upto_a, upto_b, upto_both, np.cumsum(either))], prepend=0).T
        stops = size[upto_a[upto] + upto_b[upto]].tolist()
        texts = [written[i:j] for i, j in zip([0, *stops], stops)]
        found.add(np.array(numbers, np.int64), texts, counts, links)


class _Numbers(dict):
    """Numbers given to keys in the order in which they are first met."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class _Memory:
    """Segments that a task has met, numbered and aligned."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self._clear()

    def _clear(self):
        self.numbers, self.found, self.held = _Numbers(), Aligned(), 0

    def numbered(self, texts: Iterator[list[str]]) -> list[list[int]]:
        """The numbers of the segments of each text. Numbers given before may be forgotten."""
        if self.held > MEMORY_BYTES:
            self._clear()
        known, links, number = len(self.numbers), self.found.used, self.numbers.__getitem__
        out = [list(map(number, segments)) for segments in texts]
        new = list(islice(reversed(self.numbers), len(self.numbers) - known))[::-1]
        for part in _parts(new):
            self.aligner.align_into(self.found, part, known)
            known += len(part)
        # About what Python needs for them.
        self.held += sum(map(len, new)) + 320 * len(new) + 12 * (self.found.used - links)
        return out

    def aligned(self, segments: list[str]) -> list[tuple | None]:
        numbers = self.numbered([segments])[0]
        return list(map(self.found.row, numbers))


def _parts(segments: list[str], most: int = 1 << 17):
    """Runs of segments with about so many characters in all."""
    first, size = 0, 0
    for k, s in enumerate(segments, 1):
        size += len(s)
        if size >= most or k == len(segments):
            yield segments[first:k]
            first, size = k, 0


_memories: dict[tuple[str, str], _Memory] = {}


def _block(number: int, ids: list, texts: list, memory: _Memory) -> pa.RecordBatch:
    cut = memory.aligner.segments
    rows = memory.numbered(cut(t) if t else () for t in texts)
    known = memory.found
    name = known.texts.__getitem__
    digests = []
    for k, row in enumerate(rows):
        try:
            whole = b"".join(map(name, row))
        except TypeError:  # a segment that a tokenizer changes
            rows[k], whole = [], b""
        digests.append(hashlib.sha256(whole[1:]).hexdigest() if whole else "")
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int64, int(lengths.sum()))
    del rows
    sums = [_sum_by(lengths, known.counts[flat, k]) for k in range(4)]
    # The block's distinct segments, numbered anew, and their distinct pairs.
    times = np.bincount(flat, minlength=len(known.texts))
    used = np.flatnonzero(times)
    local = np.cumsum(times > 0) - 1
    size = known.counts[used, 3].astype(np.int64)
    pairs, pair = np.unique(known.links_of(used), return_inverse=True)
    n = np.bincount(pair, weights=np.repeat(times[used], size), minlength=len(pairs)).astype(np.int64)
    lists = lambda x, kind=pa.int64(): pa.array([x], pa.list_(kind))
    columns = [
        pa.array([number], pa.int64()), lists(ids), *map(lists, sums), lists(digests, pa.string()),
        lists(lengths.astype(np.int32), pa.int32()),
        *(pa.array([_small(x)], pa.binary()) for x in (local[flat], size, pair)), lists(pairs), lists(n),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])


def _small(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs, all first bytes before all second ones:
    the upper bytes, mostly alike, then compress well."""
    x = x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0).newbyteorder("<"))
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _wide(data: pa.Buffer, n: int) -> np.ndarray:
    """The n numbers of `_small`."""
    planes = np.frombuffer(data, np.uint8).reshape(-1, n) if n else np.zeros((1, 0), np.uint8)
    return np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel().astype(np.int64)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each span, one after another."""
    shift = np.repeat(first - (np.cumsum(count) - count), count)
    return np.arange(len(shift)) + shift


def _blocks(frames: Iterator[pa.RecordBatch], paths: tuple[str, str], block_bytes: int):
    from pyspark import TaskContext

    if paths not in _memories:
        _memories[paths] = _Memory(Aligner(*paths))
    memory = _memories[paths]
    number = TaskContext.get().partitionId() << 40
    ids, texts, held = [], [], 0
    for frame in frames:
        for doc_id, text in zip(frame.column(0), frame.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            held += 64 + len(texts[-1] or "")
            if held >= block_bytes:
                yield _block(number, ids, texts, memory)
                number, ids, texts, held = number + 1, [], [], 0
    if ids:
        yield _block(number, ids, texts, memory)


def _sum_by(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def _documents(frames: Iterator[pa.RecordBatch]):
    """Blocks with the corpus's counts of their pairs to a row per document."""
    plain = ("doc_ids", "n_a", "n_b", "n_groups", "n_links")
    for frame in frames:
        for k in range(frame.num_rows):
            row = {c: frame.column(c)[k] for c in frame.schema.names}
            flat = {c: row[c].values for c in (*plain, "digests")}
            counted = row["counted"].values
            size = len(row["pairs"].values)
            total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if counted is not None:
                at = counted.field("place").to_numpy()
                total[at] = counted.field("total").to_numpy()
                best[at] = counted.field("best").to_numpy(zero_copy_only=False)
            held = row["held"].values.to_numpy().astype(np.int64)
            segment = _wide(row["segment"].as_buffer(), int(held.sum()))
            links = _wide(row["size"].as_buffer(), int(segment.max(initial=-1)) + 1)
            pair = _wide(row["pair"].as_buffer(), int(links.sum()))
            # Added up by segment, then by document.
            sums = [_sum_by(held, _sum_by(links, x[pair])[segment]) for x in (best, total)]
            columns = [*(flat[c] for c in plain), *(pa.array(x) for x in sums), flat["digests"]]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def counts(stored: DataFrame) -> DataFrame:
    """(pair, total, best): how many links hold a pair of ids linked, and whether no other pair
    with the same id of B has more."""
    listed = stored.select(F.explode(F.arrays_zip("pairs", "n")).alias("x"))
    found = listed.groupBy("x.pairs").agg(F.sum("x.n").alias("total")).withColumnRenamed("pairs", "pair")
    found = materialize(found, "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = found.groupBy(b.alias("b")).agg(F.max("total").alias("most"))  # a row per id of B
    return found.join(most, b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). documents has a row per document: doc_id, n_a, n_b, n_groups, n_links,
    n_best (links whose pair is the commonest of its B id, ties included), count_sum (the
    corpus's counts of its links, added up) and groups_sha256. pairs has a, b, n, best.

    Null and empty texts, and those that a tokenizer changes (its joined bytes are not a space
    and the text), have no tokens: zeros, and an empty groups_sha256. Strings of special tokens
    are plain text. Rows with the same doc_id are documents each; a null doc_id stays null. An
    empty table gives no rows. A text is never cut into blocks; a block is closed by the text
    that fills it. Only doc_id and text are read. An action: blocks are written once."""
    import public_tokenizers

    paths = (byte_path or public_tokenizers.path(BYTE_TOKENIZER), piece_path or public_tokenizers.path(PIECE_TOKENIZER))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = materialize(chosen.mapInArrow(lambda x: _blocks(x, paths, block_bytes), BLOCK_SCHEMA), "aligned-blocks")
    found = materialize(counts(stored), "pairs")
    placed = stored.select("block", F.posexplode("pairs").alias("place", "pair"))
    counted = (
        placed.join(found, "pair").groupBy("block")
        .agg(F.collect_list(F.struct("place", "total", "best")).alias("counted"))
    )
    kind = "array<struct<place: int, total: bigint, best: boolean>>"
    joined = stored.drop("n").join(counted, "block", "left").withColumn("counted", F.coalesce("counted", F.array().cast(kind)))
    documents = joined.mapInArrow(_documents, SCHEMA)
    low = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    pairs = found.select(F.shiftright("pair", 32).alias("a"), low.alias("b"), F.col("total").alias("n"), "best")
    return documents, pairs
