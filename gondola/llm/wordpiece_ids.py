"""Token ids of whole texts with a public tokenizer of the `tokenizers` library.

Byte-pair merges never cross white space, so a text's ids are the ids of its words in order; a
run of marks between a letter and white space is a word of its own. Each task numbers the
words it meets and keeps their ids side by side in one array, up to a bounded size: a text is
one look-up per word and one gather. The library gets new words only, many at a time. Texts
where lower-casing first could change the result (combining marks, special tokens) go to the
library word by word as they stand, or whole.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np

DEFAULT_TOKENIZER = "word_bpe_49k.json"
# What a task remembers; the words are forgotten together when they need more.
MEMORY_BYTES = 160 << 20

# Marks between a letter and white space: the merges take such a run on its own.
_MARK = rb"[!-/:-@\[-`{-~]"
_STOP = re.compile(_MARK + rb"(?<=[a-z]" + _MARK + rb")" + _MARK + rb"*(?=[ \n]|$)")

_encoders: dict[str, "Encoder"] = {}


class _Numbers(dict):
    """Numbers given to words in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Ids:
    """Ids of numbered words, side by side."""

    def __init__(self, dtype: np.dtype):
        self.numbers = _Numbers()
        self.ids = np.empty(1 << 16, dtype)
        self.start = np.zeros(1 << 14, np.int64)  # one more than words
        self.words = self.held = 0

    def add(self, words: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        """The ids of the words numbered next."""
        at, n = int(self.start[self.words]), len(words)
        self.ids = self._room(self.ids, at + len(ids))
        self.start = self._room(self.start, self.words + n + 1)
        self.ids[at : at + len(ids)] = ids
        self.start[self.words + 1 : self.words + n + 1] = at + np.cumsum(lengths)
        self.words += n
        # Python's needs for a word and its number, about.
        self.held += sum(map(len, words)) + 180 * n + self.ids.itemsize * len(ids)

    @staticmethod
    def _room(x: np.ndarray, size: int) -> np.ndarray:
        if size <= len(x):
            return x
        more = np.zeros(max(size, 2 * len(x)), x.dtype)
        more[: len(x)] = x
        return more

    def gather(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words in order, and how many each has."""
        first, count = self.start[words], self.start[words + 1] - self.start[words]
        shift = np.repeat(first - (np.cumsum(count) - count), count)
        return self.ids[np.arange(len(shift)) + shift], count


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as little-endian unsigned 16-bit or, for larger vocabularies, 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        # A letters-only word is one unit of the merges, and its last token carries this mark.
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.last = np.zeros(self.size, bool)
        if mark:
            self.last[[i for token, i in vocab.items() if token.endswith(mark)]] = True
        self.by_word = bool(mark)
        # For words of a to z the tokenizer's normalization changes nothing and white space
        # alone splits them, so the merges can be asked for directly.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        probe = ["abcdefghijklmnopqrstuvwxyz the cat sat"]
        if self._batch(self.merges, probe) != self._batch(self.tokenizer, probe):
            self.merges = self.tokenizer
        self.special = [t.encode() for t in vocab if t.startswith("<|")]
        self.cache = _Ids(self.dtype)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    @staticmethod
    def _batch(tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the words has, and the ids. A word of letters is one unit of the
        merges; those of a to z need no normalization."""
        kind = np.array([w.isalpha() or 2 * w.decode().isalpha() for w in words], np.int8)
        lengths, parts = np.zeros(len(words), np.int64), []
        for k, tokenizer in ((1, self.merges), (2, self.tokenizer), (0, None)):
            at = np.flatnonzero(kind == k)
            some = [words[i] for i in at.tolist()]
            count, ids = self._letters(tokenizer, some) if k else self._others(some)
            lengths[at] = count
            parts.append((at, ids))
        starts = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), self.dtype)
        for at, ids in parts:
            n = lengths[at]
            out[np.arange(len(ids)) + np.repeat(starts[at] - (np.cumsum(n) - n), n)] = ids
        return lengths, out

    def _others(self, words: list[bytes]) -> tuple[list[int], np.ndarray]:
        found = self._batch(self.tokenizer, [w.decode() for w in words])
        return [len(ids) for ids in found], np.array([i for ids in found for i in ids], self.dtype)

    def _letters(self, tokenizer, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts, parts = [np.zeros(0, np.int64)], [np.zeros(0, self.dtype)]
        for k in range(0, len(words), 1024):
            part = words[k : k + 1024]
            ids = np.array(self._batch(tokenizer, [b" ".join(part).decode()])[0], self.dtype)
            count = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
            if len(count) != len(part):  # a letter that becomes several units
                count, ids = self._others(part)
            counts.append(np.array(count, np.int64))
            parts.append(ids)
        return np.concatenate(counts), np.concatenate(parts)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, a null text having none."""
        if not self.by_word:
            return [self._whole(t or "") for t in texts]
        if self.cache.held > MEMORY_BYTES:
            self.cache = _Ids(self.dtype)
        known = self.cache
        number = known.numbers.__getitem__
        numbers, upto, whole = [], [0], {}
        for k, text in enumerate(texts):
            data = (text or "").encode("utf-8", "replace")
            if b"<|" in data and any(s in data.lower() for s in self.special):
                whole[k] = self._whole(text)
                data = b""
            if b"\xcc" not in data and b"\xcd" not in data:  # no combining marks
                data = _STOP.sub(rb" \g<0>", data.lower())  # ASCII letters only
            numbers += map(number, data.split())
            upto.append(len(numbers))
        if len(known.numbers) > known.words:
            new = list(islice(reversed(known.numbers), len(known.numbers) - known.words))[::-1]
            known.add(new, *self._learn(new))
        ids, count = known.gather(np.array(numbers, np.int64))
        ends = np.concatenate(([0], np.cumsum(count)))[upto].tolist()
        return [whole[k] if k in whole else ids[i:j].tobytes() for k, (i, j) in enumerate(zip(ends, ends[1:]))]


def encoder(path: str) -> Encoder:
    """The task's encoder, kept by the Python worker between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def batches(texts: list, rows: int = 256):
    for k in range(0, len(texts), rows):
        yield k, texts[k : k + rows]
