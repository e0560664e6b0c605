"""Token ids, packing, the rANS store."""

import random
import zlib

import numpy as np
import pytest

from gondola.llm import cost_packing, rans_store, wordpiece_ids
from helpers import docs, edge_texts, prose


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(wordpiece_ids.tokenizer_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_the_library(tokenizer, monkeypatch):
    rng = random.Random(3)
    odd = [
        "a,,b x, y. Z.\n q... it's, é. …. ẖ H̱, İstan, <|startoftext|> Q <|STARTOFTEXT|>", "ΟΔΟΣ, x", "..., . a 😀, é.é",
        "don't, l'été. I'm 123.45, ﬁ ẞ K \x00 \x1c\x85\xa0z", "É" * 50 + " ," * 9,
        "a,. b'' c'. d_ e…. f<| g|> h$$$\ti!! j'\n k**", "ab!!\n\nab'x. it's. (ok) x_y_ z~~~",
    ]
    texts = odd + edge_texts(rng) + [prose(rng, 30, "aäb,.'1é") for _ in range(50)]
    for cap in (wordpiece_ids.MEMORY_BYTES, 20):
        monkeypatch.setattr(wordpiece_ids, "MEMORY_BYTES", cap)
        encoder = wordpiece_ids.Encoder(wordpiece_ids.tokenizer_path())
        for k, part in wordpiece_ids.batches(texts, 7):
            for text, ids in zip(part, encoder.encode(part)):
                wanted = tokenizer.encode(text or "", add_special_tokens=False).ids
                assert np.frombuffer(ids, encoder.dtype).tolist() == wanted


def test_assignment_is_balanced_and_full():
    rng = random.Random(4)
    for _ in range(20):
        lengths = [rng.choice([1, 5, 100, 2047, 2048, 2049, 9000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 200))]
        pieces, sequences = cost_packing.assign(lengths, 2048)
        assert sequences == sum(n // 2048 for n in lengths) + -(-sum(n % 2048 for n in lengths) // 2048)
        used = {}
        for d, start, n, s, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
            assert n > 0 and offset == used.get(s, 0)
            used[s] = offset + n
        assert sum(2048 - n for n in used.values()) < 2048 and all(n <= 2048 for n in used.values())
        for d, length in enumerate(lengths):
            at = 0
            for _, start, n, _, _ in sorted(p for p in pieces if p[0] == d):
                assert start == at
                at += n
            assert at == length


def test_pack_covers_each_id_once(spark, tokenizer):
    rng = random.Random(5)
    texts = edge_texts(rng)
    table = docs(spark, texts, [*range(len(texts) - 2), 7, None]).selectExpr("*", "1 AS start", "2 AS sequence_id")
    rows = cost_packing.pack(table, group_tokens=5000).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts[:7])}
    for i, wanted in ids.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        at = 0
        for start, n, check, total in pieces:
            assert start == at and check == crc(wanted[start : start + n]) and total == len(wanted)
            at += n
        assert at == len(wanted)
    assert {r.doc_id for r in rows} == {*range(8), None}
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert (o2 == o + n) if s == s2 else o2 == 0
    assert cost_packing.padding(cost_packing.pack(table)).first().tokens == sum(r.length for r in rows)
    assert cost_packing.pack(docs(spark, [])).count() == 0


@pytest.mark.parametrize("n, symbols", [(1, 3), (63, 2), (1000, 60), (70_001, 4000), (262_145, 49_000)])
def test_coder_round_trip(n, symbols):
    rng = np.random.default_rng(n)
    ids = np.minimum((rng.pareto(0.7, n) * 3).astype(np.int64), symbols - 1)
    freq = rans_store.scaled(np.bincount(ids))
    assert freq.sum() == 1 << rans_store.SCALE and ((freq > 0) == (np.bincount(ids) > 0)).all()
    coder = rans_store.Coder(freq)
    lanes, steps, states, starts, words = coder.encode(ids)
    assert (coder.decode(lanes, steps, states, starts, words, n) == ids).all()
    if n > 50_000:  # close to the entropy
        p = np.bincount(ids)[np.bincount(ids) > 0] / n
        assert 32 * len(words) < 1.02 * -(p * np.log2(p)).sum() * n + 64 * lanes
        # one segment is decoded from its checkpoint alone
        k = len(starts) - 1
        part = coder.decode(lanes, steps, states[k * lanes :], starts[k:], words, n - k * steps * lanes)
        assert (part == ids[k * steps * lanes :]).all()


def test_store_round_trip(spark, tokenizer, tmp_path):
    rng = random.Random(6)
    texts = edge_texts(rng)
    order = [5, 3, 9, 1, 7, 0, 8, 2, 4, 6]
    table = docs(spark, [texts[i] for i in order], order).repartition(3).withColumnRenamed("lang", "start")
    rans_store.write(table, str(tmp_path / "a"), block_tokens=500)
    rows = sorted(rans_store.read(spark, str(tmp_path / "a"), with_ids=True).collect())
    start = 0
    for i, row in enumerate(rows):
        wanted = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32, row.ids) == (i, start, len(wanted), crc(wanted), wanted)
        start += len(wanted)
    same = docs(spark, ["b", "a", None, "c"], [1, 1, None, 0])
    rans_store.write(same, str(tmp_path / "b"))
    assert sum(r.n_tokens for r in rans_store.read(spark, str(tmp_path / "b")).collect()) == 7
    rans_store.write(docs(spark, []), str(tmp_path / "c"))
    assert rans_store.read(spark, str(tmp_path / "c")).count() == 0


def test_damage_is_noticed(spark, tmp_path):
    from pyspark.sql import functions as F

    rans_store.write(docs(spark, ["some words here and there"]), str(tmp_path / "a"))
    blocks = spark.read.parquet(str(tmp_path / "a/blocks"))
    blocks.withColumn("states", F.unhex(F.regexp_replace(F.hex("states"), "^..", "ff"))).write.parquet(str(tmp_path / "b/blocks"))
    spark.read.parquet(str(tmp_path / "a/frequencies")).write.parquet(str(tmp_path / "b/frequencies"))
    with pytest.raises(Exception, match="damaged"):
        rans_store.read(spark, str(tmp_path / "b")).collect()


def test_any_changed_column_is_noticed(spark, tmp_path):
    rng = random.Random(9)
    rans_store.write(docs(spark, [prose(rng, 300), None, "a b", prose(rng, 90)]), str(tmp_path / "a"), block_tokens=500)
    coder = rans_store.Coder(rans_store.read_frequencies(spark, str(tmp_path / "a")))
    rows = [r.asDict() for r in spark.read.parquet(str(tmp_path / "a/blocks")).collect()]
    row = max(rows, key=lambda r: r["n_tokens"])
    row = {k: bytes(v) if isinstance(v, bytearray) else v for k, v in row.items()}
    rans_store.decode_segments(coder, row)
    for name, value in row.items():
        if isinstance(value, bytes):
            changes = [value[:k] + bytes([value[k] ^ 1 << k % 8]) + value[k + 1 :] for k in range(len(value))]
        elif isinstance(value, list):
            changes = [value[:k] + [(v or 0) + 1] + value[k + 1 :] for k, v in enumerate(value)] + [value + [1]]
        else:
            changes = [value + 1]
        for changed in changes:
            with pytest.raises(ValueError, match="damaged"):
                rans_store.decode_segments(coder, row | {name: changed})
    other = rans_store.Coder(rans_store.scaled(np.arange(1, 60_000)))
    with pytest.raises(ValueError, match="frequencies"):
        rans_store.decode_segments(other, row)


def test_segments_on_their_own(monkeypatch):
    monkeypatch.setattr(rans_store, "SEGMENT_TOKENS", 1000)
    rng = np.random.default_rng(7)
    ids = rng.zipf(1.3, 6321) % 500
    coder = rans_store.Coder(rans_store.scaled(np.bincount(ids, minlength=500)))
    lanes, steps, states, starts, words = coder.encode(ids)
    row = {
        "part": 0, "seq": 0, "start": 0, "n_tokens": len(ids), "doc_ids": [1], "doc_tokens": [len(ids)],
        "lanes": lanes, "steps": steps, "states": states.tobytes(), "word_starts": starts.tolist(),
        "words": words.tobytes(), "segment_crcs": rans_store._segment_crcs(ids, len(starts), lanes * steps),
    }
    row["row_crc32"] = rans_store._crc(row)
    assert len(starts) > 3
    for first in range(len(starts)):
        for last in range(first + 1, len(starts) + 1):
            wanted = ids[first * lanes * steps : last * lanes * steps]
            assert (rans_store.decode_segments(coder, row, first, last) == wanted).all()
