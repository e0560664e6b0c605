"""Alignment of two tokenizers."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from gondola.llm import queries, token_alignment
from helpers import edge_texts, prose

SCHEMA = "doc_id long, text string"
ODD = [
    None, "", " ", "  ", "\n", "\n\n", " \n ", "a", "a ", "a  b", " a\n\nb \n c\t\td \t e", "é日本𐍈x 🏳️‍🌈 👩‍👩‍👧 ẖ",
    "<|endoftext|> <s> </s> <unk> <0x0A> x", "▁ x▁y", "x\r\ny\r z;\r", "\x00a\x1c b\x85c\xa0d e　f",
    "don't  it's\n  'll", "ſt ﬁ Ⅷ 12345 1,000.5", "word " * 50, "x" * 3000, "日" * 1000, "\ta", "á b",
    " " * 40 + "x" + " " * 40, "\n \n x \n", "a\n b\n  c \n\nd", "𐍈𐍈 \U0001f600\U0001f600\n𐍈",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(rows, libraries):
    """Whole texts in both libraries, all pairs of tokens of a group compared."""
    a, b = libraries
    letters = token_alignment.byte_letters()
    names = {i: t for t, i in a.get_vocab().items()}
    a_bytes = lambda i: bytes(letters[c] for c in names[i])

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    count, docs = collections.Counter(), []
    for doc_id, text in rows:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ((), ())
        data = ([a_bytes(i) for i in ids[0]], [b_bytes(i) for i in ids[1]])
        if not text or any(b"".join(d) != (" " + text).encode() for d in data):
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(x) for x in d]).tolist() for d in data]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(f"{','.join(map(str, ids[0][i:i2]))}|{','.join(map(str, ids[1][j:j2]))}")
            for k in range(i, i2):
                for m in range(j, j2):
                    if max(ends[0][k] - len(data[0][k]), ends[1][m] - len(data[1][m])) < min(ends[0][k], ends[1][m]):
                        links.append((ids[0][k], ids[1][m]))
            i, j = i2, j2
        count.update(links)
        docs.append((doc_id, len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    wanted = [
        (d, na, nb, ng, len(l), sum(count[p] == most[p[1]] for p in l), sum(count[p] for p in l), h)
        for d, na, nb, ng, l, h in docs
    ]
    return wanted, {(x, y, n, n == most[y]) for (x, y), n in count.items()}


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block_bytes", [50, token_alignment.BLOCK_BYTES])
def test_against_brute_force(spark, libraries, block_bytes):
    rng = random.Random(13)
    texts = ODD + edge_texts(rng) + [prose(rng, 30, "aäb ,.'1é日\n") for _ in range(60)] + ODD
    rows = [(k if k % 5 else None, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS n_a", "'x' AS block", "2 AS pairs")
    documents, pairs = token_alignment.align(frame, block_bytes=block_bytes)
    wanted, counted = brute(rows, libraries)
    assert order(documents.collect()) == order(wanted)
    assert set(map(tuple, pairs.collect())) == counted


def test_small_memory_and_empty(spark, libraries, monkeypatch):
    rng = random.Random(14)
    texts = [prose(rng, 200, "abcdeé") for _ in range(20)]
    aligner = token_alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(token_alignment, "MEMORY_BYTES", 5000)
    memory = token_alignment._Memory(aligner)
    segments = [s for t in texts for s in aligner.segments(t)]
    assert memory.aligned(segments) == aligner.align(segments)
    assert memory.aligned(segments[::-1]) == aligner.align(segments[::-1])
    documents, pairs = token_alignment.align(spark.createDataFrame([], SCHEMA))
    assert documents.collect() == [] and pairs.collect() == []
    documents, _ = token_alignment.align(spark.createDataFrame([(1, None), (2, "")], SCHEMA))
    assert order(documents.collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_on_the_given_table(spark, sf, libraries):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    assert order(queries.op13_token_alignment(spark, sf).collect()) == order(brute(rows, libraries)[0])
