"""Token ids against the library whose files are used, exact round trips, and long pieces."""

import random
import time

import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from llm_rows import documents, read
from pyspark.sql import functions as F

from starrung.llm import bpe
from starrung.llm.bpe import decode_documents, encode_documents, encode_pieces, make_vocabulary, merge_long, read_vocabulary
from starrung.llm.queries import op12_byte_bpe


@pytest.fixture(scope="module")
def library():
    ranks = read_vocabulary().ids
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def one_by_one(piece, ranks):
    """The merges of a piece, each the leftmost one of the least rank."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 40, 0))
        if best[0] == 1 << 40:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def encoded(texts):
    encoder = bpe.Encoder(read_vocabulary())
    ids, counts = encoder.encode(texts)
    ends = counts.cumsum()
    return [ids[e - c : e].tolist() for e, c in zip(ends.tolist(), counts.tolist())]


def test_like_the_library(library):
    draw = random.Random(3)
    some = ["a", "b", "A", " ", "  ", "\n", "\t", "12", "é", "ß", "'s", "'", "中文", "🙂", " ", "　", "-", "_", "the",
            "\x1c", "\x85", "​", ".", "<|endoftext|>", "\x00", "ا", "ǅ", "٣", "²"]
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(80))) for _ in range(3000)]
    texts += ["", " ", "a" * 1000, "ab" * 700, " " * 5000, "-=" * 3000, "é" * 2000, "x" * 50_000,
              "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))]
    texts += ["".join(draw.choice("etaoinshr") for _ in range(draw.randrange(200, 900))) for _ in range(60)]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_all_code_points_split_alike(library):
    texts = [f"a{c}b 1{c}2 {c}{c}\t{c} " for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000, 7)])]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_long_texts_and_forgotten_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 11)
    texts = ["", "one two three " * 20, "x", " ".join(f"w{i}" for i in range(100)), "", "1 2"]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_any_ranks(seed):
    """Ranks in no sensible order, in which a merge can open a pair of a lower rank."""
    draw = random.Random(seed)
    words = {bytes(draw.choice(b"abc") for _ in range(draw.randrange(2, 6))) for _ in range(60)}
    ranks = {bytes([b]): i for i, b in enumerate(range(256))}
    ranks |= {w: 256 + i for i, w in enumerate(draw.sample(sorted(words), len(words)))}
    vocabulary = make_vocabulary(ranks, r"\S+|\s+")
    pieces = [bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, 40))) for _ in range(300)]
    want = [one_by_one(p, ranks) for p in pieces]
    assert [x.tolist() for x in encode_pieces(pieces, vocabulary)] == want
    for piece, ids in zip(pieces, want):
        if piece not in ranks:
            assert merge_long(vocabulary.single[list(piece)], vocabulary).tolist() == ids


def test_a_long_word_takes_seconds(library):
    draw = random.Random(5)
    word = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    began = time.monotonic()
    assert encoded([word]) == [library.encode_ordinary(word)]
    assert time.monotonic() - began < 30


def test_documents_and_back(spark, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "null id"), (None, "ünï"), (4, "long " * 100_000), (5, " \n\t")]
    docs = documents(spark, rows).withColumn("ids", F.lit("clash"))
    ids = encode_documents(docs)
    got = sorted(((r.doc_id, r.ids) for r in ids.collect()), key=str)
    assert got == sorted(((k, library.encode_ordinary(t or "")) for k, t in rows), key=str)
    back = decode_documents(ids.withColumn("n", F.size("ids")), carry=("n",)).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in back), key=str) == sorted(((k, t or "") for k, t in rows), key=str)
    assert encode_documents(docs.limit(0)).collect() == decode_documents(ids.limit(0)).collect() == []


def test_decoding_odd_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 65, -1, 10**6]), (None, [64])], "doc_id long, ids array<int>")
    token = read_vocabulary().tokens
    got = {r.doc_id: bytes(r.decoded) for r in decode_documents(rows).collect()}
    assert got == {1: b"", 2: b"", 3: token[64] + token[65], None: token[64]}


def test_query_like_the_library(spark, library):
    from hashlib import sha256

    got = {r.doc_id: r for r in op12_byte_bpe(spark, DATA).collect()}
    for doc in read(spark, "documents").collect():
        ids, row = library.encode_ordinary(doc.text or ""), got.pop(doc.doc_id)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256((doc.text or "").encode()).hexdigest()
    assert not got
