"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from scanweave.llm import pieces
from scanweave.llm.pieces import Encoder, decode_documents, encode_documents, pieces_of
from scanweave.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, decoded int"
TEXTS = [
    None, "", " ", "   a  b", " " * 700, "▁▁ x ▁", "\n\n a\n b\tc\r\n", "日本語のテキスト", "\U0001f600 x\x00y\x1f", "a" * 500,
    "<s> </s> <unk> <0x0A>", "=" * 777, "﻿ x​   y", "ﬁ é é", "the " * 5000, "0123456789" * 400,
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def _random_texts(seed=3):
    rng = random.Random(seed)
    for letters in ("ab", "abc d", "the an", "=- ", "。、日本 a", "\n\t  ab", "eatrionsl "):
        for n in (3, 10, 50, 300, 2000):
            yield from ("".join(rng.choice(letters) for _ in range(n)) for _ in range(8))


@pytest.mark.parametrize("in_rounds, cache", [(pieces.IN_ROUNDS, pieces.CACHE), (2, 5)])
def test_encode_and_decode(library, monkeypatch, in_rounds, cache):
    monkeypatch.setattr(pieces, "IN_ROUNDS", in_rounds)
    monkeypatch.setattr(pieces, "CACHE", cache)
    model, encoder = pieces_of(PATH), Encoder(pieces_of(PATH))
    some = [*TEXTS, *_random_texts()]
    for k in range(0, len(some), 50):
        part = some[k : k + 50]
        made = [np.frombuffer(x, "<i4") for x in encoder.encode(part)]
        expected = library.encode([t or "" for t in part])
        assert [x.tolist() for x in made] == expected
        texts = model.decode(np.concatenate(made), np.array([len(x) for x in made]))
        assert [t.decode() for t in texts] == [library.decode(x) for x in expected]


def test_decode_of_any_ids(library):
    rng, model = random.Random(4), pieces_of(PATH)
    for _ in range(1500):
        runs = [[rng.choice([rng.randrange(32000), rng.randrange(131, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 9))] for _ in range(3)]
        made = model.decode(np.array([i for r in runs for i in r], np.int64), np.array([len(r) for r in runs]))
        assert [t.decode() for t in made] == [library.decode(r) for r in runs]


def test_tables(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "no id", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = encode_documents(docs, PATH)
    assert Counter((r.doc_id, tuple(r.ids)) for r in made.collect()) == Counter(
        (r[0], tuple(library.encode(r[1] or ""))) for r in rows
    )
    back = decode_documents(made, PATH)
    expected = Counter((r[0], library.decode(library.encode(r[1] or ""))) for r in rows)
    assert Counter(map(tuple, back.collect())) == expected
    none = docs.where("doc_id = -1")
    assert encode_documents(none, PATH).count() == decode_documents(made.limit(0), PATH).count() == 0


def test_query(spark, library):
    found = QUERIES["op12_sentencepiece"](spark, SMALL)
    assert found.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        of = [",".join(map(str, ids)), library.decode(ids)]
        expected[r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in of)] += 1
    assert Counter(map(tuple, found.collect())) == expected
