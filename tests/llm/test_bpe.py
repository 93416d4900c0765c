"""Held against the tokenizers library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from airshed.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(PATH)


def ids(x):
    return np.frombuffer(x, "<u4").tolist()


def test_random_texts_equal_the_library(library, vocab):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "the", "ing", "'s", "'ll", "1", "22", "é", "ü", "<|endoftext|>", "<|endoftext", "日本", "\x1c", "　", "!", "\t", "aaaa" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    got = bpe.Encoder(vocab).encode(texts)
    for t, g, w in zip(texts, got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(g) == w.ids, t
        assert bpe.decode(g, vocab) == library.decode(w.ids, skip_special_tokens=False) == t


def test_every_code_point(library, vocab):
    texts = ["".join(f"a{chr(c)} {chr(c)}1" for c in range(k, min(k + 64, 0x110000)) if not 0xD800 <= c <= 0xDFFF) for k in range(0, 0x110000, 64 * 37)]
    assert [ids(x) for x in bpe.Encoder(vocab).encode(texts)] == [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 129, 20_000])
def test_row_and_single_trees_agree_with_the_library(library, vocab, size):
    rng = random.Random(size)
    piece = "".join(rng.choice("etaoinshr") for _ in range(size))
    assert ids(bpe.encode_long(piece.encode(), vocab)) == library.encode(piece, add_special_tokens=False).ids
    if size <= bpe.ROW_BYTES:
        assert bpe.encode_rows([piece.encode()], vocab) == [bpe.encode_long(piece.encode(), vocab)]


def test_forgetting_changes_nothing(monkeypatch, vocab):
    texts = [f"word{k % 50} other{k}" for k in range(300)]
    whole = bpe.Encoder(vocab).encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "_GROUP", 30)
    assert bpe.Encoder(vocab).encode(texts) == whole


def test_documents(docs, none, texts, library):
    rows = bpe.round_trip(docs, PATH).collect()
    want = sorted((str(i), hashlib.sha256(np.array(e := library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest(), len(e), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts)
    assert sorted((str(r.doc_id), r.ids_sha256, r.n_tokens, r.decoded_sha256) for r in rows) == want
    kept = bpe.encode_with_digests(docs, PATH).collect()
    assert all(len(r.ids) == r.n_tokens for r in kept)
    assert sorted(r.decoded for r in bpe.encode_documents(docs, PATH).collect()) == sorted(t or "" for _, t in texts)
    assert bpe.round_trip(none, PATH).collect() == []
