import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import TEXTS, pairs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quadrille.llm import bpe_numpy, token_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTES)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
CODEC, COUNTER = bpe_numpy.load(BYTES), token_counts.load(PIECES)
ODD = ["a" * 3000, "=" * 777, " " * 500, "\n" * 99, "ab" * 2000, "中" * 500 + "文" * 400, "<|endoftext|>" * 3, "▁ ▁"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_library_ids_and_text():
    texts = [t or "" for t in TEXTS] + ODD
    for text, ids in zip(texts, CODEC.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
        assert CODEC.decode(ids) == LIBRARY.decode(ids_of(text), skip_special_tokens=False) == text


def test_library_counts():
    texts = [t or "" for t in TEXTS] + ODD
    assert COUNTER.count(texts) == [len(x) for x in MODEL.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = CODEC.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
    assert CODEC.decode(ids) == text
    assert COUNTER.count([text]) == [len(MODEL.encode(text))]


def test_a_full_memory_of_words(monkeypatch):
    monkeypatch.setattr(bpe_numpy, "KNOWN_WORDS", 50)
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 50)
    rng = random.Random(1)
    codec, counter = bpe_numpy.Bpe(BYTES), token_counts.Counter(PIECES)
    for _ in range(20):
        texts = ["".join(rng.choice("abcdefgh  ") for _ in range(100)) for _ in range(3)]
        assert [np.frombuffer(b, "<u4").tolist() for b in codec.encode(texts)] == [ids_of(t) for t in texts]
        assert counter.count(texts) == [len(x) for x in MODEL.encode(texts)]


def test_merges_that_must_wait(tmp_path):
    """A pair whose product has an earlier pair merges at one place a round, as the library does."""
    import json

    letters = "abc"
    merges = [["b", "c"], ["a", "b"], ["abc", "a"], ["ab", "c"], ["a", "bc"]]
    vocab = {t: i for i, t in enumerate(sorted(bpe_numpy.byte_letters()))}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    vocab.setdefault("abc", len(vocab))
    spec = json.loads(LIBRARY.to_str())
    spec["model"] |= {"vocab": vocab, "merges": merges}
    spec["added_tokens"] = []
    path = str(tmp_path / "tiny.json")
    with open(path, "w") as file:
        json.dump(spec, file)
    tiny, codec = Tokenizer.from_file(path), bpe_numpy.Bpe(path)
    assert not codec.at_once.all()
    rng = random.Random(2)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(500)]
    assert [np.frombuffer(b, "<u4").tolist() for b in codec.encode(texts)] == [tiny.encode(t).ids for t in texts]


def test_tables(docs, no_docs):
    coded = bpe_numpy.encode(docs, BYTES)
    assert sorted((r.doc_id, r.text, tuple(r.ids)) for r in coded.collect() if r.doc_id is not None and r.text) == sorted(
        (d, t, tuple(ids_of(t))) for d, t in pairs(docs) if d is not None and t)
    back = bpe_numpy.decode(coded, BYTES, into="again")
    assert all(r.again == (r.text or "") for r in back.collect())
    for empty in (bpe_numpy.encode(no_docs, BYTES), bpe_numpy.token_digests(no_docs, BYTES),
                  token_counts.count_tokens(no_docs, PIECES)):
        assert empty.collect() == []


def test_digests_and_clashing_names(docs):
    odd = docs.withColumnsRenamed({"lang": "n_tokens", "source": "ids_sha256", "n_chars": "n_bytes"})
    found = bpe_numpy.token_digests(odd, BYTES)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted(((d, len(ids_of(t)), hashlib.sha256(np.array(ids_of(t), "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in pairs(docs)), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()), key=repr) == want
    counted = token_counts.count_tokens(odd, PIECES)
    assert counted.columns == ["doc_id", "ids_sha256", "n_bytes", "n_tokens"]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in counted.collect()), key=repr) == sorted(
        ((d, len((t or "").encode()), len(MODEL.encode(t or ""))) for d, t in pairs(docs)), key=repr)


@pytest.mark.parametrize("name", ["op2_token_counts", "op7_bpe_codec"])
def test_queries(run, corpus, name):
    texts = dict(pairs(corpus))
    for r in run(name):
        if name == "op2_token_counts":
            n = len(MODEL.encode(texts[r.doc_id]))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
        else:
            ids = ids_of(texts[r.doc_id])
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
