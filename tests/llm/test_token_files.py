import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import pairs
from tokenizers import Tokenizer

from quadrille.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def slow(rows):
    """(doc_id, start, n_tokens, crc32) by the library, one text after the other."""
    place, found = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((doc, place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        place += len(ids)
    return found


def test_query(run, corpus):
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in run("op11_token_files")]
    assert sorted(rows) == slow(pairs(corpus))


@pytest.mark.parametrize("part_bytes", [10**9, 9000, 200])
def test_awkward_documents(spark, docs, part_bytes):
    folder = token_files.write_tokens(docs, PATH, end_id=0, part_bytes=part_bytes)
    found = token_files.read_checksums(spark, folder).collect()
    want = slow(pairs(docs))
    assert sorted((r.key is not None, r.key, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (d is not None, d, n, c) for d, _, n, c in want)
    # Gapless, and keys never descend along the files.
    ordered = sorted(found, key=lambda r: r.start)
    place = 0
    for r in ordered:
        assert r.start == place
        place += r.n_tokens
    keys = [r.key for r in ordered]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    about = token_files.manifest(folder)
    assert about["token_base"][-1] == place and about["doc_base"][-1] == len(found)


def test_ids_at_any_place_and_as_documents(spark, docs):
    folder = token_files.write_tokens(docs, PATH, part_bytes=10000)
    rows = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    flat = [i for r in rows for i in r.ids]
    assert token_files.read_ids(folder, 0, 10**9).tolist() == flat
    assert token_files.read_ids(folder, 2900, 9100).tolist() == flat[2900:9100]
    by_text = sorted(LIBRARY.encode(t or "", add_special_tokens=False).ids for _, t in pairs(docs))
    assert sorted(list(r.ids) for r in rows) == by_text


def test_one_key_with_most_rows_spreads_over_parts(spark):
    rows = [(7, "the same text again")] * 400 + [(None, "no key")] * 300 + [(i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    folder = token_files.write_tokens(df, PATH, end_id=0, part_bytes=1600)
    about = token_files.manifest(folder)
    assert max(docs for _, docs, _ in about["parts"]) < 250
    found = token_files.read_checksums(spark, folder)
    assert sorted((r.start, r.n_tokens) for r in found.collect()) == sorted((s, n) for _, s, n, _ in slow(rows))


def test_words_are_cut_where_the_tokenizer_cuts(monkeypatch):
    rng = random.Random(3)
    words = ["it's", "the", "A1", "ß", "日本", "x" * 50, "<|endoftext|>", "\n\n", "  ", "end.", "don't", "", "\t", "a\nb", "\x0b", "　", "\x85!"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += [" ".join(rng.choice(words) for _ in range(20_000)), "a\0 b c", " ", ""]
    for long, known in ((1 << 20, 200_000), (40, 30)):
        monkeypatch.setattr(token_files, "KNOWN_WORDS", known)
        monkeypatch.setattr(token_files.pieces, "__defaults__", (long,))
        code = token_files.Encoder(PATH)
        assert code.by_words and all("".join(token_files.pieces(t)) == t for t in texts)
        for text, ids in zip(texts, code.encode(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_each_different_chunk_is_encoded_once():
    given = []

    class Library:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return LIBRARY.encode_batch_fast(texts, **options)

    rng = random.Random(5)
    words = [f"w{i}x{i * i}," for i in range(300)]
    texts = ["At " + " ".join(rng.choice(words) for _ in range(200)) for _ in range(50)]
    code = token_files.Encoder(PATH)
    code.library = Library()
    assert [np.frombuffer(i, "<u2").tolist() for i in code.encode(texts)] == [e.ids for e in LIBRARY.encode_batch(texts)]
    used = {word for text in texts for word in text.split()[1:]}
    assert sorted(word for text in given for word in text.split() if word != "At") == sorted(used)


@pytest.mark.parametrize("at_once", [1, 60, 10**6])
def test_white_space_beside_spaces(monkeypatch, at_once):
    monkeypatch.setattr(token_files, "ROUND", at_once)
    monkeypatch.setattr(token_files, "JOINED", 3)
    white = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["\u200b", "\ufeff", "\0"]
    texts = [t for w in white for t in (f"a{w} b c", f"a {w}b c", f"a {w} b", f" {w}a b", f"a b{w}", f"{w}a b ", f"a{w}b c", w)]
    texts += ["even after odd", "a  b  c", "  ", " a", "a ", "", "<|endoftext|> a <|endoftext|>b c<|endoftext|>", "a <|endoftext|>  <|endoftext|>", "Ġa Ġ ĠĠ b"]
    code = token_files.Encoder(PATH)
    for text, ids in zip(texts, code.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text
    assert list(code.encode([])) == []


def test_a_tokenizer_that_is_not_byte_level_gets_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    code, library = token_files.Encoder(path), Tokenizer.from_file(path)
    texts = ["Hello  world", "", "it's A b c"]
    assert not code.by_words
    assert [np.frombuffer(i, "<u2").tolist() for i in code.encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_keys_clashing_names_and_empty_tables(spark, no_docs):
    df = spark.createDataFrame([("b", "x y", 1, 2), ("a", None, 3, 4)], "name string, body string, key int, ids int")
    folder = token_files.write_tokens(df, PATH, key="name", text="body", end_id=5)
    assert [(r.key, r.start, list(r.ids)) for r in token_files.read_documents(spark, folder).orderBy("start").collect()] == [
        ("a", 0, [5]), ("b", 1, [*LIBRARY.encode("x y").ids, 5])]
    empty = token_files.write_tokens(no_docs, PATH)
    assert token_files.read_checksums(spark, empty).collect() == []
    assert len(token_files.read_ids(empty, 0, 10)) == 0
