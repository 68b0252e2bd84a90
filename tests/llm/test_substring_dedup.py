import hashlib
import random
import re

import numpy as np
import pytest
from conftest import pairs

from quadrille.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, n=13):
    first = {}
    rank = lambda d: (d is None, d or 0)
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            first[w] = min(first.get(w, rank(doc)), rank(doc))
    out = []
    for doc, text in rows:
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - n + 1):
            if first[tuple(words[i : i + n])] < rank(doc):
                gone |= set(range(i, i + n))
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, None if text is None else left, len(words), len(gone)))
    return sorted(out, key=repr)


def got(df, **how):
    return sorted([(r.doc_id, r.text, r.n_words, r.n_removed) for r in S.dedup_substrings(df, **how).collect()], key=repr)


def test_awkward_documents(docs):
    assert got(docs) == slow(pairs(docs))
    assert got(docs, n=3) == slow(pairs(docs), 3)


def test_corpus(corpus):
    assert got(corpus) == slow(pairs(corpus))


def test_query(run, corpus):
    want = {d: (n, r, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, r in slow(pairs(corpus))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run("op8_substring_dedup")} == want


def test_small_chunks_and_many_ranges(spark, corpus, monkeypatch):
    """Repeats within a chunk, across chunks and within a document, in ranges of a few windows."""
    rng = random.Random(6)
    shared = [" ".join(rng.choice("abcdef") * 2 for _ in range(20)) for _ in range(5)]
    rows = [(rng.randint(0, 60), " \n".join(rng.choice(shared) if rng.random() < 0.5 else f"own {i} {k} " * 9 for k in range(6)))
            for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(S, "RANGE_WINDOWS", 50)
    monkeypatch.setattr(S, "CHUNK_WINDOWS", 100)
    assert got(df) == slow(rows)


def test_a_passage_of_a_third_of_the_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"start{i} {passage} end{i}" if i % 3 == 0 else " ".join(f"w{i}x{k}" for k in range(30))) for i in range(300)]
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {d: r for d, _, _, r in found if r} == {i: 60 for i in range(3, 300, 3)}


def test_word_hashes_across_blocks(monkeypatch):
    data = (b"alpha beta\tgamma  " * 3000) + b"x" * 9000 + b" end"
    whole, starts = S.word_hashes(data)
    monkeypatch.setattr(S, "BLOCK_BYTES", 1000)
    cut, cut_starts = S.word_hashes(data)
    assert np.array_equal(whole, cut) and np.array_equal(starts, cut_starts)
    assert len(whole) == len(data.split())
    assert [data[s:].split()[0] for s in starts.tolist()[:9]] == data.split()[:9]
    assert len(set(whole.tolist())) == len(set(data.split()))


def test_planes():
    values = np.random.default_rng(1).integers(0, 2**63, 100, dtype=np.int64)
    assert np.array_equal(S.from_planes(S.planes(values), np.int64), values)


def test_empty(no_docs):
    assert S.dedup_substrings(no_docs).collect() == []


@pytest.mark.parametrize("name", ["doc", "hashes", "__gone", "__doc", "range"])
def test_clashing_names(docs, name):
    odd = docs.withColumnRenamed("source", name).selectExpr("*", "1 AS n_words")
    out = S.dedup_substrings(odd)
    assert out.columns == ["doc_id", "text", "lang", name, "n_chars", "n_words", "n_removed"]
    assert out.count() == docs.count()
