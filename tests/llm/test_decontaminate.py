import hashlib
import re

import pytest
from conftest import NEAR, PROSE, pairs

from quadrille.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, n=13):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - n + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words, hit, found = words_of(text), set(), set()
        for length in lengths:
            for i in range(len(words) - length + 1):
                met = windows.get(tuple(words[i : i + length]))
                if met:
                    hit |= set(range(i, i + length))
                    found |= met
        out.append((doc, len(words), len(hit), frozenset(found), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def got(df, bench, **how):
    rows = decontaminate.contamination(df, bench, **how).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, frozenset(r["items"]), r.contaminated) for r in rows], key=repr)


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, PROSE), (2, NEAR), (2, "short line"), (3, "a b"), (4, None), (5, "!!!"), (6, "日本語 ТЕКСТ"),
             (7, "a b c d e f g h i j k l m n"), (8, "c d e f g h i j k l m n o p")]
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_awkward_documents(docs, bench, limit):
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert got(docs, bench, broadcast_bytes=limit) == slow(pairs(docs), items)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_corpus(spark, corpus, limit):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert got(corpus, bench, broadcast_bytes=limit) == slow(pairs(corpus), items)


def test_query_digests(run):
    for r in run("op6_decontamination"):
        assert (r.items_sha256 == hashlib.sha256(b"").hexdigest()) == (r.n_items == 0)


def test_empty(docs, no_docs, bench):
    none = bench.limit(0)
    assert got(no_docs, bench) == []
    assert [x[2:] for x in got(docs, none)] == [(0, frozenset(), False)] * docs.count()
    assert decontaminate.clean_documents(docs, none).count() == docs.count()


def test_clean_documents(docs, bench):
    kept = decontaminate.clean_documents(docs, bench)
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = [t for t in pairs(docs) if not slow([t], items)[0][4]]
    assert kept.columns == docs.columns
    assert pairs(kept) == want


def test_without_spans(spark, bench):
    text = f"Before, {PROSE.upper()}! after it. And a B."
    df = spark.createDataFrame([(1, text, 0), (2, "(clean text)", 0), (3, None, 0)], "doc_id bigint, text string, at int")
    found = {r.doc_id: r.text for r in decontaminate.without_spans(df, bench).collect()}
    assert found == {1: "Before, after it. And ", 2: "(clean text)", 3: None}


def test_clashing_names(docs, bench):
    odd = docs.withColumnsRenamed({"source": "items", "lang": "words", "n_chars": "hash"}).selectExpr("*", "1 AS at")
    assert decontaminate.contamination(odd, bench).count() == docs.count()
    assert decontaminate.clean_documents(odd, bench).columns == odd.columns


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_windows_at_every_border_of_blocks(spark, bench, limit):
    items = [(r.item_id, r.text) for r in bench.collect()]
    size = decontaminate.BLOCK + decontaminate.WINDOW
    texts = [" ".join(["x"] * before + ["a b c d e f g h i j k l m n"] + ["y"] * after)
             for before in range(size) for after in (0, 1, size)]
    texts += [" ".join(["a"] * n) for n in range(2 * size)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(df, bench, broadcast_bytes=limit) == slow(pairs(df), items)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_a_text_of_half_a_million_words(spark, bench, limit):
    items = [(r.item_id, r.text) for r in bench.collect()]
    text = " ".join(f"w{i % 977}" for i in range(499_980)) + " " + PROSE
    df = spark.createDataFrame([(1, text), (2, "short line")], "doc_id bigint, text string")
    assert got(df, bench, broadcast_bytes=limit) == slow(pairs(df), items)
