import hashlib
import re

import pytest
from conftest import TEXTS, pairs

from quadrille.llm import order_minhash as O

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def hash_of(spark):
    """Spark's hash of a row of strings or numbers."""
    from pyspark.sql import functions as F

    def of(rows, kind):
        df = spark.createDataFrame([(i, list(r)) for i, r in enumerate(rows)], f"i int, r array<{kind}>").repartition(4)
        return [x.h for x in df.select("i", F.xxhash64("r").alias("h")).orderBy("i").collect()]

    return of


def slow(text, hash_of, k=O.K, bins=O.BINS, take=O.TAKE):
    """The entries by numbering, ranking and selecting one k-mer after the other."""
    words = WORD.findall(text or "")
    kmers = [words[i : i + k] for i in range(len(words) - k + 1)]
    if not kmers and words:
        kmers = [[" ".join(words)]]
    base = [h % (1 << 39) for h in hash_of(kmers, "string")] if kmers else []
    seen, numbers = {}, []
    for h in base:
        numbers.append(seen.get(h, 0))
        seen[h] = numbers[-1] + 1
    again = [(h, o) for h, o in zip(base, numbers) if o]
    mixed = iter(again_hashes(again))
    ranks = [h if not o else next(mixed) for h, o in zip(base, numbers)]
    out = []
    for b in range(bins):
        mine = sorted((r, p) for p, r in enumerate(ranks) if r >> 34 == b)[:take]
        listed = [r for _, r in sorted((p, r) for r, p in mine)]
        out.append(hash_of([listed], "long")[0] % (1 << 32) if listed else 0)
    return "".join(f"{e:08x}" for e in out)


def again_hashes(pairs_):
    return [AGAIN[p] for p in pairs_]


AGAIN = {}


def test_entries_by_brute_force(spark, hash_of):
    from pyspark.sql import functions as F

    texts = ["a b c d e f g", "a b c a b c a b c a b c x", "one", "", None, "  \n two\twords ", "z " * 40, TEXTS[5]]
    for text in texts:
        words = WORD.findall(text or "")
        kmers = [words[i : i + O.K] for i in range(len(words) - O.K + 1)]
        base = {h % (1 << 39) for h in hash_of(kmers, "string")} if kmers else set()
        todo = [(h, o) for h in base for o in range(1, 60)]
        if todo:
            rows = spark.createDataFrame(todo, "h long, o int").select("h", "o", F.xxhash64("h", "o").alias("x")).collect()
            AGAIN.update({(r.h, r.o): r.x % (1 << 39) for r in rows})
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.fp for r in O.with_fingerprint(df, "text", "fp").collect()}
    for i, text in enumerate(texts):
        assert got[i] == slow(text, hash_of), text


def next_of(rows):
    """Each row's successor in descending order of (doc_id, hash of the text), around."""
    return {a: b for a, b in zip(rows, rows[1:] + rows[:1])}


def test_corpus_edits(run, corpus):
    rows = sorted(pairs(corpus), reverse=True)
    after = next_of(rows)
    found = {r.doc_id: r for r in run("op10_order_minhash")}
    for doc, text in rows:
        k = len(text) // 3
        changed = text[: len(text) - k] + after[doc, text][1][:k]
        r = found[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= r.near_next <= 1
        other = found[after[doc, text][0]].fingerprint
        for near, fp in ((r.near_edited, r.edited_fingerprint), (r.near_next, other)):
            own = [(r.fingerprint[i : i + 8], fp[i : i + 8]) for i in range(0, 8 * O.BINS, 8)]
            filled = [(a, b) for a, b in own if (a, b) != ("0" * 8, "0" * 8)]
            want = sum(a == b for a, b in filled) / len(filled) if filled else 1.0
            assert near == pytest.approx(want)
    texts = {}
    for doc, text in rows:
        assert texts.setdefault(text, found[doc].fingerprint) == found[doc].fingerprint
    longer = [r for r in found.values() if r.n_chars > 500]
    assert sum(r.near_edited for r in longer) > 10 * sum(r.near_next for r in longer)


@pytest.mark.parametrize("task_bytes", [1 << 30, 300])
def test_awkward_documents(spark, docs, task_bytes):
    from pyspark.sql import functions as F

    found = O.compared(docs, task_bytes=task_bytes).collect()
    ordered = [(r.doc_id, r.text or "") for r in docs.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")
    ).orderBy(F.col("doc_id").desc_nulls_last(), "t").collect()]
    want = []
    for (doc, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1]):
        k = len(text) // 3
        want.append((doc, len(text), text[: len(text) - k] + other[:k]))
    assert sorted(((r.doc_id, r.n_chars, r.edited_text) for r in found), key=repr) == sorted(want, key=repr)


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    halves = words[200:] + words[:200]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(halves)), (3, " ".join(words[:-1] + ["new"]))], "i int, text string")
    fp = {r.i: r.fp for r in O.with_fingerprint(df, "text", "fp").collect()}
    same = lambda a, b: sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 256, 8)) / 32
    assert same(fp[1], fp[3]) > 0.85
    assert same(fp[1], fp[2]) < 0.75


def test_empty_single_and_clashing_names(spark, docs, no_docs):
    assert O.compared(no_docs).collect() == []
    one = O.compared(spark.createDataFrame([(1, "abc def")], "doc_id long, text string")).first()
    assert (one.edited_text, one.near_next) == ("abc dab", 1.0)
    odd = docs.withColumnsRenamed({"source": "__words", "lang": "fingerprint", "n_chars": "next_text"})
    assert O.compared(odd).count() == docs.count()
