import itertools
import random
import re

import numpy as np
import pytest
from conftest import SF_DIR

from quadrille.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fails(text):
    words = WORD.findall(text)
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def slow(rows, labels):
    """The audit document by document, order by order; rows of (doc_id, text, lang)."""
    judged = {}
    for doc, text, lang in rows:
        copy = doc is not None and any(d is not None and d < doc and (t or "") == (text or "") for d, t, _ in rows)
        fails = slow_fails(text or "") | {"E": copy}
        said = [(q, t) for d, q, t in labels if d is not None and d == doc]
        judged.setdefault(lang or "", []).append((fails, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    found = {}
    for part, docs in judged.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                removed_by[f] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return sorted((*k, *v) for k, v in found.items())


def result(df):
    return sorted((r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                   r.toxic_lost, r.shapley) for r in df.collect())


def test_query(run, spark, corpus):
    rows = [(r.doc_id, r.text, r.lang) for r in corpus.collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()]
    rows_out = run("op13_filter_audit")
    assert sorted((r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                   r.toxic_lost, r.shapley) for r in rows_out) == slow(rows, labels)


@pytest.mark.parametrize("block", [filter_audit.BLOCK, 64])
def test_awkward_documents(spark, docs, block):
    labels = [(5, 1, 0), (5, 0, 1), (None, 1, 1), (3, 1, None), (4, None, 1), (99, 1, 1)]
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    # A clashing extra column is not read.
    from pyspark.sql import functions as F
    found = filter_audit.failures(docs.withColumn("part", F.lit(1)).withColumn("digest", F.lit("x")), df, block=block)
    assert result(filter_audit.audit(found)) == slow(rows, labels)


def test_no_documents(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(no_docs, labels)).collect() == []


def profile(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return filter_audit.profiles(np.frombuffer(b"".join(raw), np.uint8), offsets)[0].T.tolist()


def slow_profile(text):
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def test_one_pass_counts_as_patterns_do():
    rng = random.Random(5)
    signs = ["a", "B", "Z", "é", "日", "𝄞", " ", "\t", "\x0b", "\x1c", "\x85", "　", "#", "|", "x", "xy", "\n"]
    texts = ["", " ", "x", *["".join(rng.choice(signs) for _ in range(rng.randrange(200))) for _ in range(400)]]
    assert profile(texts) == [slow_profile(t) for t in texts]
    for text in texts[-50:]:
        data = np.frombuffer(text.encode(), np.uint8)
        assert filter_audit.profile_long(data, 16).tolist() == slow_profile(text)


def test_equal_hashes_are_compared():
    text = " ".join(f"w{i % 40}" for i in range(300)).encode()
    data = np.frombuffer(text, np.uint8)
    _, starts, ends, owner = filter_audit.transduce(data, np.array([0, len(data)]))
    same = np.zeros(len(starts), np.uint64)
    assert filter_audit.first_spans(data, starts, ends, owner, same).sum() == 40


def test_many_copies_under_one_key_and_without(spark):
    rows = [(None, "copy text", "en")] * 300 + [(7, "copy text", "en")] * 200 + [(i, "copy text", "de") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(7, 1, 1)], "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.failures(df, labels))
    assert result(found) == slow(rows, [(7, 1, 1)])
