import itertools
import random

import pytest
import xxhash
from conftest import pairs

from quadrille.llm import simhash
from quadrille.llm.graph import components

SPACES = " \t\n\x0b\x0c\r"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in SPACES else c for c in lowered).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=2):
    """Component names by comparing every two fingerprints."""
    of = {p: p for _, p in prints}

    def root(p):
        while of[p] != p:
            p = of[p]
        return p

    for a, b in itertools.combinations(sorted(of), 2):
        if (a ^ b).bit_count() <= bits:
            of[root(a)] = root(b)
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[root(p)] = min(doc, least.get(root(p), doc))
    return {(doc, p): least.get(root(p)) for doc, p in prints}


def check(df):
    want_prints = [(d, slow_fingerprint(t)) for d, t in pairs(df)]
    want = slow_components(want_prints)
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == sorted([(d, p, want[d, p]) for d, p in want_prints], key=repr)


def test_awkward_documents(docs):
    check(docs)


def test_corpus(corpus):
    check(corpus)


def test_query_digits(run):
    rows = run("op5_simhash_dedup")
    assert all(len(r.fingerprint) == 16 and int(r.fingerprint, 16) >= 0 for r in rows)


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


@pytest.mark.parametrize(("bits", "segments"), [(0, 4), (1, 8), (2, 8), (2, 4), (3, 8), (5, 16)])
def test_every_close_pair_is_found(spark, bits, segments):
    rng = random.Random(bits * 100 + segments)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, bits + 2)):
                p ^= 1 << b
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found = [(r.u, r.v) for r in simhash.similar_pairs(df, bits, segments).collect()]
    want = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if ((a ^ b) % (1 << 64)).bit_count() <= bits}
    assert len(found) == len(set(found))
    assert set(found) == want


def test_components_of_chains_and_rings(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    edges += [(rng.randint(300, 340), rng.randint(300, 340)) for _ in range(25)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {}
    for u, v in edges:
        if u != v:
            group = want.get(u, {u}) | want.get(v, {v})
            for node in group:
                want[node] = group
    assert got == {node: min(group) for node, group in want.items()}


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = simhash.near_duplicates(docs).collect()
    rows = kept.collect()
    assert len(rows) == len({r.component_id for r in found})
    of = {(r.doc_id, r.fingerprint): r.component_id for r in found}
    assert sorted(r.doc_id for r in rows) == sorted(set(of.values()))


def test_clashing_names(docs):
    odd = docs.withColumnsRenamed({"source": "fingerprint", "lang": "text_key", "n_chars": "component_id"})
    odd = odd.selectExpr("*", "1 AS u", "2 AS node")
    assert len(simhash.near_duplicates(odd).collect()) == docs.count()
    assert simhash.keep_one(odd).columns == odd.columns


def test_hot_text(spark):
    rows = [(i, "one text that a third of all rows have" if i % 3 == 0 else f"text {i} of its own {i * 7}") for i in range(300)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in found if r.doc_id % 3 == 0} == {0}
