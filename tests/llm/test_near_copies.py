import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from conftest import SF_DIR

from quadrille.llm import near_copies


def slow_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def slow_kept(rows):
    """The smallest id of each component, by comparing every two texts."""
    sets = {i: slow_set(t) for i, t in rows}
    of = {i: i for i in sets}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            of[root(a)] = root(b)
    least = {}
    for i in sets:
        least[root(i)] = min(i, least.get(root(i), i))
    return sorted(least.values())


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("bucket", [128, 4])
def test_near_copies_against_brute_force(spark, bucket):
    rng = random.Random(bucket)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([5, 30, 90, 200]))]
        texts += [" ".join(words), *[varied(rng, words, rng.choice([0, 1, 1, 2, 4])) for _ in range(4)]]
    rng.shuffle(texts)
    rows = list(enumerate([*texts, "", "a b c", "A  b c", "a b d"]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in near_copies.keep_one(df, bucket=bucket).collect()) == slow_kept(rows)


def test_stage_drops_copies_with_one_word_changed(spark):
    rng = random.Random(1)
    rows = []
    for i in range(0, 60, 2):
        words = [f"word{rng.randrange(10**6)}" for _ in range(80)]
        rows += [(i, " ".join(words)), (i + 1, varied(rng, words, 1))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.one_of_a_kind(spark, df, SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 60, 2))


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, varied(rng, words, 1)) for i in range(300)] + [(300 + i, f"text {i} of its own {i * 7} here") for i in range(20)]
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == slow_kept(rows)


def test_signatures_never_part_similar_sets():
    rng = np.random.default_rng(9)
    for n in (1, 7, 64, 65, 129, 1000, 5000):
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        for change in (0, n // 20, n // 9):
            other = np.unique(np.concatenate([base[change:], rng.integers(0, 2**64, change + n // 40, dtype=np.uint64)]))
            differ = len(np.setxor1d(base, other))
            assert near_copies.cells_apart(near_copies.signature(np.sort(base)), near_copies.signature(other)) <= differ
        far = rng.integers(0, 2**64, n, dtype=np.uint64)
        assert n < 60 or near_copies.cells_apart(near_copies.signature(base), near_copies.signature(far)) * 9 > 2 * n


def family(rng, pairs):
    """Pairs of 40-word texts of one template, four words changed per pair, partners differ in the last word."""
    template = [f"t{i}" for i in range(40)]
    rows = []
    for p in range(pairs):
        words = list(template)
        for at in rng.sample(range(39), 4):
            words[at] = f"p{p}x{at}"
        rows += [" ".join([*words[:39], f"a{p}"]), " ".join([*words[:39], f"b{p}"])]
    return rows


@pytest.mark.parametrize("how", [{}, {"bucket": 4, "leaders": 2}])
def test_links_hidden_in_a_family_of_texts(spark, how):
    texts = family(random.Random(7), 300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert sorted(r.doc_id for r in near_copies.keep_one(df, **how).collect()) == slow_kept(list(enumerate(texts)))


def test_links_whose_hashes_are_all_common(spark):
    # Texts made of few phrases: every shingle is common, and most pairs are below 0.8.
    rng = random.Random(8)
    phrases = [" ".join(f"ph{i}w{k}" for k in range(9)) for i in range(9)]
    texts = [" ".join(rng.sample(phrases, 5)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    found = near_copies.keep_one(df, bucket=3, leaders=1).collect()
    assert sorted(r.doc_id for r in found) == slow_kept(list(enumerate(texts)))


def test_a_repeated_phrase_does_not_hide_a_copy(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(words)), (2, " ".join(words) + " again and again it goes" * 200), (3, " ".join(words[::-1]))]
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == slow_kept(rows) == [1, 3]


def test_rows_without_an_id_or_text(docs, no_docs):
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sum(not (r.text or "").split() for r in rows) == 1
    assert len({(r.doc_id, r.text) for r in rows}) == len(rows)
    assert near_copies.keep_one(no_docs).collect() == []
