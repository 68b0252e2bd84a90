import zlib

import numpy as np
import pytest
from conftest import PROSE

from quadrille.llm import language_id as L


def slow_phrases(word, text):
    """Greedy longest pieces of the word that stand anywhere in ``text``."""
    token, count, at = f"_{word}_", 0, 0
    while at < len(token):
        n = 1
        while at + n < len(token) and n < L.PIECE_CHARS and token[at : at + n + 1] in text:
            n += 1
        at += n
        count += 1
    return count


WORDS = ["the", "then", "hen", "other", "banana", "ana"]


def test_phrases_are_longest_matches():
    automaton = L.Automaton.of(WORDS)
    text = "_" + "_".join(WORDS) + "_"
    asked = ["the", "nana", "zzz", "bathe", "hens", "x", "anathen", "täh", "otherother"]
    model = L.Model(["xx"], [automaton])
    got = model.costs(asked)[:, 0] / np.log2(len(text))
    assert got.round(9).tolist() == [slow_phrases(w, text) for w in asked]


def test_automaton_accepts_exactly_the_substrings():
    text = "abcbcabba"
    go = L.suffix_automaton(text)

    def reads(piece):
        state = 0
        for c in piece:
            if c not in go[state]:
                return False
            state = go[state][c]
        return True

    for a in range(len(text)):
        for b in range(a + 1, len(text) + 1):
            assert reads(text[a:b])
    assert not any(map(reads, ["aa", "cc", "bbb", "abcbb", "ac"]))


@pytest.fixture(scope="module")
def model(corpus):
    return L.fit(corpus.filter(L.remainder() != 0))


def test_held_out_accuracy(run, corpus):
    langs = {r.doc_id: r.lang for r in corpus.collect()}
    rows = run("op9_language_id")
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in langs}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_documents(docs, model):
    rows = L.identify(docs.drop("lang"), model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == L.UNDETERMINED) == (not lettered)
        assert 0 <= r.score <= 1
    assert len({(r.lang_pred, r.score) for r in rows if r.text == PROSE}) == 1


def test_brute_force_choice(docs, model, corpus):
    texts = ["_".join([""] + w + [""]) for w in spelled(model)]
    rows = L.identify(corpus.limit(40), model).collect()
    for r in rows:
        costs = [sum(slow_phrases(w, t) for w in L.words_of(r.text) if len(w) < 60) * a.bits
                 for t, a in zip(texts, model.automata)]
        if max(map(len, L.words_of(r.text))) < 60:
            assert r.lang_pred == model.languages[int(np.argmin(costs))]


def spelled(model):
    """The words of each automaton, read back along its longest path."""
    out = []
    for a in model.automata:
        size = len(a.letters)
        longest = [0] * (int(a.targets.max()) + 1)
        steps = {}
        for key, target in zip(a.keys.tolist(), a.targets.tolist()):
            steps.setdefault(key // size, []).append((key % size, target))
        # States of the whole text are those on the path that is as long as the text.
        import sys
        sys.setrecursionlimit(10_000)
        n = round(2 ** a.bits)
        order, seen = [], set()
        stack = [(0, iter(steps.get(0, [])))]
        seen.add(0)
        while stack:
            state, it = stack[-1]
            for _, target in it:
                if target not in seen:
                    seen.add(target)
                    stack.append((target, iter(steps.get(target, []))))
                    break
            else:
                order.append(state)
                stack.pop()
        for state in order:
            longest[state] = max((1 + longest[t] for _, t in steps.get(state, [])), default=0)
        state, text = 0, ""
        while steps.get(state):
            letter, target = max(steps[state], key=lambda s: longest[s[1]])
            text += a.letters[letter]
            state = target
        assert len(text) == n
        out.append(text.strip("_").split("_"))
    return out


def test_nothing_learned(docs, no_docs, model):
    empty = L.fit(no_docs)
    assert {r.lang_pred for r in L.identify(docs, empty).collect()} == {"und"}
    assert L.identify(no_docs, model).collect() == []


def test_one_language(docs, spark):
    only = L.fit(spark.createDataFrame([("xx", "some words here"), (None, "b"), ("yy", None)], "lang string, text string"))
    assert only.languages == ["xx"]
    assert {r.lang_pred for r in L.identify(docs, only).collect()} == {"xx", "und"}


def test_clashing_names_and_bounds(docs, corpus):
    odd = docs.withColumnsRenamed({"source": "score", "lang": "lang_pred"})
    small = L.fit(corpus, sample_texts=3, automaton_chars=500)
    assert all(2 ** a.bits <= 502 for a in small.automata)
    assert L.identify(odd, small).columns == ["doc_id", "text", "n_chars", "lang_pred", "score"]


def test_a_long_run_of_letters(spark, model):
    df = spark.createDataFrame([(1, "the" * 50_000)], "doc_id bigint, text string")
    assert L.identify(df, model).first().lang_pred == "en"


def test_copies_do_not_starve_a_language(spark):
    rows = [("aa", "one and the same text")] * 3000 + [("aa", f"alpha{i}") for i in range(5)]
    rows += [("bb", f"beta{'x' * i}") for i in range(5)]
    model = L.fit(spark.createDataFrame(rows, "lang string, text string"), sample_texts=20)
    assert model.languages == ["aa", "bb"]
    # All distinct texts are within the sample, so every word of both is known.
    assert all(a.keys.size for a in model.automata)
    found = L.identify(spark.createDataFrame([("alpha",), ("one text",), ("betaxx",)], "text string"), model).collect()
    assert [r.lang_pred for r in found] == ["aa", "aa", "bb"]
