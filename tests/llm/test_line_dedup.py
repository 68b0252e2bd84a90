import random

from conftest import pairs

from quadrille.llm import line_dedup


def distance_at_most_one(a, b):
    """Whether the Levenshtein distance of two word lists is 0 or 1, by the full table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1] <= 1


def slow(rows, key_of, min_words=5):
    """(doc_id, text) -> line numbers to remove, by comparing every line with all before it."""
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, key_of[r]))
    earlier, out = [], {}
    for row in distinct:
        out[row] = set()
        for k, line in enumerate((row[1] or "").split("\n")):
            words = line.lower().split()
            if not words:
                continue
            near = len(words) >= min_words
            for old in earlier:
                if old == words or (near and len(old) >= min_words and abs(len(old) - len(words)) < 2
                                    and distance_at_most_one(old, words)):
                    out[row].add(k)
                    break
            earlier.append(words)
    return out


def check(df, **how):
    """Holds the operator, with the given settings, against the comparison of all lines."""
    key_of = {(r.doc_id, r.text): r.k for r in df.select("doc_id", "text", line_dedup.text_key().alias("k")).collect()}
    rows = pairs(df)
    want = slow(rows, key_of)
    expected = []
    for doc, text in rows:
        gone = want[doc, text]
        lines = (text or "").split("\n")
        left = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        expected.append((doc, None if text is None else left, 0 if text is None else len(lines), len(gone)))
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df, **how).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_awkward_documents(docs):
    check(docs)


def test_corpus(corpus):
    check(corpus)


def test_edits_of_lines(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("ab ba ca da".split())
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = [word() for _ in range(rng.randint(1, 9))]
            lines.append(" ".join(words))
        rows.append((i if i % 9 else None, "\n".join(lines)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_a_full_filter_changes_nothing(docs):
    check(docs, filter_bits=line_dedup.BUCKET_BITS)


def test_a_template_line_of_a_third_of_the_rows(spark):
    rows = [(i, f"page {i} of the long report on lines" if i % 3 == 0 else f"text{i} has{i} words{i} of{i} its{i} own{i}")
            for i in range(300)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found if r.n_removed} == {i for i in range(3, 300, 3)}


def test_empty(no_docs):
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_clashing_names(docs):
    odd = docs.withColumnsRenamed({"source": "line_no", "lang": "h1", "n_chars": "__gone"}).selectExpr("*", "1 AS n_lines")
    out = line_dedup.dedup_lines(odd)
    assert out.columns == ["doc_id", "text", "h1", "line_no", "__gone", "n_lines", "n_removed"]
    assert out.count() == docs.count()


def test_query(run, corpus):
    assert len(run("op1_line_dedup")) == corpus.count()
