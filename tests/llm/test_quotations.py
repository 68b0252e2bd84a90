import random

import pytest
from pyspark.sql import types as T

from quadrille.llm import quotations as Q

SCHEMA = "conv_id long, turn int, role string, text string"


def linked(spark, rows):
    return {(r.conv_id, r.turn): r for r in Q.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_parse_levels():
    text = "Hi\n\nOn Monday X wrote:\n> a  B\n>> deep one\n>> two\n> c\n>\n> d\n\nMy answer\nhere"
    clean, own, quoted = Q.parse(text)
    assert clean == "Hi\n\nMy answer\nhere"
    assert own == ["hi", "my answer here"]
    assert quoted == [(1, "a b"), (2, "deep one two"), (1, "c"), (1, "d")]
    assert Q.parse("plain > text\nwrote:") == ("plain > text\nwrote:", ["plain > text wrote:"], [])


def test_replies_threads_and_depth(spark):
    rows = [
        (1, 0, "user", "How do I sort?\n\nAnd how fast is it?"),
        (1, 1, "a", "> how do i  SORT?\nUse order by."),
        (1, 2, "b", "A new question"),
        (1, 3, "a", "> > How do I sort?\n> Use order by.\nThanks"),
        (1, 4, "b", "> A new question\nAnswer"),
        (1, 5, "b", "> nobody said this\nx"),
        (1, 6, "b", ">> And how fast is it?\nvery"),
        (2, 1, "b", "> A new question\nother conversation"),
    ]
    got = linked(spark, rows)
    assert {k: (r.n_quotes, r.n_linked, r.reply_to, r.thread, r.depth) for k, r in got.items()} == {
        (1, 0): (0, 0, None, 0, 0), (1, 1): (1, 1, 0, 0, 1), (1, 2): (0, 0, None, 2, 0), (1, 3): (2, 2, 1, 0, 2),
        (1, 4): (1, 1, 2, 2, 1), (1, 5): (1, 0, None, 5, 0), (1, 6): (1, 1, 0, 0, 1), (2, 1): (1, 0, None, 1, 0),
    }
    assert got[1, 3].text == "Thanks"


def slow(rows):
    """(conv, turn) -> (n_linked, reply_to, thread, depth), message by message."""
    said, out = {}, {}
    for conv, turn, _, text in rows:
        for p in Q.parse(text)[1]:
            said[conv, p] = min(turn, said.get((conv, p), turn))
    for conv, turn, _, text in sorted(rows):
        quotes = {(d, p) for d, p in Q.parse(text)[2] if said.get((conv, p), turn) < turn}
        reply = max(((-d, said[conv, p]) for d, p in quotes), default=(0, None))[1]
        thread, depth = (out[conv, reply][2], out[conv, reply][3] + 1) if quotes else (turn, 0)
        out[conv, turn] = (len(quotes), reply, thread, depth)
    return out


def test_random_conversations(spark):
    rng = random.Random(4)
    phrases = [f"sentence number {i}" for i in range(8)]
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 25)):
            quotes = [">" * rng.randint(1, 3) + " " + rng.choice(phrases).upper() for _ in range(rng.randint(0, 2))]
            rows.append((conv, turn, "user", "\n".join([*quotes, rng.choice(phrases), "", f"own {conv} {turn}"])))
    got = linked(spark, rows)
    assert {k: (r.n_linked, r.reply_to, r.thread, r.depth) for k, r in got.items()} == slow(rows)


def test_a_long_chain_in_one_conversation(spark):
    rows = [(1, t, "u", f"> words {t - 1}\nwords {t}") for t in range(200)]
    got = linked(spark, rows)
    assert all((r.thread, r.depth) == (0, r.turn) for r in got.values())


def test_order(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (1, 2, "u", "> a\nc"), (1, 3, "u", "> b\nd"), (0, 5, "u", "e")]
    found = Q.in_reply_order(Q.link_quotations(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(r.conv_id, r.turn) for r in found] == [(0, 5), (1, 0), (1, 2), (1, 1), (1, 3)]


def test_awkward_rows(spark):
    rows = [(1, 0, None, None), (None, 1, "u", "> x\ny"), (1, None, "u", "> z\nx"), (1, 1, "u", ""),
            (1, 2, "u", ">"), (1, 3, "u", "> \n>>\n> x"), (1, 4, "u", "x\n" * 20_000), (1, 5, "u", "> x\n" * 20_000),
            (1, 6, "u", "x"), (1, 7, "u", "> x"), (1, 7, "u", "> x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS hash", "2 AS original", "3 AS thread", "4 AS __own")
    found = Q.link_quotations(df).collect()
    assert len(found) == len(rows)
    assert [(r.reply_to, r.thread) for r in found if r.turn == 7] == [(6, 6)] * 2
    # What nobody said before stays, as do marks without words; what links goes.
    assert {r.turn: r.text for r in found if r.turn in (2, 3)} == {2: ">", 3: "> \n>>\n> x"}
    assert [r.text for r in found if r.turn == 7] == ["", ""]
    assert [r.text for r in found if r.turn == 5] == [""]


def test_only_linked_quotes_leave_the_text(spark):
    rows = [
        (1, 0, "u", "How do I sort?\n\nIt is slow."),
        (1, 1, "a", "Type\n>>> x = 1\n>>> print(x)\nand see."),
        (1, 2, "u", "The manual said this:\n> nobody wrote these words\n> It is slow.\nTrue?"),
        (1, 3, "a", "Ann wrote:\n\n> How do I sort?\n>\n> a stranger's words\n\nUse a key."),
        (1, 4, "u", "Bob wrote:\n> How do I sort?\n>> It is slow.\n>\n\nSo said he:\nthanks"),
        (2, 0, "u", "> How do I sort?\nanother conversation"),
    ]
    got = linked(spark, rows)
    assert [got[1, t].text for t in range(3)] == [r[3] for r in rows[:3]]
    assert got[1, 3].text == "> a stranger's words\n\nUse a key."
    assert got[1, 4].text == "So said he:\nthanks"
    assert got[2, 0].text == rows[5][3]
    assert [(got[1, t].n_quotes, got[1, t].n_linked) for t in range(5)] == [(0, 0), (1, 0), (1, 0), (2, 1), (2, 2)]


def test_rows_of_one_turn_keep_their_own_unlinked_quotes(spark):
    rows = [(1, 0, "u", "first words"), (1, 1, "u", "> first words\na"), (1, 1, "u", "> first things\nb")]
    found = Q.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in found) == ["> first things\nb", "a", "first words"]
    assert [r.reply_to for r in found if r.turn == 1] == [0, 0]


def test_empty(spark):
    none = spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
    assert Q.link_quotations(none).collect() == []


def test_query(spark, run):
    rows = run("op3_quotation_linking")
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").count()
    assert all(r.thread <= r.turn for r in rows)


@pytest.mark.parametrize("text", ["x" * 10, "\n\n", ">" * 500 + " deep", "a\n> b\nc\n> d"])
def test_clean_text_has_no_quotes(text):
    clean, _, quoted = Q.parse(text)
    assert Q.parse(clean)[2] == []
    assert bool(quoted) == (">" in text)


def simple(rows):
    """(conv, turn) -> reply_to, told with plain string work: every run of own lines of every earlier message."""
    said, out = [], {}
    for conv, turn, _, text in sorted(rows):
        level, quotes, block, blocks = 0, [], [], []
        for line in [*text.lower().split("\n"), ""]:
            bare = line.lstrip("> ")
            depth = line[: len(line) - len(bare)].count(">")
            if depth:
                if depth != level:
                    quotes.append((depth, []))
                quotes[-1][1].extend(bare.split())
            if depth or not line.strip():
                blocks.append(block)
                block = []
            else:
                block.append(line.split())
            level = depth
        found = []
        for depth, words in quotes:
            earlier = [(words not in whole, t) for c, t, whole, runs in said if c == conv and t < turn and words in runs]
            first = min(earlier, default=(True, None))[1]
            if first is not None:
                found.append((-depth, first))
        out[conv, turn] = max(found, default=(0, None))[1]
        runs = [sum(b[i:j], []) for b in blocks for i in range(len(b)) for j in range(i + 1, len(b) + 1)]
        said.append((conv, turn, [sum(b, []) for b in blocks], runs))
    return out


def test_parts_of_paragraphs_and_interleaved_replies(spark):
    rows = [
        (1, 0, "u", "line one\nline two\nline three"),
        (1, 1, "a", "> line one\nanswer one\n> line two\nanswer two"),
        (1, 2, "b", "> line two\n> line three\nboth"),
        (1, 3, "b", ">> line two\n> answer two\nyes"),
        (1, 4, "b", "> line one\n> line three\nnot side by side"),
        (1, 5, "b", "> one\npart of a line"),
        (1, 6, "b", "> answer one\n> answer two\ncut by a quote"),
    ]
    got = linked(spark, rows)
    assert [got[1, t].reply_to for t in range(7)] == [None, 0, 0, 1, None, None, None]
    assert {k: r.reply_to for k, r in got.items()} == simple(rows)
    assert got[1, 1].n_linked == 2 and got[1, 1].text == "answer one\nanswer two"


def test_random_interleaved_replies(spark):
    rng = random.Random(9)
    rows, said = [], {}
    for conv in range(15):
        for turn in range(rng.randint(2, 12)):
            lines = []
            for _ in range(rng.randint(1, 4)):
                earlier = said.get((conv, rng.randrange(turn)) if turn else None)
                if earlier and rng.random() < 0.7:
                    start = rng.randrange(len(earlier))
                    depth = rng.randint(1, 3)
                    lines += [">" * depth + " " + e for e in earlier[start : start + rng.randint(1, 3)]]
                mine = [f"t{rng.randrange(40)} w{rng.randrange(4)}" for _ in range(rng.randint(1, 4))]
                lines += mine
                said[conv, turn] = mine
            rows.append((conv, turn, "u", "\n".join(lines)))
    got = {k: r.reply_to for k, r in linked(spark, rows).items()}
    assert got == simple(rows)
    assert sum(v is not None for v in got.values()) > 20


def test_replies_derived_from_the_tables(run, spark):
    rows = run("op3_quotation_replies")
    plain = run("op3_quotation_linking")
    assert len(rows) == len(plain)
    assert sum(r.n_linked > 0 for r in rows) > len(rows) / 3
    assert sum(r.depth > 1 for r in rows) > 0
