import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow.fs
import pytest
from conftest import SF_DIR

from quadrille.llm import prefix_trie
from quadrille.llm.common import staged

SCHEMA = "conv_id long, turn long, role string, text string"


def paths_of(rows):
    """Every conversation rebuilt, turn by turn."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted(
        (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)
    ):
        own[conv].append((role or "", text or ""))
    found = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        found[conv] = tuple(own.get(conv - conv % 5, [])[:h] + own[conv][h:])
    return found


def slow(paths):
    """The trie's rows by looking at every prefix of every conversation."""
    members = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, convs in members.items():
        own = (len(convs) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not children[prefix]
            saved[prefix[:d]] += own
    rows = []
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(prefix))
        rows.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), children[prefix],
                     leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                        "saved", "ends_sha256")) for r in df.collect()), key=repr)


def built(df, tasks=4, **how):
    said = staged(prefix_trie.turns(df))
    return prefix_trie.trie(prefix_trie.rebuilt(said, tasks), said.select("conv"), ["part", "turn"], **how)


def test_query(run, spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(*"conv_id turn role text".split()).collect()]
    found = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
             for r in run("op12_prefix_trie")]
    assert sorted(found, key=repr) == slow(paths_of(rows))


def awkward():
    rng = random.Random(4)
    rows = []
    for conv in range(120):
        if conv % 11 == 3:
            continue
        for turn in range(rng.choice([1, 2, 3, 9, 14])):
            text = rng.choice(["hi", "hi", "ß", "", None, f"own {conv}"])
            rows.append((conv, turn if turn else None, rng.choice(["user", None]), text))
    for conv in range(200, 300):  # one conversation, many times
        rows += [(conv, t, "user", f"same {t}") for t in range(12)]
    rows += [(400, t, "user", "long") for t in range(30)]
    return rows + [(None, 1, "user", "no conversation"), (500, 3, "a", "x"), (501, 3, "a", "x")]


@pytest.mark.parametrize("how", [{}, {"heavy": 1}, {"heavy": 3, "band": 10}, {"heavy": 10**6, "room": 3}])
def test_awkward_conversations(spark, how):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS s", "'x' AS a").repartition(5)
    assert result(built(df, **how)) == slow(paths_of(rows))


def test_one_conversation_over_many_tasks(spark):
    rows = [(7, t, "user", f"turn {t % 10}") for t in range(240)] + [(c, t, "user", "x") for c in (6, 8) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    said = staged(prefix_trie.turns(df))
    numbered = prefix_trie.run_in_order(said, ["turn"], 12).filter("conv = 7").collect()
    assert sorted((r.turn, r.d) for r in numbered) == [(t, t + 1) for t in range(240)]
    ends = {r.d: (r.s, r.t) for r in numbered}
    assert all((r.ps, r.pt) == ends.get(r.d - 1, (0, 0)) for r in numbered) and len(set(ends.values())) == 240
    assert result(built(df, 12, band=100)) == slow(paths_of(rows))


def test_ends_are_joined_in_numeric_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = [(1, 2, 3, c) for c in range(5000)] + [(0, 0, 0, 5), (2, 2, 2, 10), (2, 2, 2, 9)]
    df = spark.createDataFrame(rows, "d long, s long, t long, conv long").repartition(4)
    found = {(r.d, r.s, r.t): r.digest for r in prefix_trie.end_digests(df, 6).collect()}
    ids = {(1, 2, 3): range(5000), (0, 0, 0): [5], (2, 2, 2): [9, 10]}
    assert found == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in ids.items()}


def test_spilling_queue(tmp_path):
    rng = random.Random(6)
    queue = prefix_trie.SpillingQueue(pyarrow.fs.LocalFileSystem(), str(tmp_path / "q"), 2, 10)
    queue.BLOCK = 3
    want, got = [], []
    for i in range(3000):
        if rng.random() < 0.6 or not want:
            entry = (rng.randrange(500), i % 7)
            queue.push(entry)
            want.append(entry)
        else:
            want.sort()
            got.append(queue.pop() == want.pop(0))
    assert all(got) and queue.spilled > 5
    assert [queue.pop() for _ in range(len(want))] == sorted(want) and queue.least() is None
    queue.close()
    assert not (tmp_path / "q").exists()


def test_no_conversations(spark):
    assert built(spark.createDataFrame([], SCHEMA)).collect() == []
    assert built(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
