"""Conversation prefix trie: nodes, members and subtree totals by time-forward processing.

A node is a distinct sequence of first steps; the root has none. Steps are numbered along their
conversation by a range shuffle of (conversation, order): each task numbers and hashes its run, and
what a conversation that goes on over a border has so far is carried from task to task, as a count and
a running hash of one row per task. So no conversation is ever gathered, and any may hold most rows. The
prefix of a step is known by a polynomial hash of the steps' SHA-256 values modulo 2^61 - 1 to two bases
(122 bits), which unlike a chain of digests can be carried. A node is then a group of equal prefixes,
counted by an aggregate.

Totals go up the trie by time-forward processing. Nodes with more than ``HEAVY`` members, or one in
``HEAVY_SHARE`` of all steps if that is more, are the top: as every step has one node, fewer than
``HEAVY_SHARE`` nodes are. Below the top hang subtrees of few members; each lies whole in one shard, or
one shard per ``BAND`` levels where conversations are longer. In a shard Spark's external sort lays
nodes in reverse level order, and one pass sends each node's totals forward in time to its parent,
through a priority queue that spills sorted runs to the shared folder. What the shards' roots send to
the top is summed per parent, and a last pass of the same kind goes over the top, the roots' parents.

Defined results: steps of a conversation are ordered by ``order`` (NULL first), ties by the steps'
hashes; equal steps keep all their copies. A NULL conversation has no id and is none: its rows are not read. Conversations without
steps are members of the root only. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import staged
from quadrille.llm.token_files import at
from quadrille.session import use_checkpoint_dir

# Members from which on a node belongs to the top; the top has at most this many nodes.
HEAVY, HEAVY_SHARE = 64, 1_000_000
# Levels of a subtree that one shard takes.
BAND = 100_000
# Messages a queue holds in memory.
QUEUE = 200_000
# Decimal ids of one piece of an end list, and steps per task.
PIECE_IDS, TASK_STEPS = 2_000, 1_000_000
PRIME = (1 << 61) - 1
BASES = (0x1A2B3C4D5E6F701, 0x0F1E2D3C4B5A697)


def step_hashes(*parts: Column) -> list[Column]:
    """Two 60-bit hashes of a step: of the parts, each with its length before it, so that no two
    different steps read alike."""
    told = F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    digest = F.sha2(told, 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint").alias(n) for n, at in (("a", 1), ("b", 16))]


def run_in_order(steps: DataFrame, order: Sequence[str], tasks: int) -> DataFrame:
    """``steps`` (conv, a, b, ...) with ``d``, their place in the conversation from 1 on, and the hashes
    of the prefix that ends with them (``s``, ``t``) and of the one before (``ps``, ``pt``)."""
    keys = [F.col("conv"), *[F.col(c).asc_nulls_first() for c in order], F.col("a"), F.col("b")]
    laid = steps.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn("task", F.spark_partition_id())
    names = laid.columns
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema.fields)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, d, s, t = None, 0, 0, 0
        for batch in batches:
            made = []
            for c, a, b in zip(*(batch.column(n).to_pylist() for n in ("conv", "a", "b"))):
                if c != conv:
                    conv, d, s, t = c, 0, 0, 0
                before = (s, t)
                d, s, t = d + 1, (s * BASES[0] + a + 1) % PRIME, (t * BASES[1] + b + 1) % PRIME
                made.append((d, s, t, *before))
            columns = zip(*made) if made else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.int64()) for c in columns]], [*names, "d", "s", "t", "ps", "pt"]
            )

    added = "d bigint, s bigint, t bigint, ps bigint, pt bigint"
    numbered = staged(laid.mapInArrow(local, f"{own}, {added}"))
    # One row per task: its first and last conversation, and what the last one has so far.
    ends = numbered.groupBy("task").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "d", "s", "t")).alias("last")
    ).orderBy("task").collect()
    carried: dict[int, tuple[int, int, int, int]] = {}
    state = (None, 0, 0, 0)
    for row in ends:
        conv, d, s, t = row["last"]
        if row["first"] == state[0]:
            carried[row["task"]] = state
            if conv == row["first"]:
                d, s, t = _after(state[1:], d, s, t)
        state = (conv, d, s, t)
    if not carried:
        return numbered.drop("task")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("conv", "task", "d", "s", "t", "ps", "pt")}
            for i, (conv, task) in enumerate(zip(columns["conv"], columns["task"])):
                told = carried.get(task)
                if told and told[0] == conv:
                    d = columns["d"][i]
                    _, ps, pt = _after(told[1:], d - 1, columns["ps"][i], columns["pt"][i])
                    d, s, t = _after(told[1:], d, columns["s"][i], columns["t"][i])
                    for name, value in (("d", d), ("s", s), ("t", t), ("ps", ps), ("pt", pt)):
                        columns[name][i] = value
            fixed = [pa.array(columns[n], pa.int64()) if n in ("d", "s", "t", "ps", "pt") else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(fixed, batch.schema.names)

    return staged(numbered.mapInArrow(whole, f"{own}, {added}")).drop("task")


def _after(state: tuple[int, int, int], d: int, s: int, t: int) -> tuple[int, int, int]:
    """Place and hashes of a run of ``d`` steps that goes on after ``state``."""
    return (
        state[0] + d, (state[1] * pow(BASES[0], d, PRIME) + s) % PRIME, (state[2] * pow(BASES[1], d, PRIME) + t) % PRIME,
    )


class SpillingQueue:
    """A priority queue of tuples (key..., values...) that holds at most ``room`` of them in memory.

    The larger half of a full queue goes to the store as a sorted run; runs are read back a block
    at a time, and the least entry is that of the heap or of a run's block.
    """

    BLOCK = 4096

    def __init__(self, store: fs.FileSystem, folder: str, width: int, room: int = QUEUE):
        self.heap: list[tuple] = []
        self.store, self.folder, self.width, self.room = store, folder, width, max(2, room)
        self.runs: list[list] = []  # [path, rows, rows read, block, place in it]
        self.spilled = 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.room:
            self.heap.sort()
            half = len(self.heap) // 2
            self._spill(self.heap[half:])
            del self.heap[half:]

    def _spill(self, entries: list[tuple]) -> None:
        self.store.create_dir(self.folder, recursive=True)
        path = f"{self.folder}/run-{self.spilled}"
        with self.store.open_output_stream(path) as out:
            out.write(np.array(entries, dtype="<i8").tobytes())
        self.spilled += 1
        self.runs.append([path, len(entries), 0, [], 0])
        self._fill(self.runs[-1])

    def _fill(self, run: list) -> None:
        path, rows, done = run[:3]
        n = min(self.BLOCK, rows - done)
        if not n:
            self.store.delete_file(path)
            self.runs.remove(run)
            return
        with self.store.open_input_file(path) as source:
            raw = source.read_at(n * self.width * 8, done * self.width * 8)
        run[2:] = [done + n, list(map(tuple, np.frombuffer(raw, "<i8").reshape(n, self.width).tolist())), 0]

    def least(self) -> tuple | None:
        heads = [run[3][run[4]] for run in self.runs]
        if self.heap:
            heads.append(self.heap[0])
        return min(heads, default=None)

    def pop(self) -> tuple:
        entry = self.least()
        if self.heap and self.heap[0] == entry:
            return heapq.heappop(self.heap)
        run = next(r for r in self.runs if r[3][r[4]] == entry)
        run[4] += 1
        if run[4] == len(run[3]):
            self._fill(run)
        return entry

    def close(self) -> None:
        if self.spilled:
            self.runs = []
            self.store.delete_dir(self.folder)


# What a node sends to its parent, and what it has received from its children.
SUMS = ("children", "leaves", "saved")


def pass_up(laid: DataFrame, folder: str, room: int = QUEUE) -> DataFrame:
    """Totals of nodes laid out in reverse level order, shard by shard.

    ``laid`` has (d, s, t, ps, pt, own, children, leaves, saved, node) in the order of (d descending, s,
    t, node): nodes (node = 1) and, before the node they are for, sums that other shards sent (node =
    0). Each node's totals go to its parent through the queue; what is for a parent in another shard
    is passed by.
    """
    columns = ["d", "s", "t", "ps", "pt", "own", "children", "leaves", "saved", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, where = at(folder)
        queue = SpillingQueue(store, f"{where}/queue-{uuid.uuid4().hex}", 5, room)
        outside: tuple[int, int, int] = (0, 0, 0)
        for batch in batches:
            made = []
            for d, s, t, ps, pt, own, children, leaves, saved, node in zip(*(batch.column(c).to_pylist() for c in columns)):
                if not node:
                    outside = (outside[0] + children, outside[1] + leaves, outside[2] + saved)
                    continue
                children, leaves, saved = outside
                outside = (0, 0, 0)
                here = (-d, s, t)
                # Messages that came due for a parent that is not in this shard are passed by.
                while (due := queue.least()) is not None and due[:3] <= here:
                    entry = queue.pop()
                    if entry[:3] == here:
                        children, leaves, saved = children + 1, leaves + entry[3], saved + entry[4]
                leaves = leaves or 1
                saved += own
                made.append((d, s, t, children, leaves, saved))
                if d:
                    queue.push((1 - d, ps, pt, leaves, saved))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*made)], ["d", "s", "t", "n_children", "n_leaves", "saved"]
                )
        queue.close()

    return laid.select(*columns).mapInArrow(
        run, "d bigint, s bigint, t bigint, n_children bigint, n_leaves bigint, saved bigint"
    )


def _laid(nodes: DataFrame, sent: DataFrame, tasks: int, *shard: str) -> DataFrame:
    """Nodes and the sums sent to them, by shards, in reverse level order."""
    zero = F.lit(0).cast("bigint")
    rows = nodes.select(
        "d", "s", "t", "ps", "pt", "own", *[zero.alias(c) for c in SUMS], F.lit(1).alias("node"), *shard
    )
    both = rows.unionByName(sent.select(
        "d", "s", "t", zero.alias("ps"), zero.alias("pt"), zero.alias("own"), *SUMS, F.lit(0).alias("node"), *shard
    ))
    dealt = both.repartition(tasks, *shard) if shard else both.coalesce(1)
    return dealt.sortWithinPartitions(F.col("d").desc(), "s", "t", "node")


def _sent(totals: DataFrame, *also: str) -> DataFrame:
    """What nodes send to parents outside their shard, summed per parent."""
    return totals.groupBy((F.col("d") - 1).alias("d"), F.col("ps").alias("s"), F.col("pt").alias("t"), *also).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def end_digests(ends: DataFrame, tasks: int) -> DataFrame:
    """(d, s, t, digest): the SHA-256 of the ids of the conversations that end at a node, ascending and
    comma-joined.

    Ids are laid in order over all tasks, those of one node over several if they are many, and joined
    into pieces; the pieces of a node are then read in order by one task, which keeps only the
    state of the digest.
    """
    keys = ["d", "s", "t"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, ids):
            arrays = [pa.array([k], pa.int64()) for k in (*key, ids[0])]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([",".join(map(str, ids))])], [*keys, "least", "ids"])

        now, ids = None, []
        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*keys, "conv"))):
                if key != now or len(ids) == PIECE_IDS:
                    if ids:
                        yield out(now, ids)
                    now, ids = key, []
                ids.append(conv)
        if ids:
            yield out(now, ids)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            made = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if key != now:
                    if now:
                        made.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if made:
                yield _digest_rows(made)
        if now:
            yield _digest_rows([(*now, state.hexdigest())])

    def _digest_rows(made: list[tuple]) -> pa.RecordBatch:
        *key, digest = zip(*made)
        return pa.RecordBatch.from_arrays([*[pa.array(k, pa.int64()) for k in key], pa.array(digest)], [*keys, "digest"])

    laid = ends.repartitionByRange(tasks, *keys, "conv").sortWithinPartitions(*keys, "conv")
    joined = laid.mapInArrow(pieces, "d bigint, s bigint, t bigint, least bigint, ids string")
    in_order = joined.repartition(tasks, *keys).sortWithinPartitions(*keys, "least")
    return in_order.mapInArrow(digests, "d bigint, s bigint, t bigint, digest string")


def trie(
    steps: DataFrame, convs: DataFrame, order: Sequence[str], heavy: int = HEAVY, heavy_share: int = HEAVY_SHARE,
    band: int = BAND, room: int = QUEUE, task_steps: int = TASK_STEPS,
) -> DataFrame:
    """The nodes of the trie of conversations ``convs`` (conv), each with its ``steps`` (conv, a, b, weight
    and the columns of ``order``): (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved, ends_sha256). ``a`` and ``b`` identify a step (``step_hashes``); a node saves the weight of its
    last step for each member but one.
    """
    spark = steps.sparkSession
    use_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir()
    steps, convs = staged(steps), staged(convs.filter(F.col("conv").isNotNull()).distinct())
    n_steps, n_convs = steps.count(), convs.count()
    if not n_convs:
        return spark.createDataFrame([], RESULT)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_steps // task_steps))
    rows = run_in_order(steps, order, tasks)
    nodes = staged(rows.groupBy("d", "s", "t").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.min("weight").alias("weight"),
        F.min("ps").alias("ps"), F.min("pt").alias("pt"),
    ).withColumn("own", (F.col("n_convs") - 1) * F.col("weight")))
    most = max(heavy, n_steps // heavy_share)
    top = staged(nodes.filter(F.col("n_convs") > most))  # at most heavy_share rows: each has that share of all steps
    key = ["d", "s", "t"]
    light_rows = rows.select("conv", *key).join(F.broadcast(top.select(*key)), key, "left_anti")
    # The first node of a conversation below the top names the subtree that its nodes below are in.
    subtree = F.min_by(F.struct("s", "t"), "d")
    roots = light_rows.groupBy(F.col("conv").alias("conv_id")).agg(subtree.alias("sub"))
    light = nodes.join(F.broadcast(top.select(*key)), key, "left_anti").join(roots, "conv_id").withColumn(
        "band", F.floor(F.col("d") / band).cast("int")
    )
    light = staged(light.select(
        *key, "ps", "pt", "own", "n_convs", "conv_id", "band",
        F.col("sub.s").alias("sub_s"), F.col("sub.t").alias("sub_t"),
        ((F.col("sub.s") == F.col("s")) & (F.col("sub.t") == F.col("t"))).alias("is_root"),
    ))
    shard = ["sub_s", "sub_t"]
    deepest = light.agg(F.max("band")).first()[0]
    empty = spark.createDataFrame([], "d bigint, s bigint, t bigint, children bigint, leaves bigint, saved bigint")
    sent, done = empty.select("*", F.lit(0).cast("bigint").alias("sub_s"), F.lit(0).cast("bigint").alias("sub_t")), []
    for level in range(deepest if deepest is not None else -1, -1, -1):
        within = light.filter(F.col("band") == level)
        totals = pass_up(_laid(within, sent, tasks, *shard), folder, room)
        done.append(staged(within.join(totals, key)))
        # The first levels of a band send to the band above, in the same subtree.
        sent = staged(_sent(done[-1].filter((F.col("d") == level * band) & ~F.col("is_root")), *shard))
    below = done[0] if done else None
    for part in done[1:]:
        below = below.unionByName(part)
    up = _sent(below.filter("is_root")) if done else empty
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).select(
        *[F.lit(0).cast("bigint").alias(c) for c in (*key, "ps", "pt", "own")], "n_convs", "conv_id"
    )
    crown = top.select(*key, "ps", "pt", "own", "n_convs", "conv_id").unionByName(root)
    # The top has a bounded number of nodes, and one task takes it.
    settled = staged(crown.join(pass_up(_laid(crown, up, 1), folder, room), key))
    both = below.select(*settled.columns).unionByName(settled) if done else settled
    ends = rows.groupBy("conv").agg(F.max_by(F.struct("s", "t"), "d").alias("e"), F.max("d").alias("d"))
    at_root = convs.join(rows.select("conv").distinct(), "conv", "left_anti")
    last = ends.select("conv", "d", "e.s", "e.t").unionByName(
        at_root.select("conv", *[F.lit(0).cast("bigint").alias(c) for c in key])
    )
    digests = end_digests(last, tasks)
    parents_of = lambda df: df.select(
        (F.col("d") + 1).alias("d"), F.col("s").alias("ps"), F.col("t").alias("pt"), F.col("conv_id").alias("parent_conv_id")
    )
    # Parents in the top are broadcast; any other has no more children than a top node has members.
    hung = both.join(F.broadcast(parents_of(settled)), ["d", "ps", "pt"], "left").withColumnRenamed("parent_conv_id", "above")
    if done:
        other = parents_of(below)
        near = hung.filter(F.col("above").isNull() & (F.col("d") > 0)).join(other, ["d", "ps", "pt"])
        far = hung.filter(F.col("above").isNotNull() | (F.col("d") == 0)).withColumn("parent_conv_id", F.col("above"))
        hung = near.unionByName(far)
    else:
        hung = hung.withColumn("parent_conv_id", F.col("above"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return hung.join(digests, key, "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved", F.coalesce("digest", none).alias("ends_sha256"),
    )


RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved bigint, ends_sha256 string"
)


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, a, b, weight) of every turn: NULL role or text is empty, the weight is the text's UTF-8 bytes."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    return conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), *step_hashes(*said),
        F.octet_length(said[1]).cast("bigint").alias("weight"),
    )


def rebuilt(said: DataFrame, tasks: int, group: int = 5, heads: int = 9) -> DataFrame:
    """(conv, part, turn, a, b, weight): every conversation c rebuilt as the first h turns of c - c % group,
    then its own turns after the first h; h = crc32(c in decimal) % heads."""
    numbered = run_in_order(said, ["turn"], tasks).select("conv", F.col("d").alias("turn"), "a", "b", "weight")
    first = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads))
    base = F.col("conv") - F.col("conv") % group
    own = numbered.filter(F.col("turn") > first).select("conv", F.lit(1).alias("part"), "turn", "a", "b", "weight")
    # At most ``group`` conversations copy a base, and at most ``heads`` - 1 turns of it each.
    copying = said.select("conv").distinct().select("conv", base.alias("base"), first.alias("h"))
    heads_of = numbered.filter((F.col("turn") < heads) & (F.col("conv") == base)).withColumnRenamed("conv", "base")
    copied = heads_of.join(copying, "base").filter(F.col("turn") <= F.col("h"))
    return own.unionByName(copied.select("conv", F.lit(0).alias("part"), "turn", "a", "b", "weight"))
