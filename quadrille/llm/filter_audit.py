"""Filter interaction audit: what each filter removes in every order of filters.

One pass over a text's UTF-8 bytes profiles it. A finite-state transducer, given as two tables,
reads the bytes: a byte's class gives the next state (between words, in a word), the state before
and the class give the actions (a word starts, a code point, a capital, a symbol). As the next state
depends on the class alone, all bytes of many texts go through the tables at once. The spans of the
words are inserted into an open hash table, keyed by text; a span that meets an occupied slot counts
as the same word only if its bytes are equal, else it probes on.

Texts meet by their SHA-256 to tell copies. Per part and set of failed filters only counts are left
(32 sets for five filters), from which every order is settled; nothing grows with the rows after that.

Defined results: a NULL text is empty (no words, so the share of distinct words does not fail it).
A NULL part is the empty string. A copy is a row whose text some row with a smaller key has; rows of
one key are not copies of each other, rows without a key neither are copies nor make any. Several
labels of a key count as one, that is 1 if any is. An empty table has no parts. Other columns are not
read. A text of more than ``BLOCK`` bytes is read in blocks that end between words; only its
distinct words are kept from block to block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.common import staged
from quadrille.operators.skew import skew_join

# Bytes of text that go through the tables at a time.
BLOCK = 2 << 20
# The bytes between words, and the symbols.
BETWEEN_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"

# Classes of bytes, states and actions of the transducer.
SPACE, CONTINUATION, CAPITAL, SYMBOL, OTHER = range(5)
BETWEEN, WITHIN = range(2)
STARTS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8

PROFILE = "n_words bigint, n_distinct bigint, n_capitals bigint, n_points bigint, has_symbol boolean, digest binary"


def class_table() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[list(BETWEEN_BYTES)] = SPACE
    table[0x80:0xC0] = CONTINUATION
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    return table


def action_table() -> np.ndarray:
    """Actions by (state before, class); a continuation byte ends no code point and starts none."""
    table = np.zeros((2, 5), np.uint8)
    for cls in range(5):
        for state in (BETWEEN, WITHIN):
            starts = STARTS if state == BETWEEN and cls != SPACE else 0
            point = 0 if cls == CONTINUATION else POINT
            table[state, cls] = starts | point | (IS_CAPITAL * (cls == CAPITAL)) | (IS_SYMBOL * (cls == SYMBOL))
    return table


CLASS = class_table()
NEXT = np.array([BETWEEN, WITHIN, WITHIN, WITHIN, WITHIN], np.uint8)
ACTIONS = action_table().ravel()


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as ``data`` cut at ``offsets`` through the tables: the actions of every byte, and the
    start, end and text of every word."""
    cls = CLASS[data]
    state = NEXT[cls]
    before = np.empty_like(state)
    before[1:] = state[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = BETWEEN
    actions = ACTIONS[before * 5 + cls]
    starts = np.flatnonzero(actions & STARTS)
    after = np.empty_like(state)
    after[:-1] = state[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = BETWEEN
    ends = np.flatnonzero((state == WITHIN) & (after == BETWEEN)) + 1
    return actions, starts, ends, np.searchsorted(offsets, starts, "right") - 1


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        for k, factor in enumerate((FACTOR, INVERSE)):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A hash of every span's bytes and owner, from one running sum over all bytes."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts]
    found ^= owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` and from ``b`` on are the same over ``lengths`` (at least 1)."""
    if not len(a):
        return np.zeros(0, bool)
    first = np.cumsum(lengths) - lengths
    step = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    same = data[np.repeat(a, lengths) + step] == data[np.repeat(b, lengths) + step]
    return np.logical_and.reduceat(same, first)


def first_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Insert all spans into an open hash table; True for the span that stands for its word.

    In each round every span that is not settled looks at its next slot. Free slots are taken, a
    slot with the same word settles the span, any other is passed. Equal hashes are no proof: the
    bytes are compared.
    """
    n, lengths = len(starts), ends - starts
    stands = np.zeros(n, bool)
    if not n:
        return stands
    mask = (1 << max(4, int(2 * n - 1).bit_length())) - 1
    slots = np.full(mask + 1, -1, np.int64)
    left, at = np.arange(n), (hashes & np.uint64(mask)).astype(np.int64)
    while len(left):
        slot = at[left]
        free = slots[slot] < 0
        slots[slot[free]] = left[free]
        holder = slots[slot]
        own = holder == left
        stands[left[own]] = True
        may = ~own & (hashes[holder] == hashes[left]) & (owner[holder] == owner[left]) & (lengths[holder] == lengths[left])
        same = np.flatnonzero(may)
        equal = equal_spans(data, starts[left[same]], starts[holder[same]], lengths[left[same]])
        done = own
        done[same[equal]] = True
        left = left[~done]
        at[left] = (at[left] + 1) & mask
    return stands


def profiles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: (words, distinct words, capitals, code points, symbols) as rows of an array; and the
    spans that stand for the distinct words with their texts."""
    n = len(offsets) - 1
    actions, starts, ends, owner = transduce(data, offsets)
    stands = first_spans(data, starts, ends, owner, span_hashes(data, starts, ends, owner))
    counts = np.zeros((5, n), np.int64)
    counts[0] = np.bincount(owner, minlength=n)
    counts[1] = np.bincount(owner[stands], minlength=n)
    for row, action in ((2, IS_CAPITAL), (3, POINT), (4, IS_SYMBOL)):
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum((actions & action) > 0, dtype=np.int64)])
        counts[row] = sums[offsets[1:]] - sums[offsets[:-1]]
    return counts, starts[stands], ends[stands], owner[stands]


def profile_long(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The counts of one text, read in blocks that end between words."""
    total, known, start = np.zeros(5, np.int64), b"", 0
    while start < len(data):
        stop = min(start + block, len(data))
        while stop < len(data) and CLASS[data[stop - 1]] != SPACE:
            more = np.flatnonzero(CLASS[data[stop : stop + block]] == SPACE)
            stop = stop + int(more[0]) + 1 if len(more) else min(stop + block, len(data))
        part = data[start:stop]
        counts, starts, ends, _ = profiles(part, np.array([0, len(part)]))
        raw = part.tobytes()
        words = np.frombuffer(known + b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]), np.uint8)
        both, starts, ends, _ = profiles(words, np.array([0, len(words)]))
        raw = words.tobytes()
        known = b"".join([raw[a:b] + b" " for a, b in zip(starts.tolist(), ends.tolist())])
        total += counts[:, 0]
        total[1] = both[1, 0]
        start = stop
    return total


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each text begins, NULL as empty."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def profiled(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` without ``text``, with the counts of its text and its digest."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text).slice(low)), 0).to_numpy())
                high = low + max(1, int(np.searchsorted(sizes, block, "right")))
                part = batch.slice(low, high - low)
                data, offsets = text_bytes(part.column(text))
                long = part.num_rows == 1 and len(data) > block
                counts = profile_long(data, block)[:, None] if long else profiles(data, offsets)[0]
                view = memoryview(data.tobytes())
                digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], *[pa.array(c) for c in counts[:4]],
                     pa.array(counts[4] > 0), pa.array(digests, pa.binary())],
                    [*kept, "n_words", "n_distinct", "n_capitals", "n_points", "has_symbol", "digest"],
                )
                low = high

    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != text)
    return docs.mapInArrow(run, own + PROFILE)


def own_failures() -> list[Column]:
    """Failure of the filters that look at one text: few words, repeated words, capitals, symbols."""
    return [
        F.col("n_words") < 100,
        100 * F.col("n_distinct") < 80 * F.col("n_words"),
        100 * F.col("n_capitals") > 10 * F.col("n_points"),
        F.col("has_symbol"),
    ]


def failures(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
    quality: str = "quality", toxic: str = "toxic", block: int = BLOCK,
) -> DataFrame:
    """(part, failed, good, toxic, n): rows per part, set of failed filters (bit k for filter k) and labels."""
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    bits = [F.when(test, F.lit(1 << k)).otherwise(F.lit(0)) for k, test in enumerate(own_failures())]
    own = sum(bits[1:], bits[0])
    read = staged(profiled(rows, block=block).select("doc_id", "part", "digest", own.alias("own")))
    marked = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(
        F.max(F.col(quality) == 1).alias("good"), F.max(F.col(toxic) == 1).alias("toxic")
    )
    joined = skew_join(read, marked, ["doc_id"], "left", unique_right=True, salt_by=["digest"])
    said = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    alike = ["digest", "part", "own", "good", "toxic"]
    by_key = joined.select("doc_id", "digest", "part", "own", *said).groupBy("doc_id", *alike).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Copies are as many rows as they have parts and labels from here on.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    no_key = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")))
    alike_rows = by_key.groupBy(*alike).agg(F.sum("n").alias("n"), no_key.alias("no_key"), first.alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    at_first = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    originals = F.coalesce("no_key", F.lit(0)) + F.coalesce(at_first, F.lit(0))
    told = alike_rows.withColumn("least", least).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("own").alias("failed"), originals.alias("n")),
            F.struct(F.col("own").bitwiseOR(F.lit(16)).alias("failed"), (F.col("n") - originals).alias("n")),
        )).alias("s"),
    )
    return told.filter("s.n > 0").groupBy("part", "s.failed", "good", "toxic").agg(F.sum("s.n").alias("n"))


def audit(found: DataFrame, names: Sequence[str] = "ABCDE") -> DataFrame:
    """Every order of the filters ``names``, step by step, from the counts of ``failures``.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    """
    sets = 1 << len(names)
    zero = F.lit(0).cast("bigint")

    def per_set(alias: str, *tests: Column) -> Column:
        cells = []
        for s in range(sets):
            of = F.col("failed") == s
            for test in tests:
                of = of & test
            cells.append(F.sum(F.when(of, F.col("n")).otherwise(zero)))
        return F.array(*cells).alias(alias)

    parts = found.groupBy("part").agg(
        per_set("all"), per_set("good", F.col("good")), per_set("toxic", F.col("toxic"))
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    steps = F.sequence(F.lit(1), F.lit(len(names)))
    each = parts.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(steps).alias("step"))

    def bit(letter: str) -> str:
        return f"shiftleft(1, instr('{''.join(names)}', {letter}) - 1)"

    before = f"aggregate(sequence(1, {len(names)}), 0, (done, i) -> IF(i < step, done | {bit('substr(filter_order, i, 1)')}, done))"
    placed = each.withColumns({"letter": F.expr("substr(filter_order, step, 1)"), "before": F.expr(before)}).withColumn(
        "own", F.expr(bit("letter"))
    )

    def over(counts: str, test: str, alias: str) -> Column:
        return F.expr(f"aggregate(sequence(0, {sets - 1}), 0L, (n, s) -> n + IF({test}, {counts}[s], 0L))").alias(alias)

    fails, earlier = "(s & own) <> 0", "(s & before) <> 0"
    counted = placed.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "letter",
        over("all", f"NOT ({fails}) AND NOT ({earlier})", "kept"),
        over("all", f"{fails} AND NOT ({earlier})", "removed"),
        over("all", f"{fails} AND {earlier}", "redundant"),
        over("all", "s = own", "unique_fails"),
        over("good", f"{fails} AND NOT ({earlier})", "good_lost"),
        over("toxic", f"{fails} AND NOT ({earlier})", "toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return counted.withColumn("shapley", shapley).drop("letter")
