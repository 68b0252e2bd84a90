"""Chat formatting by quotation linking: who answers whom, told from what is quoted.

Lines that begin with ``>`` marks are quotes, one level per mark; consecutive lines of one level
form a passage, cut at blank lines. A passage's normalised words are hashed and joined, within
a conversation, to the messages before it that have these words on one line or on consecutive lines
of their own, not cut by a blank line or a quote; the first message of which they are a whole
passage is the original, or else the first that has them at all. So a quote of a part of a paragraph links, and so do interleaved replies. A message
replies to the latest original among its quotes of the lowest linked level. Linked quotes go, with the
lines that announce them; quotes of what nobody said before, and lines that only look like quotes, stay in
the text. Replies stand after what they reply to.

Runs of own lines are hashed only where a quote has as many words, and leave their task only if
their hash has its bit in a filter of all quotes (fixed 8 MB, sent to every task; it may let more
through, never fewer). Without any quote they are not read at all. Equal runs are one row before the
join, by an aggregate, so a line that a third of all messages have is looked up, never paired. Roots are found by doubling: a message asks the message it
points to where that one points, so a chain of any length takes the logarithm of it in turns.

Defined results: a NULL text stays NULL and quotes nothing; NULL conversations or turns link to
nothing and count as roots. Rows that share a conversation and turn are one message for links,
and each keeps its own row. A message without a linked quote is the root of its thread. Empty
tables give empty results. Other columns are passed through; columns named like the added ones
are replaced.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import free_name, schema_of, slices, staged, with_columns

# Bits of the filter of quoted passages: 8 MB, whatever the size of the table.
FILTER_BITS = 1 << 26
# Bits of one row of bitmap_construct_agg.
BUCKET_BITS = 32_768

QUOTE = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
# A line that announces a quote, in the languages of the corpus.
ANNOUNCES = re.compile(r"\b(wrote|said|schrieb|écrit|escribió)\b.*:\s*$", re.IGNORECASE)


Block = list[list[str]]


@dataclass
class Passage:
    """A quoted passage: its level, its words, and the lines that go with it."""

    level: int
    lines: list[int]
    words: list[str] = field(default_factory=list)

    @property
    def said(self) -> str:
        return " ".join(self.words)


def _lead(lines: list[str], end: int, own: Block) -> list[int]:
    """The blank lines before line ``end``, and the line that announces what begins there."""
    found: list[int] = []
    announced = False
    for i in range(end - 1, -1, -1):
        line = lines[i]
        if line.strip():
            if announced or QUOTE.match(line) or not ANNOUNCES.search(line):
                break
            announced = True
            if own and own[-1] == line.lower().split():
                own.pop()
        found.append(i)
    return found


def blocks_of(text: str) -> tuple[list[Block], list[Passage]]:
    """A message's own passages, as the words of their lines, and its quoted ones."""
    own: list[Block] = [[]]
    quoted: list[Passage] = []
    level = 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        mark = QUOTE.match(line)
        depth = mark.group(1).count(">") if mark else 0
        words = (line[mark.end() :] if mark else line).lower().split()
        if depth:
            begins = not level
            lead = _lead(lines, i, own[-1]) if begins else []
            if begins:
                own.append([])
            if not words and not begins:
                # An empty line ends a passage and goes with it.
                quoted[-1].lines.append(i)
                quoted.append(Passage(depth, []))
            else:
                if depth != level or not words:
                    quoted.append(Passage(depth, lead))
                quoted[-1].lines.append(i)
                quoted[-1].words.extend(words)
        elif words:
            own[-1].append(words)
        else:
            own.append([])
        level = depth
    return [b for b in own if b], [p for p in quoted if p.words]


def without(text: str, quoted: Iterable[Passage]) -> str:
    """``text`` without the lines of ``quoted``."""
    gone = {i for p in quoted for i in p.lines}
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone).strip("\n") if gone else text


def parse(text: str) -> tuple[str, list[str], list[tuple[int, str]]]:
    """A message without any quotes, its own passages, and its quoted ones with their levels."""
    own, quoted = blocks_of(text)
    return without(text, quoted), [" ".join(w for line in b for w in line) for b in own], [(p.level, p.said) for p in quoted]


def runs(block: Block, sizes: list[int]) -> Iterator[str]:
    """The runs of whole lines of ``block`` with a number of words among ``sizes`` (ascending)."""
    starts = list(itertools.accumulate(map(len, block), initial=0))
    line_at = {n: i for i, n in enumerate(starts)}
    wanted = set(sizes)
    words: list[str] = [w for line in block for w in line]
    for first in starts[:-1]:
        if len(block) <= len(sizes):
            ends = [n for n in starts[line_at[first] + 1 :] if n - first in wanted]
        else:
            longest = bisect.bisect_right(sizes, len(words) - first)
            ends = [first + n for n in sizes[:longest] if first + n in line_at]
        for end in ends:
            yield " ".join(words[first:end])


def passage_hash(words: str) -> str:
    return xxhash.xxh3_128_hexdigest(words.encode("utf-8", "surrogatepass"))


def parsed(messages: DataFrame, text: str, quotes: str) -> DataFrame:
    """``messages`` with the levels, hashes and sizes of the passages that ``text`` quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.string()), ("n", pa.int32())]))
        for batch, texts in slices(batches, text):
            marks = [
                [{"level": p.level, "hash": passage_hash(p.said), "n": len(p.words)} for p in blocks_of(t)[1]]
                for t in texts
            ]
            yield with_columns(batch, (), **{quotes: pa.array(marks, kind)})

    return messages.mapInArrow(run, schema_of(messages, (), f"`{quotes}` array<struct<level:int,hash:string,n:int>>"))


def unquoted(messages: DataFrame, text: str, hashes: str) -> DataFrame:
    """``messages`` without the quoted passages of ``text`` whose hash is among its ``hashes``, and without that column."""
    at = messages.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            linked = [set(h or ()) for h in batch.column(hashes).to_pylist()]
            clean = [without(t, [p for p in blocks_of(t)[1] if passage_hash(p.said) in h]) if h else t
                     for t, h in zip(texts, linked)]
            valid = batch.column(text).is_valid().to_pylist()
            column = pa.array([c if v else None for c, v in zip(clean, valid)], pa.string())
            yield with_columns(batch.set_column(at, text, column), (hashes,))

    return messages.mapInArrow(run, schema_of(messages, (hashes,), ""))


def bit_of(passage: str, bits: int) -> int:
    return int(passage[:8], 16) % bits


def quoted_bits(quoted: DataFrame, bits: int) -> np.ndarray:
    """A bitmap with one bit for every quoted hash; ``bit_of`` says which."""
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint") % F.lit(bits)
    # Buckets count from 1; bits of a bucket from 0.
    rows = quoted.select(place.alias("place")).groupBy(
        F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")).collect()
    out = np.zeros((bits // BUCKET_BITS, BUCKET_BITS // 8), dtype=np.uint8)
    for bucket, found in rows:  # at most bits / BUCKET_BITS rows of 4 KB
        out[bucket - 1] = np.frombuffer(found, dtype=np.uint8)
    return out.reshape(-1)


def said_runs(messages: DataFrame, conv: str, turn: str, text: str, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """(conv, turn, hash, whole) of the runs of own lines that a quote may repeat, ``whole`` for passages."""
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    rows = rows.filter("conv IS NOT NULL AND turn IS NOT NULL")
    shared = rows.sparkSession.sparkContext.broadcast((sizes, bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, filled = shared.value
        bits = len(filled) * 8
        for batch, texts in slices(batches):
            owner, hashes, whole = [], [], []
            for i, value in enumerate(texts):
                distinct: dict[str, bool] = {}
                for block in blocks_of(value)[0]:
                    size = sum(map(len, block))
                    for words in runs(block, lengths):
                        found = passage_hash(words)
                        distinct[found] = distinct.get(found, False) or words.count(" ") + 1 == size
                for found, all_of_it in distinct.items():
                    place = bit_of(found, bits)
                    if filled[place >> 3] >> (place & 7) & 1:
                        owner.append(i)
                        hashes.append(found)
                        whole.append(all_of_it)
            of = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv").take(of), batch.column("turn").take(of), pa.array(hashes, pa.string()),
                 pa.array(whole, pa.bool_())],
                ["conv", "turn", "hash", "whole"],
            )

    return rows.mapInArrow(run, schema_of(rows, ("text",), "hash string, whole boolean"))


def roots(links: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every message in ``links`` (conv, turn, reply_to)."""
    now = staged(links.select("conv", "turn", F.col("reply_to").alias("root"), F.lit(1).alias("depth")))
    while True:
        further = now.select(
            F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("root").alias("up"), F.col("depth").alias("more")
        )
        if now.join(further, (F.col("conv") == F.col("c")) & (F.col("root") == F.col("t")), "left_semi").isEmpty():
            return now
        met = now.join(further, (F.col("conv") == F.col("c")) & (F.col("root") == F.col("t")), "left")
        now = staged(met.select(
            "conv", "turn", F.coalesce("up", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        ))


def link_quotations(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``messages`` without linked quotes in ``text``, with n_quotes, n_linked, reply_to, thread and depth.

    ``reply_to`` is the turn answered, ``thread`` the turn at the root; ordered by (conversation,
    thread, turn), every reply stands after what it replies to.
    """
    added = ("n_quotes", "n_linked", "reply_to", "thread", "depth")
    base = messages.drop(*[c for c in added if c not in (conv, turn, text)])
    quotes, row, found = (free_name(base, n) for n in ("__quotes", "__row", "__found"))
    told = staged(parsed(base.withColumn(row, F.monotonically_increasing_id()), text, quotes))
    quoted = told.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(row).alias("row"), F.explode(quotes).alias("q")
    ).select("conv", "turn", "row", "q.level", "q.hash", "q.n")
    # Distinct numbers of words, so at most about the longest passage of them.
    sizes = sorted(r.n for r in quoted.select("n").distinct().collect())
    if sizes:
        said = said_runs(base, conv, turn, text, sizes, quoted_bits(quoted, filter_bits))
    else:
        said = quoted.select("conv", "turn", "hash", F.lit(True).alias("whole"))
    first = said.groupBy("conv", "hash").agg(
        F.min(F.when(F.col("whole"), F.col("turn"))).alias("passage"), F.min("turn").alias("part")
    )
    original = F.when(F.col("passage") < F.col("turn"), F.col("passage")).when(F.col("part") < F.col("turn"), F.col("part"))
    linked = staged(quoted.join(first, ["conv", "hash"]).withColumn("original", original).filter("original IS NOT NULL"))
    # At most the quotes of one row.
    gone = linked.groupBy(F.col("row").alias(row)).agg(F.collect_set("hash").alias(found))
    # Of the lowest linked level, the latest original.
    answer = F.max(F.struct((-F.col("level")).alias("near"), "original"))["original"].alias("reply_to")
    per_message = staged(linked.groupBy("conv", "turn").agg(
        F.count_distinct("level", "hash").alias("n_linked"), answer
    ))
    placed = per_message.join(roots(per_message).select("conv", "turn", "root", "depth"), ["conv", "turn"])
    names = {c: free_name(told, f"__{c}") for c in ("conv", "turn", "n_linked", "reply_to", "root", "depth")}
    met = told.join(gone, row, "left").join(
        placed.withColumnsRenamed(names),
        (F.col(conv) == F.col(names["conv"])) & (F.col(turn) == F.col(names["turn"])), "left",
    )
    return unquoted(met.select(
        *base.columns, F.col(found), F.size(F.array_distinct(F.col(quotes))).alias("n_quotes"),
        F.coalesce(names["n_linked"], F.lit(0)).alias("n_linked"), F.col(names["reply_to"]).alias("reply_to"),
        F.coalesce(names["root"], turn).alias("thread"), F.coalesce(names["depth"], F.lit(0)).alias("depth"),
    ), text, found)


def in_reply_order(linked: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages sorted so that conversations, and the threads in them, stand together and in order."""
    return linked.repartitionByRange(conv, "thread", turn).sortWithinPartitions(conv, "thread", turn)


def quoting_replies(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``messages`` in which each also quotes a line of the turn before it, and above that, one level
    deeper, a line of the turn before that one; which line goes by the turn."""
    words = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    line = F.try_element_at(words, (F.pmod(F.col(turn), F.greatest(F.size(words), F.lit(1))) + 1).cast("int"))
    lines = messages.groupBy(F.col(conv).alias("__conv"), F.col(turn).alias("__turn")).agg(F.min(line).alias("__line"))
    out = messages
    for back, mark in ((1, "> "), (2, ">> ")):
        earlier = lines.withColumnsRenamed({c: f"{c}_{back}" for c in lines.columns})
        out = out.join(
            earlier, (F.col(conv) == F.col(f"__conv_{back}")) & (F.col(turn) - back == F.col(f"__turn_{back}")), "left"
        ).withColumn(text, F.when(
            F.col(text).isNotNull() & F.col(f"__line_{back}").isNotNull(),
            F.concat(F.lit(mark), f"__line_{back}", F.lit("\n"), text),
        ).otherwise(F.col(text)))
    return out.select(*messages.columns)
