"""Line dedup by a deletion-neighbourhood join: repeated and nearly repeated lines, earliest kept.

A line is its lower-cased words. A line goes when an earlier line of the input has the same words,
or is one word-edit away (a word put in, left out or exchanged) and both have at least
``min_words`` words. At five words that is a similarity of 0.8; longer lines need far more (0.95 at
twenty words, 0.975 at forty), so a long line with two changed words is kept. Earlier means by doc_id, NULL
last, then by the text's hash, then by place in the text. Lines are judged on the input, not on
what is left.

Near lines meet in their deletion neighbourhood: the hash of the line and of the line without each
one of its words. Two lines within one edit share such a variant; those that do are verified on
their words. Exact copies are one line there, and a variant that many lines share is met with
its earliest line only, so no bucket is expanded into pairs.

Most lines are like no other, so their variants are not even made: of two lines within one
edit, one half of the shorter agrees. Halves that two different lines have set bits in a filter
of fixed size, which every task gets; a line without such a half needs no variants. The filter may
let more lines through than need be, never fewer, so results do not depend on it.

Defined results: a NULL text has no lines and stays NULL. Blank lines are never removed. Rows equal
in doc_id and text count as one and fare alike. Empty tables give empty results. Other columns are
passed through; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import free_name, null_safe, schema_of, slices, staged, text_key, with_columns

# One edit in five words leaves a similarity of 0.8, in longer lines more.
MIN_WORDS = 5
# Bits of the filter of shared halves: 8 MB, whatever the size of the corpus.
FILTER_BITS = 1 << 26
# Bits of one row of bitmap_construct_agg.
BUCKET_BITS = 32_768
BASE = 0x9E3779B97F4A7C15
WHOLE = -1


def words_of(line: str) -> list[str]:
    return line.lower().split()


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def line_hashes(words: list[str]) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    return signed(value >> 64), signed(value & ((1 << 64) - 1))


def half_keys(words: list[str]) -> list[int]:
    """Hashes of the halves that a line within one edit could share.

    With h(n) = n // 2, lines of n and n or n + 1 words within one edit share their first h(n)
    or their last n - h(n) words; a line is the shorter one in one case and the longer in the other.
    """
    n = len(words)
    hash_of = xxhash.xxh3_64_intdigest
    heads, tails = {n // 2, (n - 1) // 2}, {n - n // 2, n - 1 - (n - 1) // 2}
    keys = [hash_of("\n".join(words[:k]).encode("utf-8", "surrogatepass"), 1) for k in heads]
    keys += [hash_of("\n".join(words[n - k :]).encode("utf-8", "surrogatepass"), 2) for k in tails]
    return [signed(k) for k in keys]


def variants(words: list[str]) -> np.ndarray:
    """Hashes of the line without each of its words, and of the whole line at the end."""
    hash_of = xxhash.xxh3_64_intdigest
    own = np.array([hash_of(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    n = len(own)
    powers = np.full(n + 1, BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    none = np.zeros(1, dtype=np.uint64)
    before = np.concatenate([none, np.cumsum(own * powers[:n])])
    moved = np.concatenate([none[:0], own[1:] * powers[: n - 1]])
    after = np.concatenate([np.cumsum(moved[::-1])[::-1], none])
    rest = np.append(before[:n] + after, before[n])
    rest ^= rest >> np.uint64(29)
    return (rest * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether the word sequences are equal but for one word put in, left out or exchanged."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))


def _lines(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, line_no, again, h1, h2, halves): every line with words; ``again`` when the
    same document has it further up."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            owner, number, again, h1, h2, halves = [], [], [], [], [], []
            for i, value in enumerate(texts):
                seen = set()
                for k, line in enumerate(value.split("\n")):
                    words = words_of(line)
                    if words:
                        hashes = line_hashes(words)
                        owner.append(i)
                        number.append(k)
                        again.append(hashes in seen)
                        h1.append(hashes[0])
                        h2.append(hashes[1])
                        wanted = len(words) >= min_words and hashes not in seen
                        halves.append(half_keys(words) if wanted else [])
                        seen.add(hashes)
            of = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("text_key").take(of),
                 pa.array(number, pa.int32()), pa.array(again, pa.bool_()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(halves, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "line_no", "again", "h1", "h2", "halves"],
            )

    return rows.mapInArrow(
        run, f"doc_id {id_type}, text_key bigint, line_no int, again boolean, h1 bigint, h2 bigint, halves array<bigint>"
    )


def _shared_halves(lines: DataFrame, filter_bits: int) -> np.ndarray:
    """A bitmap of ``filter_bits`` bits with two bits for every half that different lines have."""
    halves = lines.select("h1", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b")
    place = F.explode(F.array(*[F.pmod(F.shiftright("half", by), F.lit(filter_bits)) for by in (0, 32)]))
    # Buckets count from 1; bits of a bucket from 0.
    rows = shared.select(place.alias("place")).groupBy(
        F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")).collect()
    out = np.zeros((filter_bits // BUCKET_BITS, BUCKET_BITS // 8), dtype=np.uint8)
    for bucket, bits in rows:  # at most filter_bits / BUCKET_BITS rows of 4 KB
        out[bucket - 1] = np.frombuffer(bits, dtype=np.uint8)
    return out.reshape(-1)


def _is_set(bitmap: np.ndarray, halves: np.ndarray) -> np.ndarray:
    found = np.ones(len(halves), dtype=bool)
    for by in (0, 32):
        place = (halves >> by) % (len(bitmap) * 8)
        found &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found


def _candidates(rows: DataFrame, bitmap: np.ndarray, min_words: int) -> DataFrame:
    """(doc_id, text_key, line_no, h1, h2, line): lines with a shared half, once per slice."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            lines, halves, of_line = [], [], []
            for i, value in enumerate(texts):
                for k, line in enumerate(value.split("\n")):
                    words = words_of(line)
                    if len(words) >= min_words:
                        keys = half_keys(words)
                        halves += keys
                        of_line += [len(lines)] * len(keys)
                        lines.append((i, k, words))
            hit = _is_set(shared.value, np.array(halves, dtype=np.int64))
            chosen = [lines[j] for j in np.unique(np.array(of_line, dtype=np.int64)[hit]).tolist()]
            hashes = [line_hashes(words) for _, _, words in chosen]
            of = pa.array([c[0] for c in chosen], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("text_key").take(of),
                 pa.array([c[1] for c in chosen], pa.int32()),
                 pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                 pa.array([" ".join(c[2]) for c in chosen], pa.string())],
                ["doc_id", "text_key", "line_no", "h1", "h2", "line"],
            )

    return rows.mapInArrow(
        run, f"doc_id {id_type}, text_key bigint, line_no int, h1 bigint, h2 bigint, line string"
    )


def _in_order(candidates: DataFrame) -> DataFrame:
    """(rank, h1, h2, line): each distinct line once, ``rank`` growing with its first place."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "line_no")
    distinct = candidates.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.first("line").alias("line"))
    # Range partitions follow each other, and so do the ids that they give out.
    ordered = distinct.repartitionByRange("place", "h1", "h2").sortWithinPartitions("place", "h1", "h2")
    return staged(ordered.select(F.monotonically_increasing_id().alias("rank"), "h1", "h2", "line"))


def _neighbourhood(ordered: DataFrame) -> DataFrame:
    """(rank, variant, at): the line without its word ``at``, and the whole line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "line", 500_000):
            made = [variants(t.split(" ")) for t in texts]
            sizes = np.array([len(m) for m in made])
            ranks = np.repeat(np.array(batch.column("rank")), sizes)
            at = [np.append(np.arange(n - 1, dtype=np.int32), np.int32(WHOLE)) for n in sizes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranks), pa.array(np.concatenate(made)), pa.array(np.concatenate(at))],
                ["rank", "variant", "at"],
            )

    return ordered.select("rank", "line").mapInArrow(run, "rank bigint, variant bigint, at int")


def _near(ordered: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within one edit."""
    made = _neighbourhood(ordered)
    cut, whole = F.col("at") >= 0, F.col("at") == WHOLE
    shared = made.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(whole, F.col("rank"))).alias("whole"),
        F.min(F.when(cut, F.col("rank"))).alias("cut"),
    ).filter("n > 1").drop("n")
    met = staged(made.join(shared, "variant"))
    # Without the same word at the same place: one exchanged. With a whole line: one put in or left out.
    exchanged = met.filter(cut).groupBy("variant", "at").agg(
        F.min("rank").alias("earlier"), F.max("rank").alias("latest")
    ).filter("earlier < latest").drop("latest")
    pairs = (
        met.filter(cut).join(exchanged, ["variant", "at"]).select("rank", "earlier")
        .unionByName(met.filter(cut).select("rank", F.col("whole").alias("earlier")))
        .unionByName(met.filter(whole).select("rank", F.col("cut").alias("earlier")))
        .filter("earlier < rank").distinct()
    )
    texts = ordered.select("rank", "line")
    first = texts.select(F.col("rank").alias("earlier"), F.col("line").alias("first"))
    both = pairs.join(ordered, "rank").join(first, "earlier").select("h1", "h2", "line", "first")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = [
                within_one_edit(a.split(" "), b.split(" "))
                for a, b in zip(batch.column("line").to_pylist(), batch.column("first").to_pylist())
            ]
            yield batch.select(["h1", "h2"]).filter(pa.array(sure, pa.bool_()))

    return both.mapInArrow(verified, "h1 bigint, h2 bigint").distinct()


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    min_words: int = MIN_WORDS, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, text_key, line_no) of the lines to remove; lines count from 0."""
    rows = _rows(docs, key, text)
    lines = staged(_lines(rows, max(min_words, 2)))
    bitmap = _shared_halves(lines, filter_bits)
    near = _near(_in_order(_candidates(rows, bitmap, max(min_words, 2))))
    lines = lines.drop("halves")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    once = lines.filter(~F.col("again"))
    first = once.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("latest"))
    judged = first.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    # Lines without a copy or a neighbour need not be looked up.
    told = staged(judged.filter((F.col("first") < F.col("latest")) | F.col("near")).drop("latest"))
    late = (place > F.col("first")) | F.coalesce("near", F.lit(False))
    gone = once.join(told, ["h1", "h2"]).filter(late).select("doc_id", "text_key", "line_no", "h1", "h2")
    more = lines.filter("again").select("doc_id", "text_key", "line_no")
    return gone.select("doc_id", "text_key", "line_no").unionByName(more)


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    n_lines: str = "n_lines", n_removed: str = "n_removed", **how,
) -> DataFrame:
    """``docs`` with ``text`` without its repeated lines, and with the lines it had and lost."""
    gone = repeated_lines(docs, key, text, **how)
    list_name, key_name = free_name(docs, "__gone"), free_name(docs, "__text_key")
    per_doc = gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias(list_name))
    kept = docs.drop(*[c for c in (n_lines, n_removed) if c not in (key, text)])
    marked = kept.withColumn(key_name, text_key(text))
    renamed = per_doc.withColumnsRenamed({"doc_id": key, "text_key": key_name})
    joined = null_safe(marked, renamed, [key, key_name], "left").drop(key_name)
    at = kept.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            out, had, lost = [], [], []
            present = batch.column(text).is_valid().to_pylist()
            for value, is_text, numbers in zip(texts, present, batch.column(list_name).to_pylist()):
                lines = value.split("\n")
                had.append(len(lines) if is_text else 0)
                lost.append(len(numbers or ()))
                if numbers:
                    drop = set(numbers)
                    value = "\n".join(line for k, line in enumerate(lines) if k not in drop)
                out.append(value if is_text else None)
            bare = with_columns(batch, (list_name,))
            bare = bare.set_column(at, text, pa.array(out, pa.string()))
            yield with_columns(
                bare, (), **{n_lines: pa.array(had, pa.int64()), n_removed: pa.array(lost, pa.int64())}
            )

    return joined.mapInArrow(cut, schema_of(kept, (), f"`{n_lines}` bigint, `{n_removed}` bigint"))
