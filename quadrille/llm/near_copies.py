"""Near-dedup of the pipeline: five-word shingles, Jaccard similarity of 0.8 or more, verified.

Two of 64 bits, the budget of the op5 query, lose nearly all copies at 0.8: there a SimHash differs
in 10 bits on average, and a budget of 10 leaves a pigeonring join key of 4 bits, which pairs
everything. So texts meet on shingles: in any one order of all hashes, the first n - ceil(0.8 n) + 1 of
two sets with a similarity of 0.8 or more have one in common (prefix filter). The order puts
common hashes last: those that more than ``BUCKET`` prefixes have in the order of the hashes alone,
marked in a bitmap of fixed size, so that two texts meet on what is rare in them. A hash that one
set alone has is dropped before anything is joined, by another such bitmap; the join moves ids, sizes and
hashes. Sets whose sizes rule out 0.8 are no pair. A parity signature (of every set as many bits as
hashes, up to a factor of two) differs in no more bits than the sets differ in hashes, so
pairs whose signatures differ in more than a ninth of both sizes are below 0.8, which leaves few; those
are verified on all shingle hashes, which are read again from their texts.

Texts with equal shingle sets are one row before any join. What is still common, because all hashes of
a set are, is settled in two steps. Each set of the bucket is compared with ``LEADERS`` of them, one
order of leaders for all hashes, which joins a group of copies of any size in linear work. Then, in
buckets whose sets do not all hang together, every set outside the bucket's largest component is
compared with all sets of other components. So no link between components is lost, at any size.

Defined results: a text of fewer than five words is one shingle; NULL and wordless texts have none
and count as equal. The row with the smallest doc_id of a component stays (NULL last), then the
smallest text hash; equal rows are kept once. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.common import free_name, slices, staged, text_key
from quadrille.llm.graph import components
from quadrille.llm.simhash import shingle_hashes

SHINGLE = 5
# The similarity that links, in fifths.
FIFTHS = 4
# Sets of a hash that are paired directly, and those that the others of a larger bucket are compared with.
BUCKET, LEADERS = 128, 8
# Bits of a filter: 8 MB. Spark's bitmap functions build it in buckets of 4 KB.
FILTER_BITS, BUCKET_BITS = 1 << 26, 1 << 15


def bitmap(values: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap with two bits for every number of ``values`` (v), of a size that no input changes."""
    place = F.explode(F.array(*[F.pmod(F.shiftright("v", by), F.lit(bits)) for by in (0, 32)]))
    rows = values.select(place.alias("place")).groupBy(
        F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")).collect()
    out = np.zeros((bits // BUCKET_BITS, BUCKET_BITS // 8), dtype=np.uint8)
    for bucket, found in rows:  # at most bits / BUCKET_BITS rows of 4 KB
        out[bucket - 1] = np.frombuffer(found, dtype=np.uint8)
    return out.reshape(-1)


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of ``values`` may be in the bitmap; those in it always are."""
    found = np.ones(len(values), dtype=bool)
    for by in (0, 32):
        place = (values >> by) % (len(bits) * 8)
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text, in ascending order."""
    return np.unique(shingle_hashes(text, SHINGLE))


def prefix(hashes: np.ndarray) -> np.ndarray:
    """Of two ordered sets within the similarity, these share a hash."""
    n = len(hashes)
    return hashes[: n - -(-n * FIFTHS // 5) + 1] if n else hashes


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view("<i8")


def signature(hashes: np.ndarray) -> bytes:
    """For each of a power of two of cells, whether an odd number of hashes falls into it."""
    cells = 1 << max(6, (len(hashes) - 1).bit_length())
    count = np.bincount((hashes.view("<u8") >> np.uint64(8)).astype(np.int64) & (cells - 1), minlength=cells)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def cells_apart(a: bytes, b: bytes) -> int:
    """In how many cells two signatures differ, the longer one folded onto the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (x, y))
    return int.from_bytes((x ^ y).tobytes(), "little").bit_count()


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_key) of every row with its set's id, size, signature and first hashes in their own order."""
    rows = docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            sets = [shingle_set(t) for t in texts]
            ids = [xxhash.xxh64_intdigest(s.tobytes(), 1) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(signed(np.array(ids, dtype="<u8"))),
                 pa.array([len(s) for s in sets], pa.int32()), pa.array([signature(s) for s in sets], pa.binary()),
                 pa.array([signed(prefix(s)) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "text_key", "set_id", "n", "sig", "least"],
            )

    return rows.mapInArrow(run, f"doc_id {id_type}, text_key bigint, set_id bigint, n int, sig binary, least array<bigint>")


def hashes_of(docs: DataFrame, wanted: DataFrame, text: str, common: np.ndarray | None = None) -> DataFrame:
    """(set_id, hashes) of the sets ``wanted`` (set_id, text_key), read from their texts: all hashes, or
    with ``common`` the first in the order that puts those last."""
    spark = docs.sparkSession
    keys = spark.sparkContext.broadcast(bitmap(wanted.select(F.col("text_key").alias("v"))))
    last = None if common is None else spark.sparkContext.broadcast(common)
    texts = docs.select(text_key(text).alias("text_key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            hit = marked(keys.value, whole.column("text_key").to_numpy())
            for batch, values in slices(iter([whole.filter(pa.array(hit))])):
                found = []
                for value in values:
                    hashes = signed(shingle_set(value))
                    if last is not None:
                        rare = ~marked(last.value, hashes)
                        hashes = prefix(np.concatenate([hashes[rare], hashes[~rare]]))
                    found.append(hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key"), pa.array(found, pa.list_(pa.int64()))], ["text_key", "hashes"]
                )

    read = texts.mapInArrow(run, "text_key bigint, hashes array<bigint>")
    return read.join(wanted, "text_key").groupBy("set_id").agg(F.first("hashes").alias("hashes"))


def met_on(prefixes: DataFrame, bucket: int) -> tuple[DataFrame, np.ndarray, bool]:
    """(hash, v) counted: hashes of more than one set as a bitmap, and those of more than ``bucket``."""
    counts = staged(
        prefixes.select(F.explode("least").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n_sets")).filter("n_sets > 1")
    )
    common = counts.filter(F.col("n_sets") > bucket).select(F.col("hash").alias("v"))
    return counts, bitmap(counts.select(F.col("hash").alias("v"))), not common.isEmpty()


def rare_prefixes(docs: DataFrame, sets: DataFrame, text: str, bucket: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``sets`` with prefixes in which common hashes come last, their hashes' counts and bitmap."""
    counts, shared, any_common = met_on(sets, bucket)
    if not any_common:
        return sets, counts, shared
    common = bitmap(counts.filter(F.col("n_sets") > bucket).select(F.col("hash").alias("v")))
    told = docs.sparkSession.sparkContext.broadcast(common)
    columns = "set_id bigint, text_key bigint, n int, least array<bigint>, late boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch.column("least")
            hit = marked(told.value, least.flatten().to_numpy())
            ends = np.cumsum(np.concatenate([[0], hit.astype(np.int64)]))
            places = least.offsets.to_numpy() - least.offsets[0].as_py()
            late = ends[places[1:]] > ends[places[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(late)], [*batch.schema.names, "late"])

    # Without a common hash among its first ones, a set's prefix is the same in both orders.
    told_apart = staged(sets.mapInArrow(run, columns))
    late = told_apart.filter("late")
    again = hashes_of(docs, late.select("set_id", "text_key"), text, common).withColumnRenamed("hashes", "least")
    moved = late.drop("least", "late").join(again, "set_id").select(*sets.columns)
    ordered = staged(told_apart.filter("NOT late").select(*sets.columns).unionByName(moved))
    counts, shared, _ = met_on(ordered, bucket)
    return ordered, counts, shared


def meetings(sets: DataFrame, counts: DataFrame, shared: np.ndarray) -> DataFrame:
    """(hash, n_sets, set_id, n) for every hash of a prefix that more than one set has in its own."""
    told = sets.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch.column("least")
            hashes = least.flatten()
            owner = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(least.offsets.to_numpy())))
            hit = pa.array(marked(told.value, hashes.to_numpy()))
            of = owner.filter(hit)
            yield pa.RecordBatch.from_arrays(
                [hashes.filter(hit), batch.column("set_id").take(of), batch.column("n").take(of)], ["hash", "set_id", "n"]
            )

    return sets.select("set_id", "n", "least").mapInArrow(run, "hash bigint, set_id bigint, n int").join(counts, "hash")


def sizes_allow(a: Column, b: Column) -> Column:
    return (a * 5 >= b * FIFTHS) & (b * 5 >= a * FIFTHS)


def paired(left: DataFrame, right: DataFrame, *also: str) -> DataFrame:
    """(u, v) with u < v of the sets of ``left`` and ``right`` that share a hash and may link; those
    equal in any column of ``also`` do not pair."""
    other = right.select("hash", F.col("set_id").alias("b"), F.col("n").alias("n_b"), *[F.col(c).alias(f"{c}_b") for c in also])
    test = (F.col("set_id") != F.col("b")) & sizes_allow(F.col("n"), F.col("n_b"))
    for column in also:
        test = test & (F.col(column) != F.col(f"{column}_b"))
    both = left.select("hash", "set_id", "n", *also).join(other, "hash").filter(test)
    return both.select(F.least("set_id", "b").alias("u"), F.greatest("set_id", "b").alias("v")).distinct()


def not_apart(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose signatures leave room for the similarity."""
    of = lambda end: sets.select(F.col("set_id").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_u", "n_v", "sig_u", "sig_v")]
            near = pa.array([cells_apart(a, b) * 9 <= n + m for n, m, a, b in zip(*columns)], pa.bool_())
            yield batch.select(["u", "v"]).filter(near)

    return pairs.join(of("u"), "u").join(of("v"), "v").mapInArrow(run, "u bigint, v bigint")


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """The pairs whose similarity reaches 0.8, told on all their hashes."""
    pairs = staged(not_apart(sets, pairs))
    ends = pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct()
    read = staged(hashes_of(docs, sets.select("set_id", "text_key").join(ends, "set_id"), text))
    left = read.select(F.col("set_id").alias("u"), F.col("hashes").alias("hashes_u"))
    right = read.select(F.col("set_id").alias("v"), F.col("hashes").alias("hashes_v"))
    common = F.size(F.array_intersect("hashes_u", "hashes_v"))
    whole = F.size("hashes_u") + F.size("hashes_v") - common
    return pairs.join(left, "u").join(right, "v").filter(common * 5 >= whole * FIFTHS).select("u", "v")


def links(docs: DataFrame, found: DataFrame, text: str, bucket: int = BUCKET, leaders: int = LEADERS) -> DataFrame:
    """(u, v): verified links that connect all sets which a chain of links of 0.8 or more connects."""
    sets = staged(found.groupBy("set_id").agg(
        F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("least").alias("least"),
    ))
    ordered, counts, shared = rare_prefixes(docs, sets.drop("sig"), text, bucket)
    met = staged(meetings(ordered, counts, shared))
    few, many = met.filter(F.col("n_sets") <= bucket), met.filter(F.col("n_sets") > bucket)
    left = few.filter("n > 0")
    pairs = paired(left, left)
    hot = not many.isEmpty()
    if hot:
        # One order of leaders for all hashes, so that a group of copies has few in all.
        place = F.pmod(F.xxhash64(F.lit("leader"), "set_id"), F.lit(1 << 40))
        led = many.filter(place.cast("double") * F.col("n_sets") < F.lit(float(leaders << 40)))
        pairs = pairs.unionByName(paired(many, led)).distinct()
    linked = staged(verified(docs, sets, pairs, text))
    if not hot:
        return linked
    roots = components(linked).withColumnRenamed("node", "set_id")
    rooted = staged(many.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")))
    sizes = rooted.groupBy("hash", "root").agg(F.count(F.lit(1)).alias("rows"))
    main = sizes.groupBy("hash").agg(F.max_by("root", "rows").alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    apart = rooted.join(main, "hash")
    rest = paired(apart.filter("root <> main"), apart, "root")
    return linked.unionByName(verified(docs, sets, rest, text))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group of near copies."""
    found = staged(sketches(docs, key, text))
    rooted = components(links(docs, found, text, **how))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    firsts = found.groupBy("set_id").agg(F.min(rank).alias("best"))
    grouped = staged(
        firsts.join(rooted, firsts.set_id == rooted.node, "left")
        .groupBy(F.coalesce("root", "set_id").alias("root")).agg(F.min("best").alias("best"))
    )
    best = grouped.select(F.col("best.doc_id").alias("__id"), F.col("best.text_key").alias("__key"))
    kept = docs.join(
        best, docs[key].eqNullSafe(F.col("__id")) & (text_key(text) == F.col("__key")), "left_semi"
    )
    if found.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():
        return kept
    turn = free_name(docs, "__turn")
    order = Window.partitionBy(F.col(key), text_key(text)).orderBy(F.lit(0))
    return kept.withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1).drop(turn)
