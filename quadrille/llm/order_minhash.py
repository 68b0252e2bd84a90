"""Document fingerprints by Order MinHash, with DataFrame functions only.

A text's k-mers (k consecutive words; all words where there are fewer) are numbered by occurrence,
so that a repeated k-mer counts as often as it stands there. Every numbered k-mer gets one hash;
its first bits deal it into one of ``bins`` bins, the rest ranks it. Each bin selects its
``take`` lowest-ranked k-mers and lists them in the order of the text; the hash of that tuple is the
bin's entry. Entries agree when texts share k-mers in the same order, so likeness falls with
the edit distance and not only with the sets' overlap (Marçais et al. 2019; one permutation in
place of one per entry).

Arrays of a row stay arrays of 64-bit integers, (rank, place) packed into one, so that
sorting is the primitive one and nothing is shuffled.

Defined results: NULL counts as empty; a text without words has only empty entries. An empty entry is
eight zeros. Likeness is the share of equal entries among those filled in either text, and 1 where
neither has any. Equal texts have equal fingerprints. Repeated rows each get the same answer.
Empty tables give empty results. A text may have up to 2^24 words; places beyond are taken modulo
that, which can only change the order of a tuple.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bytes of text in a range of neighbours.
TASK_BYTES = 16 << 20

K = 3
BINS = 32
TAKE = 2
# A packed integer: the 39 bits of a rank above the place in the text.
PLACE_BITS = 24
PLACE = (1 << PLACE_BITS) - 1
RANK_BITS = 39
DIGITS = 8
# The white space between words (a fixed value).
SPACES = " \t\n\x0b\x0c\r"


def _at(array: Column, index: Column) -> Column:
    return F.get(array, index)


def _rank(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def _packed(rank: Column, place: Column) -> Column:
    return F.shiftleft(rank, PLACE_BITS).bitwiseOR(place)


def with_fingerprint(df: DataFrame, text: str, into: str, k: int = K, bins: int = BINS, take: int = TAKE) -> DataFrame:
    """``df`` with the fingerprint of ``text``: ``bins`` entries of eight hexadecimal digits."""
    if bins & (bins - 1):
        raise ValueError("the number of bins must be a power of two")
    bin_bits = bins.bit_length() - 1
    own = [x for x in df.columns if x != into]
    c = lambda name: F.col(f"__{name}")
    no_numbers = F.array().cast("array<bigint>")
    mask = F.lit((1 << RANK_BITS) - 1)
    bin_shift = PLACE_BITS + RANK_BITS - bin_bits
    bin_of = lambda x: F.shiftright(x, bin_shift)

    # The words, and every k-mer's hash over its place in the text.
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    df = df.withColumn("__words", F.split(trimmed, f"[{SPACES}]+"))
    some = (F.size("__words") > 1) | (_at(c("words"), F.lit(0)) != "")
    df = df.withColumn("__n", F.when(some, F.size("__words")).otherwise(F.lit(0)))
    hash_at = lambda i: F.xxhash64(*[_at(c("words"), i + j) for j in range(k)]).bitwiseAND(mask)
    long = F.transform(F.sequence(F.lit(0), c("n") - k), lambda i: _packed(hash_at(i), i.bitwiseAND(F.lit(PLACE))))
    whole = F.xxhash64(F.array_join(c("words"), " ")).bitwiseAND(mask)
    short = F.when(c("n") > 0, F.array(_packed(whole, F.lit(0)))).otherwise(no_numbers)
    kmers = F.when(c("n") >= k, long).otherwise(short)
    # By bin and rank, with equal k-mers side by side in the order of the text.
    df = df.select(*own, F.sort_array(kmers).alias("__sorted"))

    def follows(array: str):
        return lambda x, i: (i > 0) & (_rank(x) == _rank(_at(c(array), i - 1)))

    # A k-mer's first occurrence ranks by its hash, further ones by a hash of it and their number.
    df = df.withColumn("__again", F.filter(c("sorted"), follows("sorted")))
    starts = F.filter(
        F.sequence(F.lit(0), F.size(c("again")) - 1),
        lambda i: (i == 0) | (_rank(_at(c("again"), i)) != _rank(_at(c("again"), i - 1))),
    )
    df = df.withColumn("__starts", F.when(F.size(c("again")) > 0, starts).otherwise(F.array().cast("array<int>")))

    def numbered(start: Column, j: Column) -> Column:
        end = F.coalesce(_at(c("starts"), j + 1), F.size(c("again")))

        def one(i: Column) -> Column:
            x = _at(c("again"), i)
            return _packed(F.xxhash64(_rank(x), i - start + 1).bitwiseAND(mask), x.bitwiseAND(F.lit(PLACE)))

        return F.transform(F.sequence(start, end - 1), one)

    df = df.withColumn("__more", F.flatten(F.transform(c("starts"), numbered))).select(*own, "__sorted", "__more")

    # All numbered k-mers by bin and rank, and the lowest of each bin. A mark closes every bin, so
    # that empty ones are there too.
    firsts = F.filter(c("sorted"), lambda x, i: ~follows("sorted")(x, i))
    merged = F.when(F.size(c("more")) == 0, c("sorted")).otherwise(F.sort_array(F.concat(firsts, c("more"))))
    df = df.select(*own, merged.alias("__merged"))
    low = F.filter(c("merged"), lambda x, i: (i < take) | (bin_of(x) != bin_of(_at(c("merged"), i - take))))
    marks = F.array(*[F.lit(((b + 1) << bin_shift) - 1) for b in range(bins)])
    df = df.select(*own, F.sort_array(F.concat(low, marks)).alias("__low"))
    heads = F.filter(
        F.sequence(F.lit(0), F.size(c("low")) - 1),
        lambda i: (i == 0) | (bin_of(_at(c("low"), i)) != bin_of(_at(c("low"), i - 1))),
    )

    def entry(i: Column) -> Column:
        """The tuple of the bin that begins at ``i``, in the order of the text."""
        own_bin = bin_of(_at(c("low"), i))
        members = F.filter(
            F.slice(c("low"), i + 1, take),
            lambda x: (bin_of(x) == own_bin) & (x.bitwiseAND(F.lit((1 << bin_shift) - 1)) != (1 << bin_shift) - 1),
        )
        by_place = F.transform(members, lambda x: F.shiftleft(x.bitwiseAND(F.lit(PLACE)), RANK_BITS).bitwiseOR(_rank(x)))
        listed = F.transform(F.sort_array(by_place), lambda x: x.bitwiseAND(mask))
        digits = F.xxhash64(listed).bitwiseAND(F.lit((1 << 4 * DIGITS) - 1))
        return F.when(F.size(members) == 0, F.lit("0" * DIGITS)).otherwise(F.lpad(F.hex(digits), DIGITS, "0"))

    return df.select(*own, F.lower(F.array_join(F.transform(heads, entry), "")).alias(into))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """The share of equal entries among those that either fingerprint has."""
    empty = "0" * DIGITS
    part = lambda f, i: F.substring(f, i * DIGITS + 1, DIGITS)
    steps = F.sequence(F.lit(0), F.lit(bins - 1))
    filled = F.filter(steps, lambda i: (part(a, i) != empty) | (part(b, i) != empty))
    equal = F.filter(steps, lambda i: (part(a, i) != empty) & (part(a, i) == part(b, i)))
    return F.when(F.size(filled) == 0, F.lit(1.0)).otherwise(F.size(equal) / F.size(filled))


def with_next(
    df: DataFrame, key: str = "doc_id", text: str = "text", task_bytes: int = TASK_BYTES,
    made: Callable[[DataFrame], DataFrame] = lambda rows: rows, others: tuple[str, ...] = (),
) -> DataFrame:
    """``made(df)`` with next_<column> for ``text`` and ``others``: those of the row after it in descending order.

    ``made`` adds the columns ``others``, row by row.

    After the last row comes the first. NULL keys come last; rows that share a key go by their text's
    hash. Rows are dealt into ranges of the key by quantiles and sorted there; only a range's last
    row has to look up the first row of the range after it.
    """
    taken = (text, *others)
    rows = df.withColumn("__tie", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    size, with_key = df.agg(F.sum(F.octet_length(text)), F.count(key)).first()
    ranges = max(1, (size or 0) // task_bytes)
    splits: list = []
    if ranges > 1 and with_key:
        shares = [i / ranges for i in range(1, ranges)]
        splits = sorted(set(df.agg(F.percentile_approx(key, shares, F.lit(100 * ranges))).first()[0]))
    above = F.size(F.filter(F.array(*[F.lit(s) for s in splits]), lambda s: s >= F.col(key))) if splits else F.lit(0)
    # NULL keys have no order of their own, so the first bits of the hash deal them into ranges.
    bits = min(max(ranges - 1, 0).bit_length(), 30)
    loose = F.lit(len(splits) + 1) + (F.shiftright("__tie", 64 - bits) + (1 << bits >> 1) if bits else F.lit(0))
    placed = rows.withColumn("__range", F.when(F.col(key).isNull(), loose).otherwise(above).cast("bigint"))
    inside = Window.partitionBy("__range").orderBy(F.col(key).desc_nulls_last(), F.col("__tie"))
    mine = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in taken])
    more = made(placed)
    led = more.withColumn("__next", F.lead(mine).over(inside))
    # A row per range from here on: its highest key, its first row, the range after it.
    tops = placed.groupBy("__range").agg(F.max(key).alias("__top"))
    first_text = (
        placed.join(F.broadcast(tops), "__range").filter(F.col(key).eqNullSafe(F.col("__top")))
        .groupBy("__range").agg(F.min_by(F.coalesce(F.col(text), F.lit("")), "__tie").alias(text))
    )
    firsts = made(first_text).select("__range", mine.alias("__head"))
    along = Window.orderBy("__range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = tops.select("__range", F.coalesce(
        F.lead("__range").over(along), F.min("__range").over(whole)).alias("__after"))
    heads = after.join(firsts.withColumnRenamed("__range", "__after"), "__after").select("__range", "__head")
    joined = led.join(heads, "__range").withColumn("__next", F.coalesce("__next", "__head"))
    columns = [c for c in more.columns if c not in ("__tie", "__range")]
    return joined.select(*columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in taken])


def edited(text: Column, size: Column, next_text: Column, part: int = 3) -> Column:
    """``text`` (of ``size`` code points) with its last third replaced by the start of the next text."""
    gone = F.floor(size / part).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - gone), F.substring(next_text, F.lit(1), gone))


def compared(df: DataFrame, key: str = "doc_id", text: str = "text", task_bytes: int = TASK_BYTES) -> DataFrame:
    """(key, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    printed = lambda df: with_fingerprint(df, "text", "fingerprint")
    sized = rows.withColumn("n_chars", F.length("text"))
    led = with_next(sized, "doc_id", "text", task_bytes, printed, ("fingerprint",))
    changed = led.select(
        "doc_id", "n_chars", "fingerprint", "next_fingerprint",
        edited(F.col("text"), F.col("n_chars"), F.col("next_text")).alias("edited_text"),
    )
    both = with_fingerprint(changed, "edited_text", "edited_fingerprint")
    return both.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_text", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
