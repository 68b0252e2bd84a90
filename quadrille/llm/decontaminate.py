"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over token windows.

All of it is DataFrame functions. Benchmark items become windows of n words, hashed; documents
become the hashes of all their windows, met with the broadcast set; a hit is verified word by
word. The set is broadcast only after its size was counted and found within ``broadcast_bytes``;
beyond that the windows are joined by a shuffle, and only verified in documents with hits.

Words are runs of a-z, 0-9 and non-ASCII characters, after lower-casing A-Z. An item of fewer
than n words is one window of its own length.

Defined results: a NULL or wordless text has no words and no hits, and is not contaminated. NULL
or wordless items match nothing. Items with equal windows all count. Repeated rows each get the
same answer; rows that share a doc_id but not the text are told apart. Empty tables give empty
results, and an empty benchmark no hits. Other columns are passed through by ``clean_documents``
and ``without_spans``, and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import null_safe, staged, text_key

WINDOW = 13
# A document is contaminated when 1 word in so many is hit.
ONE_IN = 20
# Windows of a text that go together: a window's row carries the words of its block, never the text's.
BLOCK = 32
# The hash set is broadcast up to this size.
BROADCAST_BYTES = 64 << 20
# The letters that are lower-cased, and what stands between words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before lower-casing.
RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, BETWEEN), lambda w: w != "")


def window_hashes(words: Column, size: Column, n: int) -> Column:
    """The hash of every window of ``n`` words; none where there are fewer words."""
    starts = F.sequence(F.lit(1), size - n + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(size >= n, hashes).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """(hash, n, window, items): each distinct window of the benchmark and the items that have it."""
    items = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words"))
    sized = items.select("item", "words", F.size("words").alias("size")).filter("size > 0")
    cut = sized.select("item", "words", F.least("size", F.lit(n)).alias("n"), F.size("words").alias("size"))
    each = cut.select("item", "n", "words", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    windows = each.select("item", "n", F.slice("words", F.col("at"), F.col("n")).alias("window"))
    return windows.groupBy("n", "window").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("window").alias("hash"), "n", "window", "items"
    )


def _scanned(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """Every window's hash ``h`` with its place ``at`` in the text, and ``within`` the words of its
    ``block``; a row with at = 0 stands for the document itself, so that one without windows keeps a row.

    The text is cut into blocks of BLOCK windows first, so the work is linear in its length.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), text_key(text).alias("text_key"), words_of(F.col(text)).alias("words")
    )
    sized = rows.select("doc_id", "text_key", "words", F.size("words").alias("n_words"))
    last = F.greatest(F.floor((F.col("n_words") - n) / BLOCK), F.lit(0)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice("words", b * BLOCK + 1, BLOCK + n - 1))
    blocks = sized.select("doc_id", "text_key", "n_words", F.posexplode(cut).alias("b", "block"))
    hashes = window_hashes(F.col("block"), F.size("block"), n)
    own = F.array(F.lit(None).cast("bigint"))
    each = blocks.select(
        "doc_id", "text_key", "n_words", "b", "block",
        F.posexplode(F.when(F.col("b") == 0, F.concat(own, hashes)).otherwise(hashes)).alias("i", "h"),
    )
    # Only the first block has an entry for the document.
    within = F.when(F.col("b") == 0, F.col("i")).otherwise(F.col("i") + 1)
    return each.select(
        "doc_id", "text_key", "n_words", "block", "h", within.alias("within"), (F.col("b") * BLOCK + within).alias("at")
    )


def _hits(docs: DataFrame, grams: DataFrame, n: int, key: str, text: str, small: bool) -> DataFrame:
    """(doc_id, text_key, n_words, at, n, items): a row with at = 0 for every document, and one for
    every verified window, at its first word."""
    each = _scanned(docs, n, key, text)
    verified = F.slice(F.col("block"), F.col("within"), n) == F.col("window")
    set_of = grams.filter(F.col("n") == n)
    if small:
        met = each.join(F.broadcast(set_of), F.col("h") == F.col("hash"), "left")
        return met.filter((F.col("at") == 0) | (F.col("hash").isNotNull() & verified)).select(
            "doc_id", "text_key", "n_words", "at", F.lit(n).alias("n"), "items"
        )
    narrow = each.drop("block", "within")
    hits = staged(narrow.join(set_of.select("hash"), F.col("h") == F.col("hash"), "left_semi"))
    within = hits.select("doc_id", "text_key").distinct()
    hit_docs = docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    again = _scanned(null_safe(hit_docs, within, ["doc_id", "text_key"], "left_semi"), n, "doc_id", "text")
    # Only windows whose hash was met go on with their words.
    placed = again.filter("at > 0").select(
        "doc_id", "text_key", "n_words", "at", "h", F.slice(F.col("block"), F.col("within"), n).alias("own")
    )
    met = placed.join(set_of, (F.col("h") == F.col("hash")) & (F.col("own") == F.col("window")))
    lines = narrow.filter("at = 0").select(
        "doc_id", "text_key", "n_words", "at", F.lit(n).alias("n"),
        F.lit(None).cast(grams.schema["items"].dataType).alias("items"),
    )
    return lines.unionByName(met.select("doc_id", "text_key", "n_words", "at", F.lit(n).alias("n"), "items"))


def covered(hits: Column) -> Column:
    """Words inside the union of ``hits``, structs of (at, n) in order of ``at``."""
    start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("end"))

    def add(done: Column, hit: Column) -> Column:
        last = hit["at"] + hit["n"] - 1
        new = F.greatest(last - F.greatest(done["end"], hit["at"] - 1), F.lit(0))
        return F.struct((done["words"] + new).alias("words"), F.greatest(done["end"], last).alias("end"))

    return F.aggregate(hits, start, add, lambda done: done["words"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", n: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, hits, items, contaminated) of every row of ``docs``.

    ``hits`` lists the verified windows as (at, n), ``items`` the items they occur in.
    """
    grams = staged(benchmark_windows(benchmark, item, item_text, n))
    sizes = grams.groupBy("n").agg(
        F.sum(F.length(F.concat_ws(" ", "window")) + 24 * F.size("items") + 64).alias("bytes")
    ).collect()  # at most n rows
    small = sum(r["bytes"] for r in sizes) <= broadcast_bytes
    found = _hits(docs, grams, n, key, text, small)
    for length in sorted(r["n"] for r in sizes if r["n"] != n):
        found = found.unionByName(_hits(docs, grams, length, key, text, small).filter("at > 0"))
    place = F.struct("at", "n")
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count(F.when(F.col("at") == 0, 1)).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("at") > 0, place))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    judged = per_doc.withColumn("n_hit", covered(F.col("hits")))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))
    return judged.withColumn("contaminated", bad).select(
        "doc_id", "text_key", "n_words", "n_hit", "hits", "items", "contaminated",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = contamination(docs, benchmark, key, text, **how).filter("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")
    ).distinct()
    same = docs[key].eqNullSafe(F.col("__id")) & (text_key(text) == F.col("__key"))
    return docs.join(bad, same, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with every hit span cut out of its text, words and what stands between them."""
    hit = contamination(docs, benchmark, key, text, **how).filter("n_hit > 0").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("hits").alias("__hits")
    ).dropDuplicates(["__id", "__key"])
    same = docs[key].eqNullSafe(F.col("__id")) & (text_key(text) == F.col("__key"))
    met = docs.join(hit, same, "left")
    # Each word with what follows it; an entry in front holds what comes before the first word.
    parts = F.regexp_extract_all(F.col(text), F.lit(f"[^{RAW}]+[{RAW}]*"), F.lit(0))
    lead = F.regexp_extract(F.col(text), f"^[{RAW}]*", 0)
    gone = lambda i: F.exists("__hits", lambda h: (i + 1 >= h["at"]) & (i + 1 < h["at"] + h["n"]))
    kept = F.concat(lead, F.array_join(F.filter(parts, lambda p, i: ~gone(i)), ""))
    return met.withColumn(text, F.when(F.col("__hits").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
