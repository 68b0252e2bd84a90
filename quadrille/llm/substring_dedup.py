"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A window is ``n`` consecutive words of one document. Every word goes that stands in a window which
also starts in a document with a smaller doc_id; windows are judged on the input. Overlapping
windows merge into maximal removed runs by themselves.

Tasks hash all windows of their texts and send each distinct hash once per chunk of texts, with the
smallest doc_id that has it there, packed by ranges of the hash. A window that every document
has thus arrives once per chunk, not once per document. Each range finds the smallest doc_id of
a hash overall and answers with the (document, hash) pairs that come later, packed by groups of
documents. Documents then cut the words that their hashes cover.

Hashes have 64 bits: at 10^13 windows a window meets a stranger's hash with a chance of 5e-7.

Words are separated by ASCII white space; what is left is joined by one space. Defined results: a
NULL text has no words and stays NULL. ``key`` is an integer; rows with a NULL key come after all
others and, like rows that share a key, never remove each other's words. Repeated rows fare alike.
Empty tables give empty results. Other columns are passed through; columns named like the added
ones are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import free_name, schema_of, slices, with_columns

WINDOW = 13
# Windows that a task packs together, and that a range of hashes should hold.
CHUNK_WINDOWS = 1_000_000
RANGE_WINDOWS = 2_000_000
# Ranges, and groups of documents, are dealt out by a hash, so there are some more of them than tasks.
PLACES_A_TASK = 4
# Bytes of text hashed in one go.
BLOCK_BYTES = 4 << 20
BYTE_BASE, WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LAST = np.iinfo(np.int64).max
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of ``values`` over all bits (one-to-one)."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def _block_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    powers = np.full(int(sizes.max()), BYTE_BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    letters = np.flatnonzero(inside)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    offset = np.arange(len(letters)) - np.repeat(first, sizes)
    terms = (data[letters].astype(np.uint64) + np.uint64(1)) * powers[offset]
    sums = np.add.reduceat(terms, first)
    return mixed(sums + sizes.astype(np.uint64) * WORD_BASE), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of the words of ``data``, and where they start."""
    whole = np.frombuffer(data, dtype=np.uint8)
    found, at, begin = [], [], 0
    while begin < len(whole):
        end = begin + BLOCK_BYTES
        while end < len(whole):
            # A block ends at white space; one without any is read together with the next.
            gap = np.flatnonzero(SPACE[whole[max(begin, end - 4096) : end]])
            if len(gap):
                end = max(begin, end - 4096) + int(gap[-1]) + 1
                break
            end += 4096
        hashes, starts = _block_hashes(whole[begin:end])
        found.append(hashes)
        at.append(starts + begin)
        begin = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(at)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The rolling polynomial of every ``n`` consecutive word hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total = total * WORD_BASE + words[k : k + count]
    return mixed(total)


def slice_windows(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all windows of ``texts`` that lie in one text, and which text that is."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, starts = word_hashes(b" ".join(parts))
    begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    owner = np.searchsorted(begins, starts, side="right") - 1
    windows = window_hashes(hashes, n)
    whole = owner[: len(windows)] == owner[n - 1 : n - 1 + len(windows)]
    return windows[whole], owner[: len(windows)][whole]


def planes(values: np.ndarray) -> bytes:
    """The bytes of 64-bit integers, all lowest bytes first: equal high bytes then compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


def later(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes (sorted) with their smallest document, and the pairs of later documents."""
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else order
    least = np.minimum.reduceat(docs, heads) if len(heads) else docs
    sizes = np.diff(np.append(heads, len(hashes)))
    late = docs > np.repeat(least, sizes)
    return hashes[heads], least, hashes[late], docs[late]


def grouped(hashes: np.ndarray, docs: np.ndarray, groups: int) -> list[tuple[int, bytes, bytes]]:
    """Distinct pairs as a row per group of documents: (group, hashes, documents)."""
    place = docs % groups
    order = np.lexsort((hashes, docs, place))
    hashes, docs, place = hashes[order], docs[order], place[order]
    if not len(docs):
        return []
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])])
    hashes, docs, place = hashes[new], docs[new], place[new]
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])).tolist()
    return [
        (int(place[a]), planes(hashes[a:b]), planes(docs[a:b])) for a, b in zip(heads, [*heads[1:], len(docs)])
    ]


def batch_of(rows: list[tuple], is_answer: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([is_answer] * len(rows), pa.bool_()),
         pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
        ["place", "answer", "hashes", "docs"],
    )


def unpacked(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    hashes = [from_planes(b, np.uint64) for x in batches for b in x.column("hashes").to_pylist()]
    docs = [from_planes(b, np.int64) for x in batches for b in x.column("docs").to_pylist()]
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *docs])


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """(doc, hashes): the window hashes of each document that a document before it has.

    ``doc`` is the key, the largest integer for NULL; there is one row for each.
    """
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(text).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // (6 * RANGE_WINDOWS)))  # a word and its space have six bytes or so
    places = tasks * PLACES_A_TASK

    def packed(hashes: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        distinct, least, late, late_docs = later(np.concatenate(hashes), np.concatenate(owners))
        range_of = ((distinct >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)
        heads = np.flatnonzero(np.concatenate([[True], range_of[1:] != range_of[:-1]])).tolist()
        spans = zip(heads, [*heads[1:], len(distinct)])
        yield batch_of([(int(range_of[a]), planes(distinct[a:b]), planes(least[a:b])) for a, b in spans], False)
        yield batch_of(grouped(late, late_docs, places), True)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, owners, held = [], [], 0
        for batch, texts in slices(batches):
            windows, owner = slice_windows(texts, n)
            if len(windows):
                hashes.append(windows)
                owners.append(np.array(batch.column("doc"))[owner])
                held += len(windows)
            if held >= CHUNK_WINDOWS:
                yield from packed(hashes, owners)
                hashes, owners, held = [], [], 0
        if held:
            yield from packed(hashes, owners)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = []
        for batch in batches:
            is_answer = batch.column("answer")
            yield batch.filter(is_answer)
            asked.append(batch.filter(pc.invert(is_answer)))
        _, _, late, late_docs = later(*unpacked(asked))
        yield batch_of(grouped(late, late_docs, places), True)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, owners = unpacked(list(batches))
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
        heads = np.flatnonzero(np.diff(owners, prepend=-1 if not len(owners) else owners[0] - 1)).tolist()
        flat = hashes.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(owners[heads], pa.int64()),
             pa.array([flat[a * 8 : b * 8] for a, b in zip(heads, [*heads[1:], len(owners)])], pa.binary())],
            ["doc", "hashes"],
        )

    packing = "place bigint, answer boolean, hashes binary, docs binary"
    answers = rows.mapInArrow(hashed, packing).repartition(tasks, "place").mapInArrow(compared, packing)
    return answers.select("place", "hashes", "docs").repartition(tasks, "place").mapInArrow(
        merged, "doc bigint, hashes binary"
    )


def kept_words(words: list[bytes], windows: np.ndarray, gone: np.ndarray, n: int) -> list[bytes]:
    """``words`` without those in a window whose hash is in ``gone``."""
    hit = np.flatnonzero(np.isin(windows, gone))
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + n, -1)
    return list(itertools.compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def dedup_substrings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WINDOW,
    n_words: str = "n_words", n_removed: str = "n_removed",
) -> DataFrame:
    """``docs`` with the words that remain in ``text``, and how many it had and lost."""
    kept = docs.drop(*[c for c in (n_words, n_removed) if c not in (key, text)])
    doc, gone = free_name(docs, "__doc"), free_name(docs, "__gone")
    per_doc = repeated_windows(docs, key, text, n)
    marked = kept.withColumn(doc, F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)))
    per_doc = per_doc.withColumnsRenamed({"doc": doc, "hashes": gone})
    joined = marked.join(per_doc, doc, "left").select(*kept.columns, gone)
    at = kept.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            present = batch.column(text).is_valid().to_pylist()
            out, had, lost = [], [], []
            for value, is_text, found in zip(texts, present, batch.column(gone).to_pylist()):
                words = value.encode("utf-8", "surrogatepass").split()
                left = words
                if found and len(words) >= n:
                    windows, _ = slice_windows([value], n)
                    left = kept_words(words, windows, np.frombuffer(found, np.uint64), n)
                had.append(len(words))
                lost.append(len(words) - len(left))
                out.append(b" ".join(left).decode("utf-8", "surrogatepass") if is_text else None)
            bare = with_columns(batch, (gone,)).set_column(at, text, pa.array(out, pa.string()))
            yield with_columns(
                bare, (), **{n_words: pa.array(had, pa.int64()), n_removed: pa.array(lost, pa.int64())}
            )

    return joined.mapInArrow(cut, schema_of(kept, (), f"`{n_words}` bigint, `{n_removed}` bigint"))
