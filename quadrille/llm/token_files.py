"""Token ids as flat binary files: one id after the other, 64-bit document offsets, memory-mapped.

A folder of token files holds, per part, ``.bin`` (the ids, little-endian, 16 bits where the
vocabulary allows it, else 32), ``.idx`` (64-bit places where documents begin, and the end) and
``.keys`` (the documents' keys, an Arrow file), and ``manifest.json``, which lists the parts. Parts
follow each other in ascending order of the key; a part's base, the ids and documents before it,
is the prefix sum over the parts, so any document or range of ids is found from one row of the
manifest and two offsets.

Writing: a range shuffle by (key, text hash, row number) lays the texts in order, however many rows
share a key; each task encodes its texts and streams them into one part, under a name of its own
attempt that is changed in the end, so a task that is run again replaces the files with equal ones. The
driver sees one row per part, of which there are at most ``MAX_PARTS``. Files lie in a folder that all
executors reach, the application's checkpoint folder by default. Reading: a task maps one part and
slices it; nothing is moved.

Encoding: a word of the byte-level pattern starts at every space between other characters, so texts are cut there. Arrow
finds the different chunks of many texts, the library encodes each of them once, many in one text, and their ids are laid out by
the chunks' numbers. Tokenizer files with another way to cut, a normalizer, a model other than BPE or added tokens that take white
space along are given whole texts.

Defined results: a NULL text is empty; every document ends with ``end_id``, if one is given. NULL
keys come first; rows that share a key follow each other by the hash of their texts; equal rows
are written as often as they occur. An empty table gives a folder without parts. Other columns are
not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.bpe_numpy import byte_letters
from quadrille.llm.common import slices, staged, text_key
from quadrille.session import use_checkpoint_dir

# Bytes of text that a part should have, and how many parts there may be; then parts grow.
PART_BYTES, MAX_PARTS = 24 << 20, 100_000
# Documents or ids that a reading task works on at a time.
READ_DOCS, READ_TOKENS = 20_000, 2_000_000
# Long texts are cut about every so many characters; a round takes so many together.
LONG, ROUND = 1 << 20, 8 << 20
# Different chunks that the library is given in one call, and in one text.
KNOWN_WORDS, JOINED = 20_000, 50
# Where a long text may be cut: the byte-level pattern starts a word there.
CUT = re.compile(r"(?<=\S) (?=\S)")
# In RE2, all that Python calls white space; texts with a space that is no place to cut; chunks with
# a space or with white space at the end.
WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
ODD, ALONE = rf"{WHITE} | {WHITE}| \z", rf" |{WHITE}\z"

_LOADED: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer of a file, without truncation and padding, giving ids as packed integers."""

    def __init__(self, path: str):
        # Spark's tasks are the parallelism.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = 1 + max(self.library.get_vocab(with_added_tokens=True).values())
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        spec = json.loads(self.library.to_str())
        way, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        byte_level = way.get("type") == "ByteLevel" and not way.get("add_prefix_space") and way.get("use_regex", True)
        space, letters = next(c for c, byte in byte_letters().items() if byte == 32), set(byte_letters())
        plain = all(
            not t["lstrip"] and not t["rstrip"] and not t["single_word"] and " " not in t["content"] and t["content"][:1] != space
            for t in added
        )
        vocab = self.library.get_vocab(with_added_tokens=False)
        model = spec["model"].get("type") == "BPE" and not spec["model"].get("continuing_subword_prefix")
        self.by_words = byte_level and plain and spec["normalizer"] is None and model and letters <= vocab.keys()
        # The ids that begin with a space: each is the first of a word.
        self.spaced = np.zeros(size, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith(space)]] = True

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        if not self.by_words:
            yield from (ids.tobytes() for ids in self._ids(texts))
            return
        cut = [list(pieces(text)) for text in texts]
        coded = self._coded(chain.from_iterable(cut))
        for parts in cut:
            yield b"".join(islice(coded, len(parts)))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, by the library."""
        return [np.array(c.ids, self.kind) for c in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _coded(self, parts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each part, worked out for about ``ROUND`` characters at a time."""
        these, size = [], 0
        for part in parts:
            if these and size + len(part) > ROUND:
                yield from self._together(these)
                these, size = [], 0
            these.append(part)
            size += len(part)
        if these:
            yield from self._together(these)

    def _together(self, parts: list[str]) -> Iterator[bytes]:
        """The ids of each part; what stands between two places to cut is encoded once, however often it comes."""
        values, begins, odd = _chunks(parts)
        heads = np.zeros(len(values), bool)
        heads[begins[:-1]] = True
        apart = values.filter(pa.array(heads)).to_pylist()
        coded = values.dictionary_encode()
        chunks, codes = coded.dictionary, coded.indices.to_numpy()
        del values, coded
        # The first chunk of a part has no space before it and is encoded by itself.
        used = np.zeros(len(chunks), bool)
        used[codes[~heads]] = True
        alone = used & pc.match_substring_regex(chunks, ALONE).to_numpy(zero_copy_only=False)
        tight = used & ~alone
        ids, sizes = self._tight(chunks.filter(pa.array(tight)))
        found = self._ids([f" {c}" for c in chunks.filter(pa.array(alone)).to_pylist()] + apart)
        places = np.cumsum(np.concatenate([[0], sizes, [len(f) for f in found]]), dtype=np.int64)
        table = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.concatenate([*ids, *found])))
        place = np.where(alone, len(sizes) + np.cumsum(alone), np.cumsum(tight)).astype(np.int32) - 1
        rows = place[codes]
        rows[heads] = np.arange(len(table) - len(parts), len(table))
        del chunks, codes
        laid = table.take(pa.array(rows))
        flat, cuts = memoryview(laid.values.to_numpy()).cast("B"), laid.offsets.to_numpy()[begins].astype(np.int64) * self.kind.itemsize
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        return (bytes(flat[a:b]) for a, b in zip(cuts[order].tolist(), cuts[order + 1].tolist()))

    def _tight(self, chunks: pa.StringArray) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of all chunks, each with a space before it, and how many every chunk has. Many are one
        text for the library: chunks hold no space, so an id that begins with one begins a chunk."""
        ids, sizes = [], [np.zeros(0, np.int64)]
        for at in range(0, len(chunks), KNOWN_WORDS):
            some = chunks.slice(at, KNOWN_WORDS)
            lists = pa.ListArray.from_arrays([*range(0, len(some), JOINED), len(some)], some)
            flat = np.concatenate(self._ids([f" {text}" for text in pc.binary_join(lists, " ").to_pylist()]))
            first = np.flatnonzero(self.spaced[flat])
            if len(first) != len(some):
                raise ValueError(f"{len(first)} words begin with a space, not {len(some)}")
            ids.append(flat)
            sizes.append(np.diff(np.append(first, len(flat))))
        return ids, np.concatenate(sizes)


def _chunks(parts: list[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The chunks of all parts, those of odd parts last; where a part's begin, and the end; which parts are odd."""
    texts = pa.array(parts, pa.string())
    odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
    even = pc.split_pattern(texts.filter(pa.array(~odd)) if odd.any() else texts, " ")
    if not odd.any():
        return even.values, even.offsets.to_numpy(), odd
    others = [CUT.split(parts[i]) for i in np.flatnonzero(odd)]
    values = pa.concat_arrays([even.values, pa.array(chain.from_iterable(others), pa.string())])
    ends = len(even.values) + np.cumsum([len(c) for c in others], dtype=np.int64)
    return values, np.concatenate([even.offsets.to_numpy(), ends]), odd


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """``text`` cut at spaces where words begin, about every ``long`` characters."""
    start = 0
    while len(text) - start > long:
        hit = CUT.search(text, start + long)
        if not hit:
            break
        yield text[start : hit.start()]
        start = hit.start()
    yield text[start:]


def at(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a path or URI."""
    scheme, colon, rest = folder.partition(":")
    if not colon:
        return fs.LocalFileSystem(), folder
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _part(path: str, number: int, kind: str) -> str:
    return f"{path}/part-{number:06d}.{kind}"


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, path_of: str, end_id: int | None) -> tuple[int, int, int] | None:
    """Encode ordered (key, text) into the files of this task's part."""
    store, path = at(folder)
    code = encoder(path_of)
    size, last = code.kind.itemsize, b"" if end_id is None else np.array([end_id], code.kind).tobytes()
    number, attempt = TaskContext.get().partitionId(), f"tmp{uuid.uuid4().hex}"
    names = {kind: _part(path, number, kind) for kind in ("bin", "idx", "keys")}
    offsets, open_files, keys = [np.zeros(1, "<u8")], {}, None
    for batch, texts in slices(batches, chars=ROUND):
        if not open_files:
            open_files = {k: store.open_output_stream(f"{n}.{attempt}") for k, n in names.items()}
            keys = pa.ipc.new_file(open_files["keys"], pa.schema([pa.field("key", batch.column("key").type)]))
        sizes = []
        for ids in code.encode(texts):
            open_files["bin"].write(ids + last)
            sizes.append((len(ids) + len(last)) // size)
        offsets.append(offsets[-1][-1] + np.cumsum(sizes, dtype=np.int64).astype("<u8"))
        keys.write_batch(pa.RecordBatch.from_arrays([batch.column("key")], ["key"]))
        pa.default_memory_pool().release_unused()
    if not open_files:
        return None
    places = np.concatenate(offsets)
    open_files["idx"].write(places.tobytes())
    keys.close()
    for stream in open_files.values():
        stream.close()
    for name in names.values():
        store.move(f"{name}.{attempt}", name)
    return number, len(places) - 1, int(places[-1])


def write_tokens(
    docs: DataFrame, path: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
    end_id: int | None = None, part_bytes: int = PART_BYTES,
) -> str:
    """Encode ``docs`` with the tokenizer file ``path`` into a folder of token files; returns it."""
    spark = docs.sparkSession
    if folder is None:
        use_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    rows = docs.select(
        F.col(key).alias("key"), text_key(text).alias("tie"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = min(max(1, -(-total // part_bytes)), MAX_PARTS)
    order = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("row")]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    store, where = at(folder)
    store.create_dir(where, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _write_part(batches, folder, path, end_id)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in made], ["part", "docs", "tokens"])

    written = staged(laid.select("key", "text").mapInArrow(run, "part bigint, docs bigint, tokens bigint"))
    made = [[r["part"], r["docs"], r["tokens"]] for r in written.orderBy("part").collect()]  # one row per file
    key_type = rows.schema["key"].dataType.simpleString()
    about = {"dtype": encoder(path).kind.str, "key": key_type, "end_id": end_id, "parts": made}
    with store.open_output_stream(f"{where}/manifest.json") as out:
        out.write(json.dumps(about).encode())
    return folder


def manifest(folder: str) -> dict:
    """What a folder holds, with the documents and ids before each part."""
    store, where = at(folder)
    with store.open_input_stream(f"{where}/manifest.json") as source:
        about = json.loads(source.read())
    before = [0, *accumulate(tokens for _, _, tokens in about["parts"])]
    docs_before = [0, *accumulate(docs for _, docs, _ in about["parts"])]
    return about | {"token_base": before, "doc_base": docs_before}


def mapped(store: fs.FileSystem, path: str) -> pa.NativeFile:
    """A file mapped into memory where the store is a disk, else opened for reads at any place."""
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def read_ids(folder: str, start: int, stop: int) -> np.ndarray:
    """The ids from global place ``start`` to ``stop``, across documents and parts."""
    about = manifest(folder)
    store, where = at(folder)
    kind, found = np.dtype(about["dtype"]), []
    for (number, _, tokens), base in zip(about["parts"], about["token_base"]):
        low, high = max(start, base), min(stop, base + tokens)
        if low < high:
            with mapped(store, _part(where, number, "bin")) as ids:
                found.append(np.frombuffer(ids.read_at((high - low) * kind.itemsize, (low - base) * kind.itemsize), kind))
    return np.concatenate(found) if found else np.zeros(0, kind)


def _documents(folder: str, about: dict, index: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(keys, global starts and the end, ids) of runs of documents of one part."""
    store, where = at(folder)
    number = about["parts"][index][0]
    base, kind = about["token_base"][index], np.dtype(about["dtype"])
    with (
        mapped(store, _part(where, number, "bin")) as ids, mapped(store, _part(where, number, "idx")) as idx,
        pa.ipc.open_file(mapped(store, _part(where, number, "keys"))) as keys,
    ):
        first = 0
        for b in range(keys.num_record_batches):
            column = keys.get_batch(b).column(0)
            places = np.frombuffer(idx.read_at((len(column) + 1) * 8, first * 8), "<u8").astype(np.int64)
            low = 0
            while low < len(column):
                high = int(np.searchsorted(places, places[low] + READ_TOKENS, "right")) - 1
                high = min(max(high, low + 1), low + READ_DOCS, len(column))
                run = places[low : high + 1]
                got = ids.read_at(int(run[-1] - run[0]) * kind.itemsize, int(run[0]) * kind.itemsize)
                yield column.slice(low, high - low), run + base, np.frombuffer(got, kind)
                low = high
            first += len(column)


def _read(spark: SparkSession, folder: str, columns: str, of) -> DataFrame:
    """A row per document of a folder, in one task per part; ``of`` makes the columns of a run."""
    about = manifest(folder)
    schema = f"key {about['key']}, {columns}"
    if not about["parts"]:
        return spark.createDataFrame([], schema)
    names = ["key", *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in batch.column(0).to_pylist():
                for keys, places, ids in _documents(folder, about, index):
                    yield pa.RecordBatch.from_arrays([keys, *of(places, ids)], names)

    return spark.range(0, len(about["parts"]), 1, len(about["parts"])).mapInArrow(run, schema)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, ids) of every document of a folder."""

    def of(places: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        offsets = pa.array((places - places[0]).astype(np.int32))
        return [pa.array(places[:-1]), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))]

    return _read(spark, folder, "start bigint, ids array<int>", of)


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of a folder, the checksum over 32-bit ids."""

    def of(places: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        wide, cut = memoryview(ids.astype("<u4").tobytes()), ((places - places[0]) * 4).tolist()
        sums = [zlib.crc32(wide[a:b]) for a, b in zip(cut, cut[1:])]
        return [pa.array(places[:-1]), pa.array(np.diff(places)), pa.array(sums, pa.int64())]

    return _read(spark, folder, "start bigint, n_tokens bigint, ids_crc32 bigint", of)
