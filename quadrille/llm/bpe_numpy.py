"""Byte-pair encoding and decoding in batched numpy merge rounds.

The symbols of many distinct words stand in one flat array. Every round finds each word's
lowest-rank adjacent pair, by binary search over the sorted pair keys, and merges it; a word
is done when none of its pairs has a rank. Texts are then put together from their words.

The tokenizer file is a byte-level BPE of the tokenizers library. Special tokens inside a text
become their ids, as the library does by default; nothing is added, cut or filled up.

Defined results: a NULL text counts as empty and has no ids. Repeated rows each get the same
answer; ties between pairs go to the leftmost. Other columns are passed through; columns named
like the added ones are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quadrille.llm.common import schema_of, slices, with_columns

# Words that a Python worker remembers before it starts again.
KNOWN_WORDS = 400_000
# Bytes of words that are merged in one flat array.
ROUND_BYTES = 1 << 20
NO_RANK = np.int64(1 << 40)

# The word pattern of byte-level BPE (a fixed value).
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A byte-level BPE: ids of texts, texts of ids."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in token) for token, i in vocab.items()
        } | {i: content.encode() for content, i in self.specials.items()}
        self.first = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        self.width = max(self.bytes_of) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # All places of a pair may merge at once unless what it makes has an earlier pair.
        earliest = np.full(self.width, NO_RANK)
        np.minimum.at(earliest, left, np.arange(len(keys)))
        np.minimum.at(earliest, right, np.arange(len(keys)))
        self.at_once = earliest[self.made] > self.ranks
        names = sorted(self.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.known: dict[str, bytes] = {}

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            found = (self.keys[place] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(found, self.ranks[place], NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(lowest, sizes)
            over = best == NO_RANK
            if over.any():
                done.append((owner[over], symbols[over]))
                counts[owner[starts[lowest == NO_RANK]]] = sizes[lowest == NO_RANK]
            at = np.flatnonzero((rank == best) & ~over)
            if not len(at):
                break
            # In a run of overlapping places every other one merges, from the left.
            heads = np.append(True, np.diff(at) > 1)
            run = np.cumsum(heads) - 1
            index = np.arange(len(at)) - np.flatnonzero(heads)[run]
            word_first = np.append(True, owner[at[1:]] != owner[at[:-1]])
            at = at[(index % 2 == 0) & (word_first | self.at_once[place[at]])]
            symbols[at] = self.made[place[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done:
            return np.zeros(0, np.int64), counts
        owners = np.concatenate([d[0] for d in done])
        ids = np.concatenate([d[1] for d in done])
        return ids[np.argsort(owners, kind="stable")], counts

    def learn(self, words: set[str]) -> None:
        new = list(words - self.known.keys())
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {}
            new = list(words)
        start = 0
        while start < len(new):
            part, size = [], 0
            while start < len(new) and (not size or size < ROUND_BYTES):
                part.append(new[start].encode("utf-8", "surrogatepass"))
                size += len(part[-1])
                start += 1
            ids, counts = self.merged(part)
            flat, ends = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
            begin = 0
            for word, end in zip(new[start - len(part) : start], ends.tolist()):
                self.known[word] = flat[begin:end]
                begin = end

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """``text`` cut at special tokens: (is special, part)."""
        if self.special is None or not self.special.search(text):
            return [(False, text)]
        parts, start = [], 0
        for hit in self.special.finditer(text):
            parts += [(False, text[start : hit.start()]), (True, hit.group())]
            start = hit.end()
        return [*parts, (False, text[start:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = []
        for text in texts:
            parts = self.pieces(text)
            cut.append([(s, p if s else PATTERN.findall(p)) for s, p in parts])
        self.learn({w for parts in cut for s, words in parts if not s for w in words})
        ids_of = self.known.__getitem__
        return [
            b"".join(
                self.specials[p].to_bytes(4, "little") if s else b"".join(map(ids_of, p))
                for s, p in parts
            )
            for parts in cut
        ]

    def decode(self, ids: bytes) -> str:
        joined = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined.decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tokenizer of a file, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as an array of integers."""
    kept = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch, texts in slices(batches, text):
            found = [np.frombuffer(b, "<u4").astype(np.int32) for b in bpe.encode(texts)]
            yield with_columns(batch, (), **{ids: pa.array(found, pa.list_(pa.int32()))})

    return kept.mapInArrow(run, schema_of(kept, (), f"`{ids}` array<int>"))


def decode(coded: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``coded`` with the text that its array of ids stands for."""
    kept = coded.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(ids).to_pylist()]
            yield with_columns(batch, (), **{into: pa.array(texts, pa.string())})

    return kept.mapInArrow(run, schema_of(kept, (), f"`{into}` string"))


def token_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with n_tokens and digests of the ids and of the text decoded
    from them: a corpus is checked without moving its ids."""
    added = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = docs.drop(*[c for c in added if c != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch, texts in slices(batches, text):
            coded = bpe.encode(texts)
            back = [bpe.decode(ids).encode("utf-8", "surrogatepass") for ids in coded]
            yield with_columns(
                batch, (text,),
                n_tokens=pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                ids_sha256=pa.array([hashlib.sha256(ids).hexdigest() for ids in coded], pa.string()),
                decoded_sha256=pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
            )

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return kept.mapInArrow(run, schema_of(kept, (text,), schema))
