"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

A word's symbols form a linked list; a heap holds its adjacent pairs by rank. The lowest-rank
pair is popped again and again, and merged if both its symbols are still there. The number of
tokens is the number of initial symbols minus the merges; a character that is no piece and
that nothing took in counts once per UTF-8 byte.

The model file is a BPE of the sentencepiece library. White space becomes the model's mark and
a text gets one mark in front. No piece has a mark after another character (checked when the
model is loaded, else a text is one word), so words are counted one by one and remembered.

Defined results: a NULL or empty text has no tokens. Equal ranks merge from the left. Repeated
rows each get the same answer. Other columns are passed through; columns named like the added
ones are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from quadrille.llm.common import schema_of, slices, with_columns

MARK = "▁"
# Words that a Python worker remembers before it starts again.
KNOWN_WORDS = 500_000
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Counter:
    """Counts the tokens that a sentencepiece BPE model gives."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        # The earliest pieces have the highest scores; ranks start with them.
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.rank)
        self.known: dict[str, int] = {}

    def tokens(self, word: str) -> int:
        """Initial symbols minus merges, of one word."""
        rank = self.rank
        symbols = list(word)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if symbols[i] else n
            if j >= n or len(symbols[i]) + len(symbols[j]) != len(pair) or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            merges += 1
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n:
                    pair = symbols[left] + symbols[right]
                    if pair in rank:
                        heapq.heappush(heap, (rank[pair], left, pair))
        extra = sum(len(s.encode("utf-8", "surrogatepass")) - 1 for s in symbols if len(s) == 1 and s not in rank)
        return n - merges + extra

    def count(self, texts: list[str]) -> list[int]:
        marked = [(MARK + t.replace(" ", MARK)) if t else "" for t in texts]
        split = [WORD.findall(t) if self.splits else [t] * bool(t) for t in marked]
        words = set().union(*split)
        new = words - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, words
        for word in new:
            self.known[word] = self.tokens(word)
        of = self.known.__getitem__
        return [sum(map(of, words)) for words in split]


_LOADED: dict[str, Counter] = {}


def load(path: str) -> Counter:
    """The counter of a model file, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens", size: str = "n_bytes"
) -> DataFrame:
    """``docs`` without ``text``, with the UTF-8 bytes and the tokens of each text."""
    kept = docs.drop(*[c for c in (into, size) if c != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch, texts in slices(batches, text):
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield with_columns(
                batch, (text,),
                **{size: pa.array(sizes, pa.int64()), into: pa.array(counter.count(texts), pa.int64())},
            )

    return kept.mapInArrow(run, schema_of(kept, (text,), f"`{size}` bigint, `{into}` bigint"))
