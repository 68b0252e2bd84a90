"""Language ID by cross-parsing: suffix automata of labelled text, fewest phrases win.

Each language is represented by one suffix automaton over its labelled words. A text is
cut greedily into the longest pieces that occur in a language's words; the language that
explains it in the fewest phrases per character wins. Words are parsed one by one, so a
worker parses a word once however often it occurs.

Defined results: a NULL text and a text without a letter are ``und`` with score 0, and so is
every text when nothing could be learned. Languages with equal costs: the first in
alphabetical order, score 0. Empty tables give empty results. Repeated rows each get the
same answer. Other columns are passed through; columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.common import schema_of, slices, with_columns

UNDETERMINED = "und"
# The one answer of the model that knows no language.
UNKNOWN = "unknown"
# The classifier is fitted on about so many labelled texts of each language ...
SAMPLE_TEXTS = 600
# ... and the automaton holds their most frequent words, up to so many characters.
AUTOMATON_CHARS = 160_000
# A run of letters without a break is parsed in pieces of at most so many characters.
PIECE_CHARS = 64
# Words that a Python worker remembers before it starts again.
KNOWN_WORDS = 400_000

WORD = re.compile(r"[^\W\d_]+")
EDGE = "_"
ROOT = 0


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``text``."""
    go: list[dict[str, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for ch in text:
        new = len(go)
        go.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ch not in go[p]:
            go[p][ch] = new
            p = link[p]
        if p >= 0:
            q = go[p][ch]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(ch) == q:
                    go[p][ch] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


@dataclass
class Automaton:
    """Transitions as sorted keys, ``state * letters + letter``, and their target states."""

    letters: str
    keys: np.ndarray
    targets: np.ndarray
    bits: float

    @classmethod
    def of(cls, words: list[str]) -> Automaton:
        text = EDGE + EDGE.join(words) + EDGE
        letters = "".join(sorted(set(text)))
        code = {c: i for i, c in enumerate(letters)}
        go = suffix_automaton(text)
        steps = sorted(
            (state * len(letters) + code[c], target)
            for state, out in enumerate(go)
            for c, target in out.items()
        )
        pairs = np.array(steps, dtype=np.int64).reshape(-1, 2)
        # A phrase costs the bits that name a place in the text.
        return cls(letters, pairs[:, 0].copy(), pairs[:, 1].astype(np.int32), float(np.log2(len(text))))

    def phrases(self, points: np.ndarray) -> np.ndarray:
        """Phrases of each row of ``points`` (code points, filled up with -1), read in step."""
        alphabet = np.array([ord(c) for c in self.letters], dtype=np.int64)
        slot = np.searchsorted(alphabet, points)
        slot[slot == len(alphabet)] = 0
        known = alphabet[slot] == points
        count = np.zeros(len(points), dtype=np.int64)
        state = np.full(len(points), ROOT, dtype=np.int64)
        for column in range(points.shape[1]):
            live = np.flatnonzero(points[:, column] >= 0)
            if not len(live):
                break
            letter, is_known = slot[live, column], known[live, column]
            at = state[live]
            for again in (False, True):
                key = at * len(alphabet) + letter
                place = np.searchsorted(self.keys, key)
                place[place == len(self.keys)] = 0
                found = is_known & (self.keys[place] == key)
                if again:
                    break
                # A phrase ends where the text goes on in no known way; the next starts here.
                missed = ~found
                count[live[missed & (at != ROOT)]] += 1
                if not missed.any():
                    break
                at = np.where(missed, ROOT, at)
            state[live] = np.where(found, self.targets[place], ROOT)
            count[live[~is_known]] += 1
        return count + (state != ROOT)


@dataclass
class Model:
    languages: list[str]
    automata: list[Automaton]

    def reader(self) -> Reader:
        """The worker's reader: a reused worker goes on with the words it knows."""
        if not hasattr(self, "_reader"):
            self._reader = Reader(self)
        return self._reader

    def costs(self, words: list[str]) -> np.ndarray:
        """Bits of each word in each language, and its number of characters."""
        out = np.zeros((len(words), len(self.languages) + 1))
        pieces, owner = [], []
        for i, word in enumerate(words):
            if any(c.isalpha() for c in word):
                token = f"{EDGE}{word}{EDGE}"
                out[i, -1] = len(token)
                for start in range(0, len(token), PIECE_CHARS):
                    pieces.append(token[start : start + PIECE_CHARS])
                    owner.append(i)
        order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
        for start in range(0, len(order), 20_000):
            part = order[start : start + 20_000]
            width = len(pieces[part[-1]])
            points = np.full((len(part), width), -1, dtype=np.int64)
            for row, k in enumerate(part):
                points[row, : len(pieces[k])] = np.frombuffer(
                    pieces[k].encode("utf-32-le", "surrogatepass"), dtype="<u4"
                )
            rows = np.array([owner[k] for k in part])
            for column, automaton in enumerate(self.automata):
                np.add.at(out[:, column], rows, automaton.phrases(points) * automaton.bits)
        return out


def letters_only() -> Model:
    """Tells texts with a letter from those without, where no language could be learned."""
    return Model([UNKNOWN], [Automaton.of([])])


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    automaton_chars: int = AUTOMATON_CHARS,
) -> Model:
    """Learn one automaton per label from a bounded sample of distinct labelled texts.

    Texts are drawn by their hash, about ``sample_texts`` of each label's distinct ones, and all of
    a label that has no more; the automaton of
    a label holds its most frequent words up to ``automaton_chars`` characters. Both bounds
    do not depend on the size of the table; the labels themselves are the only rows counted.
    """
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    # Copies are one text here as in the sample: a share of the rows would starve a label of copies.
    texts = F.count_distinct(F.xxhash64(F.lit("sample"), F.col(text)))
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(texts).collect()}
    if not counts:
        return Model([], [])
    shares = F.create_map(
        *[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, sample_texts / n))]
    )
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(text)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.filter(place < shares[F.col(label)]).select(
        F.col(label).alias("label"), F.col(text).alias("text")
    )

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            seen: dict[tuple[str, str], int] = {}
            for name, value in zip(batch.column("label").to_pylist(), texts):
                for word in words_of(value):
                    if len(word) <= PIECE_CHARS:
                        seen[name, word] = seen.get((name, word), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], ["label", "word", "n"])

    words = (
        sample.dropDuplicates(["label", "text"])
        .mapInArrow(spelled, "label string, word string, n bigint")
        .groupBy("label", "word").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("label").orderBy(F.desc("n"), "word")
    used = words.withColumn("used", F.sum(F.length("word") + 1).over(order))
    chosen: dict[str, list[str]] = {}
    fitting = used.filter(F.col("used") < automaton_chars)
    for name, word in fitting.orderBy("label", "used").select("label", "word").collect():
        chosen.setdefault(name, []).append(word)
    names = sorted(chosen)
    return Model(names, [Automaton.of(chosen[name]) for name in names])


class Reader:
    """Predicts batches of texts; remembers the costs of words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.place: dict[str, int] = {}
        self.costs = np.zeros((0, len(model.languages) + 1))

    def learn(self, words: set[str]) -> None:
        new = sorted(words - self.place.keys())
        if len(self.place) + len(new) > KNOWN_WORDS:
            self.place, self.costs = {}, self.costs[:0]
            new = sorted(words)
        if new:
            first = len(self.place)
            self.place.update((w, first + i) for i, w in enumerate(new))
            self.costs = np.concatenate([self.costs, self.model.costs(new)])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        spelled = [words_of(t) for t in texts]
        self.learn(set().union(*spelled))
        place = self.place.__getitem__
        names, scores = [], []
        for words in spelled:
            total = self.costs[np.fromiter(map(place, words), np.int64, len(words))].sum(axis=0)
            bits = total[:-1]
            if not total[-1] or not len(bits):
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            order = np.argsort(bits, kind="stable")
            best = int(order[0])
            names.append(self.model.languages[best])
            scores.append(float(1 - bits[best] / bits[order[1]]) if len(bits) > 1 else 1.0)
        return names, scores


def identify(
    docs: DataFrame, model: Model, text: str = "text", into: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the language whose automaton needs the fewest bits of phrases, and the lead.

    ``score`` is 1 minus the winner's cost over the runner-up's.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(into, score)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch, texts in slices(batches, text):
            names, scores = reader.predict(texts)
            yield with_columns(
                batch, (), **{into: pa.array(names, pa.string()), score: pa.array(scores, pa.float64())}
            )

    return kept.mapInArrow(read, schema_of(kept, (), f"`{into}` string, `{score}` double"))


def remainder(key: str = "doc_id", folds: int = 5) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds))
