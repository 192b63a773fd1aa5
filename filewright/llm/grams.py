"""Counts of byte sequences within words or whole texts, for models of several classes.

A word is a run without white space; it is modelled with a space before and after it, and its contexts never reach
further back than the space before. A whole text is its words, one space apart, and contexts reach across the spaces. A gram of k bytes is packed exactly into 64 bits (k, then the bytes), so counts
don't collide. Counting takes every word of every row: Python counts the words of a partition, breaks the distinct
ones into grams and sums those; Spark adds the partitions up. A model holds every gram, rare ones as well: it grows
with the distinct grams of the input.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filewright.llm.common import release_worker_state

#: A longer run of bytes is cut into pieces of this length.
PIECE = 4096
#: A partition breaks its words into grams whenever it holds so many distinct ones.
FLUSH_WORDS = 200_000
_TAG = 56


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, in pieces of at most PIECE bytes."""
    words = (text or "").lower().encode().split()
    if any(len(w) > PIECE for w in words):
        words = [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def packed(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, each with a space before and one after, on one line of bytes.

    Returns the bytes, the index of the word at each, and each byte's distance from its word's first space.
    """
    line = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    return line, word, np.arange(len(line)) - starts[word]


def keys(line: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1 to ``order``: the packed gram of k bytes that ends at each byte, 0 where it would leave the word."""
    body, out = line.astype(np.int64), []
    rolled = body
    for k in range(1, order + 1):
        if k > 1:
            rolled = rolled.copy()
            rolled[k - 1 :] += body[: -(k - 1)] << (8 * (k - 1))
        out.append(np.where(at >= k - 1, rolled | (k << _TAG), 0))
    return out


def summed(grams: np.ndarray, weight: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams, ascending, and the sums of their weights; ``row`` says which row of ``weight`` is a gram's."""
    order = np.argsort(grams)
    ordered = grams[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    sums = np.stack([np.add.reduceat(weight[:, c][row[order]], first) for c in range(weight.shape[1])], 1) if len(first) else np.zeros((0, weight.shape[1]), np.int64)
    return ordered[first], sums


def count(rows: DataFrame, n_classes: int, order: int, label: str = "label", text: str = "text") -> DataFrame:
    """(gram, n0, n1, ...): how often each gram occurs in the texts of each class (``label``: 0, 1, ...)."""

    def broken(counters):
        words = list(set().union(*counters))
        if not words:
            return
        weight = np.zeros((len(words), n_classes), np.int64)
        for c, counter in enumerate(counters):
            weight[:, c] = np.fromiter(map(counter.__getitem__, words), np.int64, len(words))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(words), 20_000):
            line, word, pos = packed(words[at : at + 20_000], order)
            longest = np.zeros(len(line), np.int64)  # the gram of each byte that reaches back furthest
            for gram in keys(line, pos, order):
                longest = np.where(gram > 0, gram, longest)
            held.append(summed(longest, weight[at : at + 20_000], word))
        yield from _with_ends(held, order)

    def run(batches):
        release_worker_state()
        counters = [Counter() for _ in range(n_classes)]
        for batch in batches:
            for c, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counters[c].update(words_of(value))
            if sum(map(len, counters)) > FLUSH_WORDS:
                yield from broken(counters)
                counters = [Counter() for _ in range(n_classes)]
        yield from broken(counters)

    return _added_up(rows.select(F.col(label).cast("int"), F.col(text).cast("string")), run, n_classes)


def _with_ends(held: list[tuple[np.ndarray, np.ndarray]], order: int):
    """Batches of the grams in ``held`` (the longest of each byte, and their weights) and of all that they end in."""
    weight = np.concatenate([n for _, n in held])
    found, weight = summed(np.concatenate([g for g, _ in held]), weight, np.arange(len(weight)))
    held.clear()
    names = ["gram", *(f"n{c}" for c in range(weight.shape[1]))]
    for k in range(1, order + 1):
        there = np.flatnonzero(found >> _TAG >= k)
        grams, sums = summed(found[there] & ((np.int64(1) << (8 * k)) - 1) | (k << _TAG), weight, there)
        for at in range(0, len(grams), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(grams[at : at + 50_000]), *(pa.array(c[at : at + 50_000]) for c in sums.T)], names=names)


def _added_up(rows: DataFrame, run, n_classes: int) -> DataFrame:
    parts = rows.mapInArrow(run, "gram long, " + ", ".join(f"n{c} long" for c in range(n_classes)))
    return parts.groupBy("gram").agg(*(F.sum(f"n{c}").alias(f"n{c}") for c in range(n_classes)))


def line_of(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts on one line of bytes: lower-cased, a space for each run of white space, one before and one after each text.

    Returns the bytes, each byte's distance from the start of its text (``order`` at most), and the words of each text.
    A text without words has no bytes.
    """
    words = [(t or "").lower().encode().split() for t in texts]
    line = np.frombuffer(b"".join(b" " + b" ".join(w) + b" " for w in words if w), np.uint8)
    sizes = np.array([sum(map(len, w)) + len(w) + 1 for w in words if w], np.int64)
    at = np.full(len(line), order, np.uint8)
    starts = np.cumsum(sizes) - sizes
    for k in range(order):  # a text with words has three bytes at least
        there = starts[sizes > k] + k
        at[there] = k
    return line, at, np.array([len(w) for w in words], np.int64)


def longest_keys(line: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The longest gram, of ``order`` bytes at most, that ends at each byte and doesn't leave its text."""
    out = np.zeros(len(line), np.int64)
    body = line.astype(np.int64)
    rolled = body.copy()
    for k in range(1, order + 1):
        if k > 1:
            rolled[k - 1 :] += body[: -(k - 1)] << (8 * (k - 1))
        there = at >= k - 1
        out[there] = rolled[there] | (k << _TAG)
    return out


def pieces(line: np.ndarray, at: np.ndarray, order: int, size: int = 1 << 19):
    """(begin, end, longest keys) of a line, a bounded piece at a time."""
    for begin in range(0, len(line), size):
        end, back = min(len(line), begin + size), max(0, begin - order)
        yield begin, end, longest_keys(line[back:end], at[back:end], order)[begin - back :]


def count_texts(rows: DataFrame, n_classes: int, order: int, label: str = "label", text: str = "text", flush: int = 1 << 22) -> DataFrame:
    """As ``count``, but of whole texts as ``line_of`` writes them: grams cross the space between words."""

    def run(batches):
        release_worker_state()
        held, size = [], 0
        for batch in batches:
            labels, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for c in range(n_classes):
                line, at, _ = line_of([texts[i] for i in np.flatnonzero(labels == c)], order)
                for begin, end, longest in pieces(line, at, order):
                    found, n = np.unique(longest, return_counts=True)
                    weight = np.zeros((len(found), n_classes), np.int64)
                    weight[:, c] = n
                    held.append((found, weight))
                    size += len(found)
            if size > flush // 8:
                yield from _with_ends(held, order)
                held, size = [], 0
        if held:
            yield from _with_ends(held, order)

    return _added_up(rows.select(F.col(label).cast("int"), F.col(text).cast("string")), run, n_classes)


def collect(counts: DataFrame, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams, ascending, and their counts (grams x classes): all of them."""
    table = counts.toArrow()
    grams = table.column("gram").to_numpy().astype(np.int64)
    order = np.argsort(grams)
    n = np.empty((len(grams), n_classes))
    for c in range(n_classes):
        n[:, c] = table.column(f"n{c}").to_numpy()[order]
    return grams[order], n


class Tree:
    """The grams of a model by their keys, with the row of each one's context and suffix."""

    def __init__(self, grams: np.ndarray, order: int):
        self.grams, self.order = grams, order
        size = grams >> _TAG
        body = grams & ((1 << _TAG) - 1)
        self.size = size
        shorter = (size - 1) << _TAG
        self.context = np.where(size > 1, self.rows(shorter | (body >> 8)), -1)
        self.suffix = np.where(size > 1, self.rows(shorter | (body & ((np.int64(1) << (8 * (size - 1))) - 1))), -1)
        self.starts = (body >> (8 * (size - 1))) == 32  # whether it begins with the space before a word

    def keys_only(self) -> Tree:
        """The tree without its pointers, for scoring."""
        if not hasattr(self, "bare"):
            self.bare = object.__new__(Tree)
            self.bare.grams, self.bare.order = self.grams, self.order
        return self.bare

    def rows(self, wanted: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for those that are none of the grams."""
        if not len(self.grams):
            return np.full(len(wanted), -1, np.int64)
        at = np.minimum(np.searchsorted(self.grams, wanted), len(self.grams) - 1)
        return np.where(self.grams[at] == wanted, at, -1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """``rows`` by a table of hashes, which a worker makes for itself: far fewer steps than a binary search."""
        if not hasattr(self, "slots"):
            self.slots, self.shift = _slots(self.grams)
        at, size = _slot(wanted, self.shift), np.int64(len(self.slots) - 1)
        got = self.slots[at]
        out = np.where((got >= 0) & (self.grams[got] == wanted), got, -1) if len(self.grams) else np.full(len(wanted), -1, np.int32)
        left = np.flatnonzero((got >= 0) & (out < 0))
        while len(left):
            at[left] = (at[left] + 1) & size
            got = self.slots[at[left]]
            hit = (got >= 0) & (self.grams[got] == wanted[left])
            out[left[hit]] = got[hit]
            left = left[(got >= 0) & ~hit]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("slots", "shift")}


def _slot(key: np.ndarray, shift: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)


def _slots(grams: np.ndarray) -> tuple[np.ndarray, int]:
    """An open table of the rows, at most half full, and the shift of its hash."""
    bits = max(4, (2 * len(grams)).bit_length())
    table = np.full(1 << bits, -1, np.int32)
    left, at = np.arange(len(grams)), _slot(grams, 64 - bits)
    while len(left):
        free = table[at] < 0
        table[at[free]] = left[free]  # of several for one slot, one stays
        lost = table[at] != left
        left, at = left[lost], (at[lost] + 1) & ((1 << bits) - 1)
    return table, 64 - bits


class WordScores:
    """Scores of words, computed for the new words of a batch at once and kept in a bounded cache.

    A full cache lets go of the words that it met once; those met again stay unless they fill half of it.
    """

    def __init__(self, score, width: int, most: int = 200_000):
        self.score, self.width, self.most = score, width, most
        self.piece = max(1 << 14, (1 << 19) // max(4, width))  # bytes scored at a time
        self._start([], np.zeros((4096, width), np.float32))

    def _start(self, words: list[bytes], table: np.ndarray) -> None:
        self.table, self.used, self.fresh = table, len(words), []
        self.met = np.zeros(len(table), np.int32)
        outer = self

        class Index(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = row = outer.used
                outer.used += 1
                outer.fresh.append(word)
                return row

        self.index = Index(zip(words, range(len(words))))

    def _let_go(self) -> None:
        again = np.flatnonzero(self.met[: self.used] > 1)
        if len(again) > self.most // 2:
            again = again[:0]
        words, table = list(self.index), np.zeros((max(4096, len(again)), self.width), np.float32)
        table[: len(again)] = self.table[again]
        self._start([words[i] for i in again.tolist()], table)

    def of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each list of words, their scores (words x width)."""
        if self.used > self.most:
            self._let_go()
        look = self.index.__getitem__
        rows = [np.fromiter(map(look, words), np.int32, len(words)) for words in texts]
        if self.used > len(self.table):
            more = max(self.used, 2 * len(self.table)) - len(self.table)
            self.table = np.concatenate([self.table, np.zeros((more, self.width), np.float32)])
            self.met = np.concatenate([self.met, np.zeros(more, np.int32)])
        if rows:
            self.met += np.bincount(np.concatenate(rows), minlength=len(self.met)).astype(np.int32)
        at = self.used - len(self.fresh)
        begin, size = 0, 0
        for end, word in enumerate(self.fresh, 1):  # pieces of bounded size: scoring holds several arrays of their bytes
            size += len(word) + 2
            if size >= self.piece or end == len(self.fresh):
                self.table[at + begin : at + end] = self.score(self.fresh[begin:end])
                begin, size = end, 0
        self.fresh = []
        return [self.table[r] for r in rows]
