"""Benchmark decontamination by SimHash of item-sized windows.

For an item of n words, every window of n words of a document is a candidate. Items and windows have a SimHash of 64
bits over their weighted word shingles. Items are indexed by the eight bytes of their fingerprints: if two
fingerprints differ in at most RADIUS bits, some byte differs in at most RADIUS // 8, so probing all such values of
each byte finds every item within the radius. What is found is verified by the exact weighted Jaccard similarity of
the shingles. A window that shares no shingle with any item has similarity 0, so fingerprints are only made for the
windows around a shared shingle. A document of fewer words than the item is one window, its whole text; it is compared
with every such item that it shares a shingle with, without a fingerprint.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from filewright.llm.common import mix64, rolling, share, small_batches, worker_state

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
#: Words of benchmark items that are broadcast at a time; a larger benchmark is compared in blocks of items.
BLOCK_WORDS = 2_000_000
_WORD = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15
_BITS = np.arange(64, dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall((text or "").lower())


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    return mix64(rolling(h, width, _BASE) + np.uint64(width))


def _signs(shingles: np.ndarray) -> np.ndarray:
    """Shingles x 64: +1 where the bit is set, else -1."""
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(-1, dtype=np.uint64)


def fingerprints(shingles: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of every ``size`` consecutive shingles, each weighted by how often it occurs there."""
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_signs(shingles), 0, dtype=np.int32)])
    return _pack(sums[size:] - sums[:-size])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard: of each shingle's counts, the sum of the lesser over the sum of the greater."""
    keys, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(back[: len(a)], minlength=len(keys)), np.bincount(back[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _near(reach: int) -> np.ndarray:
    """The bytes with at most ``reach`` bits set."""
    return np.array([sum(1 << b for b in c) for k in range(reach + 1) for c in combinations(range(8), k)], np.uint8)


class Index:
    """A block of benchmark items, by shingle and by the bytes of their fingerprints."""

    def __init__(self, items: list[tuple[int, str | None]], width: int, threshold: float, radius: int):
        self.threshold, self.radius, self.near = threshold, radius, _near(radius // BLOCKS)
        self.items: list[tuple[int, int, np.ndarray]] = []  # id, number of words, shingles
        self.by_shingle: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.blocks: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        prints = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(width, len(words))
            shingles = shingle_hashes(_hashes(words), k)
            at = len(self.items)
            self.items.append((item_id, len(words), shingles))
            print_ = fingerprints(shingles, len(shingles))[0]
            prints.append(print_)
            for s in np.unique(shingles).tolist():
                self.by_shingle[k][s].append(at)
            for b, byte in enumerate(print_.reshape(1).view(np.uint8).tolist()):
                self.blocks[len(words)][b, byte].append(at)
        self.prints = np.array(prints, np.uint64)
        self.sorted = {k: np.array(sorted(d), np.uint64) for k, d in self.by_shingle.items()}
        self.by_shingle = {k: dict(d) for k, d in self.by_shingle.items()}
        self.blocks = {n: dict(d) for n, d in self.blocks.items()}

    def candidates(self, n: int, fingerprint: np.uint64) -> list[int]:
        """The items of n words whose fingerprint is within the radius."""
        found: set[int] = set()
        table = self.blocks[n]
        for b, byte in enumerate(np.array([fingerprint]).view(np.uint8)):
            for value in (self.near ^ byte).tolist():
                found.update(table.get((b, value), ()))
        return [i for i in found if int(self.prints[i] ^ fingerprint).bit_count() <= self.radius]

    def search(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window of each item that the text holds."""
        words = words_of(text)
        if not words or not self.items:
            return []
        h = _hashes(words)
        best: dict[int, tuple[float, int]] = {}
        whole: set[int] = set()  # items of more words than the text
        for k, known in self.sorted.items():
            shingles = shingle_hashes(h, k)
            at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            hits = np.flatnonzero(known[at] == shingles)
            if not len(hits):
                continue
            spans: dict[int, list[int]] = defaultdict(list)  # number of words, places of shingles shared with such items
            for place in hits.tolist():
                sharing = self.by_shingle[k][int(shingles[place])]
                for n in {self.items[i][1] for i in sharing}:
                    if n <= len(words):
                        spans[n].append(place)
                whole.update(i for i in sharing if self._longer(i, len(shingles)))
            for n, places in spans.items():
                self._windows(shingles, n, n - k + 1, np.array(places), best)
            for i in whole:
                if (s := similarity(shingles, self.items[i][2])) >= self.threshold:
                    best[i] = (s, 0)
            whole.clear()
        return [(self.items[i][0], s, start, min(self.items[i][1], len(words))) for i, (s, start) in sorted(best.items())]

    def _longer(self, i: int, n: int) -> bool:
        """Whether an item has more than ``n`` shingles, but not too many for the threshold."""
        size = len(self.items[i][2])
        return size > n and n / size >= self.threshold

    def _windows(self, shingles: np.ndarray, n: int, size: int, places: np.ndarray, best: dict) -> None:
        """Judge the windows of ``size`` shingles that hold one of the places."""
        last = len(shingles) - size
        for run in np.split(places, np.flatnonzero(np.diff(places) > size) + 1):
            lo, hi = max(0, int(run[0]) - size + 1), min(last, int(run[-1]))
            for part in range(lo, hi + 1, 4096):
                end = min(part + 4095, hi)
                for off, fingerprint in enumerate(fingerprints(shingles[part : end + size], size)):
                    for i in self.candidates(n, fingerprint):
                        start = part + off
                        s = similarity(shingles[start : start + size], self.items[i][2])
                        if s >= self.threshold and (i not in best or s > best[i][0]):
                            best[i] = (s, start)


def _blocks(benchmark: DataFrame, block_words: int):
    """The items in blocks of bounded size; an item is never split."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    for row in rows.toLocalIterator():
        n = row.text.count(" ") + 1
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += n
    if held:
        yield held


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = SIMILARITY, radius: int = RADIUS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the benchmark items that documents hold, with the best window.

    A window of as many words as the item has, or the whole of a shorter document, counts if the weighted Jaccard similarity of ``width``-word shingles is
    ``threshold`` or more; of equal ones the first is told. Items of fewer words than the width are one shingle.
    Items without words are found nowhere; documents that are null or empty hold none;
    repeated rows are judged each; an empty table or benchmark gives no rows. Other columns are ignored. Benchmarks
    of any size are compared in blocks of ``block_words`` words, each broadcast by itself.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("n_words", pa.int64())])
    ddl = "doc_id long, item_id long, similarity double, start long, n_words long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    out = None
    for items in _blocks(benchmark, block_words):
        shared, name = share(spark, items), uuid.uuid4().hex

        def run(batches, shared=shared, name=name):
            index = worker_state(name, lambda: Index(shared.value, width, threshold, radius))
            for batch in batches:
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in index.search(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        part = texts.mapInArrow(run, ddl)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], ddl) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = SIMILARITY, radius: int = RADIUS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, by the rules of ``find``; every column stays."""
    spark = docs.sparkSession
    small_batches(spark)
    columns = docs.columns
    types = [f.dataType.simpleString() for f in docs.schema]
    out = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col("text").cast("string").alias("__text"))
    ddl = ", ".join(f"c{i} {t}" for i, t in enumerate(types)) + ", __text string"
    for items in _blocks(benchmark, block_words):
        shared, name = share(spark, items), uuid.uuid4().hex

        def run(batches, shared=shared, name=name):
            index = worker_state(name, lambda: Index(shared.value, width, threshold, radius))
            for batch in batches:
                clean = [not index.search(t) for t in batch.column("__text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, ddl)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
