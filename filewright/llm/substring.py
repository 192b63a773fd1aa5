"""Substring dedup: Rabin-Karp hashes of every window of a fixed number of words, counted in Spark.

A word of a document goes if a window that covers it also starts in a document of smaller id. Three steps:

1. Each document's windows are hashed, and of each window the least hash of its short spans (its minimizer) is taken.
   Equal windows have equal minimizers, so a window whose minimizer no other text holds can't repeat; only the
   minimizers, one for some twenty windows, are exchanged to find out. Documents of equal words are one text here:
   all but the least id lose all that is covered by a window.
2. The hashes of all windows that may repeat (two of 64 bits each) are counted in Spark: the least document of each.
3. The starts of windows that a smaller document holds go back to their documents, where they merge into maximal
   intervals of words.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from filewright.llm.common import cut, join_counted, mix64, release_worker_state, rolling, sliding_min, small_batches, split_by

WINDOW = 50
SPAN = 12
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def minimizers(h: np.ndarray, window: int, span: int) -> np.ndarray:
    """For each window, the least hash of the spans in it."""
    return sliding_min(mix64(rolling(h, span, _BASE[1])), window - span + 1)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _tag(digest: bytes) -> int:
    """Tells the texts of one id apart."""
    return int.from_bytes(digest[:4], "little", signed=True)


@lru_cache
def _schema(*fields: tuple[str, str]) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "longs": pa.list_(pa.int64()), "string": pa.string(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(same, starts): (doc_id, tag, first) of every row with an id, and (doc_id, tag, starts) of texts that lose words.

    tag tells texts of one id apart; first is the least id of the documents with the same words; starts are those of
    the windows to remove.
    """
    small_batches(docs.sparkSession)
    schema = _schema(("doc_id", "long"), ("tag", "int"), ("digest", "binary"), ("minis", "longs"))

    def scan(batches):
        release_worker_state()
        for batch in batches:
            digests, minis = [], []
            for text in batch.column(1).to_pylist():
                words = (text or b"").split()
                digests.append(_digest(words))
                minis.append(np.unique(minimizers(word_hashes(words), window, span)).astype(np.int64) if len(words) >= window else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_tag, digests), pa.int32()), pa.array(digests, pa.binary()), pa.array(minis, pa.list_(pa.int64()))], schema=schema)

    rows = cut(_texts(docs).where("doc_id is not null").mapInArrow(scan, "doc_id long, tag int, digest binary, minis array<long>"), "substring-scan")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    same = cut(join_counted(rows.select("doc_id", "tag", "digest"), firsts, ["digest"], "n").select("doc_id", "tag", "first").distinct(), "substring-same")
    own = same.where("doc_id = first").select(F.col("doc_id").alias("id"), F.col("tag").alias("t"))
    texts = rows.join(own, (F.col("doc_id") == F.col("id")) & (F.col("tag") == F.col("t")), "left_semi")
    spans = texts.select("doc_id", "tag", F.explode("minis").alias("mini"))
    shared = spans.groupBy("mini").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("mini")
    wanted = cut(spans.join(shared, "mini").groupBy("doc_id", "tag").agg(F.collect_set("mini").alias("minis")), "substring-wanted")

    found = _schema(("doc_id", "long"), ("tag", "int"), ("start", "int"), ("h1", "long"), ("h2", "long"))

    def windows(batches):
        release_worker_state()
        for batch in batches:
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, tag, text, minis in zip(ids, tags, batch.column(2).to_pylist(), batch.column(3)):
                words = (text or b"").split()
                if _tag(_digest(words)) != tag:
                    continue  # another text under the same id
                h = word_hashes(words)
                at = np.flatnonzero(np.isin(minimizers(h, window, span).astype(np.int64), minis.values.to_numpy()))
                h1, h2 = (mix64(rolling(h, window, b))[at].astype(np.int64) for b in _BASE)
                for i in range(0, len(at), 20_000):
                    n = len(at[i : i + 20_000])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, doc_id, np.int64)), pa.array(np.full(n, tag, np.int32)), pa.array(at[i : i + n].astype(np.int32)), pa.array(h1[i : i + n]), pa.array(h2[i : i + n])], schema=found)

    maybe, _ = split_by(_texts(docs).withColumnRenamed("doc_id", "id"), "id", wanted, "doc_id")
    again = wanted.join(maybe, F.col("doc_id") == F.col("id")).select("doc_id", "tag", "text", "minis")
    hashed = cut(again.mapInArrow(windows, "doc_id long, tag int, start int, h1 long, h2 long"), "substring-windows")
    least = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).where("lo < hi").drop("hi")
    gone = join_counted(hashed, least, ["h1", "h2"], "n").where("doc_id > lo")
    starts = gone.groupBy("doc_id", "tag").agg(F.collect_list("start").alias("starts"))
    return same, starts


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Windows that overlap or touch merge into maximal intervals of words."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    cuts = np.flatnonzero(np.diff(starts) > window)
    begins = starts[np.concatenate([[0], cuts + 1])]
    ends = starts[np.concatenate([cuts, [len(starts) - 1]])] + window
    return list(zip(begins.tolist(), ends.tolist()))


def remove(docs: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    Words are runs of anything but space and the control characters 9 to 13, unchanged. Of several documents that
    hold a window the least id keeps it; windows are judged on the whole input. A null text has no words; a text
    shorter than a window loses nothing; equal ids (repeated rows too) are one document, no row of which removes
    words of another; a row without an id is kept whole and removes nothing; a very long text is one document like any
    other. An empty table gives an empty one.
    Other columns are ignored.
    """
    same, starts = repeated_windows(docs, window, span)
    later = same.where("doc_id > first").select("doc_id", "tag", F.lit(None).cast("array<int>").alias("starts"))
    fates = starts.union(later).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("tag", "starts")).alias("fates"))
    fates = cut(fates, "substring-fates")
    schema = _schema(("doc_id", "long"), ("n_words", "long"), ("n_removed", "long"), ("kept", "binary"))

    def left_of(words: list[bytes], fates) -> list[bytes]:
        if not fates.is_valid or len(words) < window:
            return words
        tag = _tag(_digest(words))
        for fate in fates.values:
            if fate["tag"].as_py() != tag:
                continue
            if not fate["starts"].is_valid:  # an earlier document has the same words
                return []
            begin, left = 0, []
            for a, b in intervals(fate["starts"].values.to_numpy(), window):
                left += words[begin:a]
                begin = b
            return left + words[begin:]
        return words

    def apply(batches):
        release_worker_state()
        for batch in batches:
            counts, gone, kept = [], [], []
            for text, fates in zip(batch.column(1).to_pylist(), batch.column(2)):
                words = (text or b"").split()
                left = left_of(words, fates)
                counts.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], schema=schema)

    maybe, never = split_by(_texts(docs), "doc_id", fates, "id")
    changed = maybe.join(fates, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "fates")
    whole = never.select("doc_id", "text", F.lit(None).cast(fates.schema["fates"].dataType).alias("fates"))
    rows = changed.unionByName(whole)
    return rows.mapInArrow(apply, "doc_id long, n_words long, n_removed long, kept binary").withColumn("kept", F.col("kept").cast("string"))
