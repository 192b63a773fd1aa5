"""Language identification by prediction by partial matching.

Each language has a tree of the byte contexts of its words, up to ORDER - 1 bytes, with frozen counts. The code
length of a byte follows PPM (escape method C, with full exclusion): from the longest context that the language has
seen, escape to shorter ones until the byte is found; symbols of the contexts left behind are excluded from the
totals below; after the empty context all other bytes are equally likely. The language of least code length wins.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filewright.llm import grams
from filewright.llm.common import crc_mod, cut, share, small_batches, worker_state

ORDER = 5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


class ContextTrees:
    """Code lengths in bits of words, by language, from gram counts (grams x languages).

    All that the code length of a byte needs is worked out once for each gram and language. In the contexts of a byte
    the symbols seen in one are those seen in the next shorter one, or fewer; so what is excluded at a context depends
    on the context one byte longer alone, and the escapes from the longest context down to any shorter one are the
    difference of two sums. A byte costs three gathers, whatever the number of languages or of escapes.
    """

    def __init__(self, tree: grams.Tree, counts: np.ndarray):
        n, width = len(counts), counts.shape[1]
        self.tree, self.width, self.n = tree.keys_only(), width, n
        parent = np.where(tree.context >= 0, tree.context, n)  # the context of a gram; row n is the empty one
        shorter = np.append(np.where(tree.suffix >= 0, tree.suffix, n), n)  # a gram less its first byte
        add = lambda w: np.stack([np.bincount(parent, w[:, c], n + 1) for c in range(width)], 1) if n else np.zeros((1, width))
        total, kinds = add(counts), add(counts > 0)
        below = np.where(tree.suffix[:, None] >= 0, counts[tree.suffix], 0) * (counts > 0) if n else counts
        lost = add(below)  # what a context's symbols count in the context that is one byte shorter
        log = lambda x: np.log2(np.maximum(x, 0.5))
        whole = total + kinds
        escape = np.where(total > 0, log(whole) - log(kinds), 0)  # at a context without exclusions
        left, new = total[shorter] - lost, kinds[shorter] - kinds  # at the shorter context, exclusions made
        down = np.where(total > 0, np.where(left + new > 0, log(left + new) - log(new), 0), 0)
        down[n] = 0
        rest, start, hit = np.zeros((n + 1, width)), escape.copy(), np.zeros((n + 1, width))
        sizes = np.append(tree.size, 0)
        for k in range(1, int(sizes.max()) + 1):
            at = np.flatnonzero(sizes == k)
            up = shorter[at]
            has = total[at] > 0
            rest[at] = np.where(has, down[at] + rest[up], rest[up])
            start[at] = np.where(has, escape[at] + rest[at], start[up])
            # what a byte found in the shorter context adds, if this one is a context of it as well
            hit[at] = np.where(has, log(left[at] + new[at]) - rest[at], np.where(total[up] > 0, log(whole[up]) - start[up], 0))
        alone = np.where(total > 0, log(whole) - start, 0)  # the same if there is no longer context
        nothing = log(np.maximum(256 - kinds[n], 1))
        value = np.zeros((n + 1, width))
        value[n] = nothing  # of a byte that no language has
        for k in range(1, int(sizes.max()) + 1):
            at = np.flatnonzero(sizes == k)
            up = shorter[at]
            if k == 1:
                missing = np.broadcast_to(nothing, (len(at), width))
            else:
                missing = np.where(counts[up] > 0, hit[parent[at]] - log(counts[up]), value[up])
            value[at] = np.where(counts[at] > 0, -log(counts[at]), missing)
        self.start = start.astype(np.float32)
        self.hit = np.concatenate([hit, alone]).astype(np.float32)
        self.value = value.astype(np.float32)
        self.top = np.append(parent, n).astype(np.int32) + n + 1
        self.seen = np.append(counts > 0, np.zeros((1, width), bool), 0)

    def score(self, words: list[bytes]) -> np.ndarray:
        line, word, at = grams.packed(words, self.tree.order)
        n, width = self.n, self.width
        coded = np.flatnonzero(at > 0)
        gram = np.full(len(line), n)  # the longest gram that ends at a byte, and the longest that may be its context
        size, longest = np.zeros(len(line), np.int64), np.full(len(line), n)
        rows = []
        for k, key in enumerate(grams.keys(line, at, self.tree.order), 1):
            found = self.tree.find(key)
            there = found >= 0
            gram[there], size[there] = found[there], k
            if k < self.tree.order:
                longest[there] = found[there]
                rows.append(found)
        own, context = gram[coded], longest[coded - 1]
        # the context one byte longer than that of the gram, if it is one of the grams
        longer = np.full(len(coded), -1)
        for k, found in enumerate(rows, 1):
            here = np.flatnonzero(size[coded] == k)
            longer[here] = found[coded[here] - 1]
        bits = self.start[context] + self.value[own] + np.where(self.seen[own], self.hit[np.where(longer >= 0, longer, self.top[own])], 0)
        where = word[coded]
        return np.stack([np.bincount(where, bits[:, c], len(words)) for c in range(width)], 1)


def predict(docs: DataFrame, held_out, order: int = ORDER) -> DataFrame:
    """``docs`` with three more columns: held_out, lang_pred and score (0 to 1: how far the best code is ahead).

    The trees are learnt from all texts with a lang, save rows for which ``held_out`` (a condition on doc_id) holds.
    lang, source and id never enter a prediction. A text that is null or holds no letter is ``und`` with score 0; so
    is every text if nothing can be learnt. Of equal code lengths the first language by name wins. A null id is
    learnt from and predicted, its held_out is false; repeated rows count each; a very long run without white space
    is coded in pieces of 4096 bytes; an empty table gives an empty one. Every row and every other column stays
    (columns that have the names of the new ones are replaced).
    """
    spark = docs.sparkSession
    small_batches(spark)
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out, F.lit(False)))
    langs = sorted(r[0] for r in learn.select("lang").distinct().collect())
    width = max(1, len(langs))
    index = F.array_position(F.array(*map(F.lit, langs or [""])), F.col("lang")).cast("int") - 1
    counted = cut(grams.count(learn.select(index.alias("label"), "text"), width, order), "langid-grams")
    found, n = grams.collect(counted, width)
    model = ContextTrees(grams.Tree(found, order), n)
    shared, name = share(spark, model), uuid.uuid4().hex
    docs = docs.drop("held_out", "lang_pred", "score")
    keep = docs.columns
    held = F.coalesce(held_out, F.lit(False)).alias("held")
    named = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), held, F.col("text").cast("string").alias("__text"))
    cols = [*(f"c{i}" for i in range(len(keep))), "held"]
    types = [*(f.dataType.simpleString() for f in docs.schema), "boolean"]
    ddl = ", ".join(f"{c} {t}" for c, t in zip(cols, types)) + ", lang_pred string, score double"

    def run(batches):
        scores = worker_state(name, lambda: grams.WordScores(shared.value.score, width))
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            said = [bool(langs and t and _LETTER.search(t)) for t in texts]
            pred, value = [], []
            for ok, bits in zip(said, scores.of([grams.words_of(t) if ok else [] for ok, t in zip(said, texts)])):
                if not ok:
                    pred.append(UNKNOWN)
                    value.append(0.0)
                    continue
                total = bits.sum(0, dtype=np.float64)
                best = int(total.argmin())
                ahead = np.clip((total - total[best]) / np.sqrt(len(bits)), 0, 60)
                pred.append(langs[best])
                value.append(float(1 / np.exp2(-ahead).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(pred, pa.string()), pa.array(value, pa.float64())], names=[*cols, "lang_pred", "score"])

    out = named.mapInArrow(run, ddl)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), F.col("held").alias("held_out"), "lang_pred", "score")


def default_held_out():
    """crc32 of the id as text, modulo 5, is 0."""
    return crc_mod(F.col("doc_id"), 5) == 0
