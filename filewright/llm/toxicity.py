"""Toxicity by class-conditional Kneser-Ney models over the bytes of texts.

A text is its lower-cased words, one space apart. The context of a byte is the ORDER - 1 bytes before it. Toxic and
ordinary texts have counts of their own after long contexts; both back off to one distribution of continuation counts
that they share, so an expression that is rare in either class is smoothed by all that is known of its parts. A text
is judged by the mean ratio of its words, which is the length-normalised difference of its two log-likelihoods, and
beside it by how much its most telling words and expressions of several words say: a few toxic words in a long text
hardly move the mean. A logistic fit on texts that the models haven't seen weighs the three.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filewright.llm import grams
from filewright.llm.common import crc_mod, cut, share, small_batches, split_by, worker_state

ORDER = 5
DISCOUNT = 0.75
#: Labelled texts, at most, whose features calibrate the score (all of them are counted).
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
#: Where a word's ratio, in nats, turns from a little into its full worth as peak evidence.
BEND = 6.0
#: Added to the mean peak evidence of a word before its logarithm is taken.
FLOOR = 0.002
#: The mean ratio of a text without words: less than that of any other.
NOTHING = -50.0


class KneserNey:
    """Log-likelihood ratios of bytes, toxic against ordinary, from gram counts (grams x [ordinary, toxic]).

    After a context h, class c gives a byte (max(n_c - D, 0) + D t_c q_c) / N_c, where n_c counts the gram in the
    class, N_c and t_c are all that follows h there and its kinds, and q_c is what the class backs off to; without N_c
    it gives q_c. There are two models. In the model of words h is the longest context that doesn't reach further back
    than the space before the word, and q is what the continuation counts of all texts, which the classes share, give
    the byte after the next shorter context. In the model of expressions, contexts that reach into the word before
    come on top, each backing off to the one a byte shorter, and the shortest to the model of words; they count where
    both classes know them. The ratios are worked out once for each gram; where no text held a gram, a byte takes what
    its contexts add on the way to the longest gram that one did, and what the classes share cancels out.
    """

    def __init__(self, tree: grams.Tree, counts: np.ndarray):
        self.tree = tree.keys_only()
        n = len(counts)
        parent = np.where(tree.context >= 0, tree.context, n)  # the last row is the empty context
        shorter = tree.suffix
        seen = counts.sum(1) > 0
        add = lambda w: np.bincount(parent, w, n + 1)
        cont = np.bincount(shorter[(shorter >= 0) & seen], minlength=n).astype(float)
        whole, kinds = add(cont), add(cont > 0)
        shared = np.full(n, 1 / 256)
        sizes = [np.flatnonzero(tree.size == k) for k in range(1, self.tree.order + 1)]
        for here in sizes:
            h = parent[here]
            back = np.where(tree.size[here] > 1, shared[shorter[here]], 1 / 256)
            total = np.maximum(whole[h], 1e-9)
            level = (np.maximum(cont[here] - DISCOUNT, 0) + np.minimum(DISCOUNT, total) * kinds[h] * back) / total
            shared[here] = np.where(whole[h] > 0, level, back)
        across = np.append(_across(tree.grams), False)  # contexts that reach into the word before
        word = np.append(tree.starts | (tree.size == self.tree.order - 1), False) & ~across
        total, types = (np.stack([add(w[:, c]) for c in (0, 1)], 1) for w in (counts, counts > 0))
        both = across & (total > 0).all(1)
        self.ratio = np.zeros((n, 2))  # by the model of words, and of expressions
        for c, sign in ((0, -1), (1, 1)):
            out = np.stack([shared, shared], 1)
            for here in sizes[1:]:
                here = here[across[parent[here]] | word[parent[here]]]
                h, up = parent[here], shorter[here]
                back = np.where(across[h, None], out[up], shared[up, None])
                level = (np.maximum(counts[here, c] - DISCOUNT, 0)[:, None] + DISCOUNT * types[h, c, None] * back) / np.maximum(total[h, c], 1)[:, None]
                used = np.stack([word[h] & (total[h, c] > 0), (word[h] & (total[h, c] > 0)) | both[h]], 1)
                out[here] = np.where(used, level, back)
            self.ratio += sign * np.log(out)
        lost = np.log(np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1))
        lost = lost[:, 1] - lost[:, 0]
        self.after = np.stack([np.where(word, lost, 0), np.where(word | both, lost, 0)], 1).astype(np.float32)
        self.ratio = self.ratio.astype(np.float32)

    def bytes_of(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The two ratios of each byte of a line; those of the space before a text are 0."""
        out = np.zeros((len(line), 2), np.float32)
        if not len(self.ratio):
            return out
        for begin, end, keys in grams.pieces(line, at, self.tree.order):
            left = np.arange(begin, end)
            while len(left):
                found = self.tree.find(keys)
                hit = found >= 0
                out[left[hit]] += self.ratio[found[hit]]
                left, keys = left[~hit], keys[~hit]
                before = _context(keys)
                context = self.tree.find(before)
                known = context >= 0
                out[left[known]] += self.after[context[known]]
                further = _across(before)  # below the contexts within the word the classes share all
                left, keys = left[further], _shorter(keys[further])
        out[at == 0] = 0
        return out

    def words(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the two ratios of its words, each with the space after it."""
        line, at, n = grams.line_of(texts, self.tree.order)
        ratios = self.bytes_of(line, at)
        first = np.flatnonzero((line == 32)[:-1] & (line != 32)[1:]) + 1  # of each word
        sums = np.add.reduceat(ratios, first, axis=0) if len(first) else np.zeros((0, 2), np.float32)
        return np.split(sums, np.cumsum(n)[:-1]) if len(n) else []


def _across(keys: np.ndarray) -> np.ndarray:
    """Whether grams hold a space after their first byte."""
    out = np.zeros(len(keys), bool)
    for j in range(ORDER):
        out |= ((keys >> 8 * j) & 255 == 32) & (keys >> 56 > j + 1)
    return out


def _shorter(keys: np.ndarray) -> np.ndarray:
    """The grams less their first byte."""
    size = (keys >> 56) - 1
    return size << 56 | keys & ((np.int64(1) << 8 * size) - 1)


def _context(keys: np.ndarray) -> np.ndarray:
    """The grams less their last byte; no gram is that of one byte."""
    size = keys >> 56
    return np.where(size > 1, (size - 1) << 56 | (keys & ((1 << 56) - 1)) >> 8, 0)


def evidence(ratios: np.ndarray) -> tuple[float, float, float]:
    """Of a text's word ratios: their mean, and the logarithms of the mean peak evidence of words and of expressions.

    Peak evidence bends smoothly: every ratio counts, and a higher one always counts more.
    """
    if not len(ratios):
        return NOTHING, float(np.log(FLOOR)), float(np.log(FLOOR))
    ratios = ratios.astype(np.float64)
    words, expressions = np.log(np.logaddexp(0, ratios - BEND).mean(0) + FLOOR)
    return float(ratios[:, 0].mean()), float(words), float(expressions)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, np.ndarray]:
    """Intercept and slopes, by Newton's steps; no slope is negative. Without both labels, the base rate."""
    slopes = np.zeros(x.shape[1])
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return float(np.log(rate / (1 - rate))), slopes
    used = list(range(x.shape[1]))
    while True:
        z = np.concatenate([np.ones((len(x), 1)), x[:, used]], 1)
        b = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(b)), z.T @ (y - p) - ridge * b)
            b += np.clip(step, -5, 5)
            if abs(step).max() < 1e-6:
                break
        if (b[1:] >= 0).all():
            slopes[used] = b[1:]
            return float(b[0]), slopes
        used.pop(int(b[1:].argmin()))


def _features(rows: DataFrame, keep: list[str], models: list, which: str, text: str):
    """``keep`` and x0 to x2, the evidence in ``text``; column ``which`` says by which model. Also the models' broadcast."""
    spark = rows.sparkSession
    shared, name = share(spark, models), uuid.uuid4().hex
    types = {f.name: f.dataType for f in rows.schema}
    ddl = ", ".join(f"{c} {types[c].simpleString()}" for c in keep) + ", x0 double, x1 double, x2 double"

    def run(batches):
        held = worker_state(name, lambda: shared.value)
        for batch in batches:
            x = np.zeros((batch.num_rows, 3))
            model = batch.column(which).to_numpy(zero_copy_only=False)
            texts = batch.column(text).to_pylist()
            for m, scores in enumerate(held):
                at = np.flatnonzero(model == m)
                for i, ratios in zip(at, scores.words([texts[i] for i in at])):
                    x[i] = evidence(ratios)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, np.ascontiguousarray(x.T))], names=[*keep, "x0", "x1", "x2"])

    out = rows.select(*dict.fromkeys([*keep, which, text])).mapInArrow(run, ddl)
    return out, shared


def score(docs: DataFrame, labels: DataFrame, held_out, calibration_rows: int = CALIBRATION_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with three more columns: held_out, score (0 to 1, higher: likelier toxic) and predicted (0 or 1).

    ``labels(doc_id, toxic)`` teaches, save rows for which ``held_out`` (a condition on doc_id) holds. All of their
    texts are counted; two halves score each other's texts, and a bounded sample of those (``calibration_rows``)
    turns evidence into a probability. Labels, language, source and id never enter a score.

    A null or empty text has no words and scores less than any other text; of several labels of an id the
    highest counts; labels that are neither 0 nor 1 and null ids teach nothing (such documents are scored all the
    same, their held_out is false); repeated rows teach and are scored each; without labels of both kinds every score
    is the smoothed base rate; an empty table gives an empty one. Every row and every other column stays (columns that
    have the names of the new ones are replaced).
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & ~held_out & F.col("text").isNotNull())
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    rows, _ = split_by(rows, "doc_id", known, "__id")  # else all texts would be exchanged for the join
    train = cut(rows.join(known.hint("shuffle_merge"), F.col("doc_id") == F.col("__id")).select("doc_id", "text", (half * 2 + F.col("toxic")).alias("label"), (1 - half).alias("other")), "toxicity-train")
    counted = cut(grams.count_texts(train, 4, ORDER), "toxicity-grams")
    found, n = grams.collect(counted, 4)
    tree = grams.Tree(found, ORDER)
    rows = train.count()
    sample = train.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(max(rows, 1))) < calibration_rows)
    seen, halves = _features(sample, ["label"], [KneserNey(tree, n[:, :2]), KneserNey(tree, n[:, 2:])], "other", "text")
    seen = seen.toPandas()
    halves.unpersist()
    a, b = fit_logistic(seen[["x0", "x1", "x2"]].to_numpy(float), (seen["label"].to_numpy(int) % 2).astype(float))
    final = KneserNey(tree, n[:, :2] + n[:, 2:])
    docs = docs.drop("held_out", "score", "predicted")
    keep = docs.columns
    named = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.coalesce(held_out, F.lit(False)).alias("held"), F.col("text").cast("string").alias("whole"), F.lit(0).alias("model"))
    out, _ = _features(named, [*(f"c{i}" for i in range(len(keep))), "held"], [final], "model", "whole")
    value = 1 / (1 + F.exp(-(F.lit(a) + F.lit(float(b[0])) * F.col("x0") + F.lit(float(b[1])) * F.col("x1") + F.lit(float(b[2])) * F.col("x2"))))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), F.col("held").alias("held_out"), value.alias("score"), (value >= threshold).cast("int").alias("predicted"))


def default_held_out():
    """crc32 of the id as text, modulo 3, is 1."""
    return crc_mod(F.col("doc_id"), 3) == 1
