"""Jaccard join of documents on word n-grams with adaptive multi-match prefixes.

Documents with equal n-gram sets are one class, of which the least id stands for all. N-grams are ordered by a sketch
of their frequency, rare ones first. A document's prefix holds one n-gram more than its size allows to differ, plus
l - 1; two documents can only reach the similarity if their prefixes for l share l n-grams. Each document's l is the
one of least estimated cost: longer prefixes give more matches to count, but ask for more of them before a pair is
verified.

A group of near copies would make as many pairs as the square of its size. So the documents of an n-gram are first
paired with one of them alone, the hub, then with a second one that the first didn't reach; pairs are then only sought
between documents whose components still differ. In every round a pair must share l n-grams of its prefixes before it
is verified. Components, not pairs, are the result: what is left out joins documents that are joined already.

A pair's sets are only fetched if its parity signatures allow the similarity: each n-gram flips one bit, so the bits
that differ are no more than the n-grams that differ. That turns down pairs by chance and never a link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from filewright.llm.common import HOT_KEYS, components, cut, drop_cut, mix64, release_worker_state, rolling, share, small_batches, small_tasks, split_by
from filewright.llm.substring import word_hashes

#: Counters of the frequency sketch: its size is fixed, whatever the data.
SKETCH = 1 << 19
MOST_MATCHES = 4
#: Bits of a set's parity signature, kept as numbers of 64 bits.
SIGNATURE = 1024
#: Numbers of 64 bits that a signature folds to where each shared n-gram carries it; the fold has the same bound.
FOLD = 4
#: Cost of verifying a candidate, in matches counted.
VERIFY_COST = 8.0
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The distinct n-grams of a text as 64-bit hashes, ascending: A-Z lower-cased, words split at space and controls 9-13.

    Fewer words than the width make one n-gram; no words make none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = min(width, len(words))
    return np.unique(mix64(rolling(word_hashes(words), n, _BASE[n % len(_BASE)]) + np.uint64(n)))


def signature(grams: np.ndarray) -> np.ndarray:
    """A bit for each residue of the n-grams' upper halves: whether an odd number of them has it."""
    odd = np.bincount(((grams >> np.uint64(32)) % np.uint64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix(grams: np.ndarray, sketch: np.ndarray, noise: float, num: int, den: int) -> tuple[np.ndarray, int]:
    """The prefix of a set of n-grams in the global order, and the number of matches asked for."""
    seen = sketch[(grams % np.uint64(SKETCH)).astype(np.int64)]
    order = np.lexsort((grams, seen))
    n = len(grams)
    least = n + 1 - -(-num * n // den)  # length of the prefix for one match
    most = min(MOST_MATCHES, n - least + 1)
    cost = np.cumsum(np.maximum(seen[order[: least + most - 1]] - noise, 0))
    ells = np.arange(1, most + 1)
    total = cost[least - 1 : least - 1 + most] * (1 + VERIFY_COST / ells)
    ell = int(ells[total.argmin()])
    return grams[order[: least + ell - 1]], ell


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """(kind, a, b, digest, bits): for each row its id, set size, digest and signature (kind 0); counters of the sketch (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("digest", pa.binary()), ("bits", pa.list_(pa.int64()))])

    def run(batches):
        release_worker_state()
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            sizes, digests, bits = [], [], []
            for text in batch.column(1).to_pylist():
                grams = shingles(text, width)
                sizes.append(len(grams))
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                bits.append(signature(grams))
                np.add.at(counts, (grams % np.uint64(SKETCH)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sizes), np.int32)), batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bits, pa.list_(pa.int64()))], schema=schema)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), np.int32)), pa.array(used), pa.array(counts[used]), pa.nulls(len(used), pa.binary()), pa.nulls(len(used), pa.list_(pa.int64()))], schema=schema)

    return _texts(docs).mapInArrow(run, "kind int, a long, b long, digest binary, bits array<long>")


def _prefixes(docs: DataFrame, width: int, sketch: np.ndarray, num: int, den: int) -> DataFrame:
    """(doc_id, n, ell, grams) of every row with words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ell", pa.int32()), ("grams", pa.list_(pa.int64()))])
    noise = float(np.quantile(sketch, 0.75))
    shared = share(docs.sparkSession, sketch)

    def run(batches):
        release_worker_state()
        for batch in batches:
            ids, sizes, ells, out = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = shingles(text, width)
                if len(grams):
                    first, ell = prefix(grams, shared.value, noise, num, den)
                    ids.append(doc_id)
                    sizes.append(len(grams))
                    ells.append(ell)
                    out.append(first.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ells, pa.int32()), pa.array(out, pa.list_(pa.int64()))], schema=schema)

    return _texts(docs).where("doc_id is not null").mapInArrow(run, "doc_id long, n long, ell int, grams array<long>")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, grams) of the documents in ``ids(id)``, and of few others that share their hash."""
    schema = pa.schema([("id", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(batches):
        release_worker_state()
        for batch in batches:
            sets = [shingles(t, width).astype(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    maybe, _ = split_by(_texts(docs), "doc_id", ids, "id")
    return maybe.mapInArrow(run, "id long, grams array<long>")


def _dealt(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with xp and yp, the part of each end that a pair takes; (id, parts) of the ends that stand in many pairs.

    A document that is the hub of many would have all of its pairs in one task. There are fewer than twice HOT_KEYS
    such ends, by their definition.
    """
    most = max(50, pairs.count() // HOT_KEYS)
    ends = pairs.select(F.col("x").alias("id")).union(pairs.select("y"))
    hot = cut(ends.groupBy("id").agg(F.ceil(F.count("*") / most).cast("int").alias("parts")).where("parts > 1"), "join-hot")
    for c, other in (("x", "y"), ("y", "x")):
        found = F.broadcast(hot.select(F.col("id").alias(c), F.col("parts").alias(f"{c}p")))
        pairs = pairs.join(found, c, "left").withColumn(f"{c}p", F.coalesce(F.pmod(F.xxhash64(other), F.col(f"{c}p")).cast("int"), F.lit(0)))
    return pairs, hot


def _met(dealt: DataFrame, hot: DataFrame, side: DataFrame) -> DataFrame:
    """Each pair (x, y) with what ``side(id, ...)`` has of both ends, the columns of x and of y after their names."""
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    side = side.join(F.broadcast(hot), "id", "left").withColumn("part", parts).drop("parts")
    of = lambda c: side.select(*(F.col(k).alias({"id": c, "part": f"{c}p"}.get(k, f"{c}_{k}")) for k in side.columns)).hint("shuffle_merge")
    return dealt.join(of("y"), ["y", "yp"]).join(of("x"), ["x", "xp"])


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("id")).union(pairs.select("y"))


def _likely(signed: DataFrame, dealt: DataFrame, hot: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (x, y) whose signatures in ``signed(doc_id, n, bits)`` allow the similarity num / den."""
    wanted, _ = split_by(signed.withColumnRenamed("doc_id", "id"), "id", _ids(dealt), "id")
    both = _met(dealt, hot, wanted)
    bits = [(F.col("x_bits")[i], F.col("y_bits")[i]) for i in range(SIGNATURE // 64)]
    return both.where(_may_reach(bits, F.col("x_n") + F.col("y_n"), num, den)).select(*dealt.columns).distinct()


def _matched(shared: DataFrame, dealt: DataFrame, hot: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (x, y) that share as many n-grams of their prefixes as they ask for; ``shared`` has the prefixes."""
    mine, _ = split_by(shared.withColumnRenamed("doc_id", "id"), "id", _ids(dealt), "id")
    both = _met(dealt, hot, mine.groupBy("id", "n", "ell").agg(F.collect_list(F.struct("at", "gram")).alias("first")))
    ell = F.least("x_ell", "y_ell")
    slack = ell - _alpha(F.col("x_n"), F.col("y_n"), num, den)
    own = lambda c: F.transform(F.filter(f"{c}_first", lambda g: g["at"] < F.col(f"{c}_n") + slack), lambda g: g["gram"])
    return both.where(F.size(F.array_intersect(own("x"), own("y"))) >= ell).select(*dealt.columns).distinct()


def _may_reach(bits: list[tuple[Column, Column]], whole: Column, num: int, den: int) -> Column:
    """Whether two signatures, whose sets have ``whole`` n-grams together, allow the similarity."""
    differ = sum(F.bit_count(x.bitwiseXOR(y)) for x, y in bits)
    return (whole - differ) * (den + num) >= 2 * num * whole


def _folded(signed: DataFrame) -> DataFrame:
    """(sid, s0, s1, ...) for each document; null numbers, which allow all, for an id of several rows."""
    step = SIGNATURE // 64 // FOLD
    rows = signed.select("doc_id", *(_xor([F.col("bits")[i * step + k] for k in range(step)]).alias(f"s{i}") for i in range(FOLD)))
    one = rows.groupBy("doc_id").agg(F.count("*").alias("k"), *(F.min(f"s{i}").alias(f"s{i}") for i in range(FOLD)))
    return one.select(F.col("doc_id").alias("sid"), *(F.when(F.col("k") == 1, F.col(f"s{i}")).alias(f"s{i}") for i in range(FOLD)))


def _xor(parts: list[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out.bitwiseXOR(part)
    return out


def _linked(docs: DataFrame, signed: DataFrame, shared: DataFrame | None, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of ``pairs(x, y)`` whose sets reach the similarity num / den; written, so that the sets can go.

    ``shared`` has the prefixes in which matches are still to be counted; without it they have been.
    """
    dealt, hot = _dealt(pairs)
    pairs = cut(_likely(signed, dealt, hot, num, den), "join-likely")
    if shared is not None:
        likely, pairs = pairs, cut(_matched(shared, pairs, hot, num, den), "join-matched")
        drop_cut(likely)
    ids = cut(_ids(pairs).distinct(), "join-ids")
    sets = cut(_sets(docs, ids, width), "join-sets")
    both = _met(pairs, hot, sets)
    common = F.size(F.array_intersect("x_grams", "y_grams")).cast("long")
    whole = F.size("x_grams").cast("long") + F.size("y_grams")
    links = cut(both.where(common * (den + num) >= num * whole).select("x", "y").distinct(), "join-links")
    for used in (pairs, ids, sets, hot):
        drop_cut(used)
    return links


def _packed() -> Column:
    """The place of an n-gram in its document's order, the document's number of n-grams and of matches, in one number."""
    return F.shiftleft(F.col("at").cast("long"), 31).bitwiseOR(F.shiftleft(F.col("n"), 3)).bitwiseOR(F.col("ell").cast("long"))


def _unpacked(c: str) -> list[Column]:
    low = F.col(c).bitwiseAND(F.lit((1 << 31) - 1))
    return [F.shiftright(low, 3).alias("n"), low.bitwiseAND(F.lit(7)).cast("int").alias("ell"), F.shiftright(c, 31).cast("int").alias("at")]


def _alpha(n: Column, m: Column, num: int, den: int) -> Column:
    """The overlap that two sets of n and m need."""
    return F.ceil(F.lit(num) * (n + m) / F.lit(den + num))


def _may_match(a: str, b: str, num: int, den: int) -> Column:
    """Whether a shared n-gram counts: it stands in both prefixes for this pair's overlap and number of matches."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    slack = F.least(f"{a}.ell", f"{b}.ell") - _alpha(n, m, num, den)
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (F.col(f"{a}.at") < n + slack) & (F.col(f"{b}.at") < m + slack)


def join(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles and component_id.

    Documents are linked if their sets of ``width``-word n-grams have a Jaccard similarity of num / den at least.
    component_id is the least id that links reach, the document's own included. A null text or one without words has
    no n-grams and no links; fewer words than the width make one n-gram of the whole. Rows with the same id are one
    document, linked by any of their texts; a row without an id is linked with nothing and has no component. An empty
    table gives an empty one. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    small_tasks(docs.sparkSession)
    scan = cut(_scan(docs, width), "join-scan")
    rows = scan.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "digest")
    signed = scan.where("kind = 0 and a is not null and b > 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "bits")
    sketch = np.zeros(SKETCH, np.int64)
    sums = scan.where("kind = 1").groupBy("a").agg(F.sum("b").alias("b")).toArrow()
    sketch[sums.column("a").to_numpy()] = sums.column("b").to_numpy()
    classes = cut(rows.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "join-classes")

    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    first = _prefixes(docs, width, sketch, num, den).join(reps.hint("shuffle_merge"), "doc_id", "left_semi")
    grams = first.select("doc_id", "n", "ell", F.posexplode("grams").alias("at", "gram")).select("gram", "doc_id", _packed().alias("meta"))
    # the hub of an n-gram: the document in whose order it stands first, as near copies put their own changes before it
    hubs = grams.groupBy(F.col("gram").alias("g")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min(F.struct("meta", "doc_id")).alias("hub")).where("lo < hi").select("g", "hub")
    both = cut(grams.join(hubs.hint("shuffle_merge"), F.col("gram") == F.col("g")).select("gram", "doc_id", "meta", F.col("hub.doc_id").alias("hub_id"), F.col("hub.meta").alias("hub_meta")), "join-shared")
    shared = both.select("gram", "doc_id", *_unpacked("meta"))
    a = both.select("doc_id", F.struct(*_unpacked("meta")).alias("a"), "hub_id", F.struct(*_unpacked("hub_meta")).alias("b"))
    pairs = a.where((F.col("doc_id") != F.col("hub_id")) & _may_match("a", "b", num, den))
    pairs = cut(pairs.select(F.least("doc_id", "hub_id").alias("x"), F.greatest("doc_id", "hub_id").alias("y")).distinct(), "join-pairs")
    links = _linked(docs, signed, shared, pairs, width, num, den)

    # the same with a hub among the documents outside the largest component of an n-gram; then all that are left
    for last in (False, True):
        comps = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "join-components")
        placed = shared.join(comps, F.col("doc_id") == F.col("node"), "left").select("gram", "doc_id", "n", "ell", "at", F.coalesce("comp", "doc_id").alias("comp"))
        sizes = placed.groupBy("gram", "comp").agg(F.count("*").alias("k"), F.min(F.struct("at", "doc_id", "n", "ell")).alias("best"))
        mixed = sizes.groupBy(F.col("gram").alias("g")).agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1").select("g", F.col("top.comp").alias("top"))
        if last:
            known = placed.join(_folded(signed), F.col("doc_id") == F.col("sid"), "left").drop("sid")
            open_ = cut(known.join(mixed, F.col("gram") == F.col("g")).drop("g"), "join-open")
            bits = [(F.col(f"a.s{i}"), F.col(f"b.s{i}")) for i in range(FOLD)]
            alike = F.coalesce(_may_reach(bits, F.col("a.n") + F.col("b.n"), num, den), F.lit(True))
            a, b = open_.where("comp <> top").alias("a"), open_.alias("b")
            met = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.comp") != F.col("b.comp")) & ((F.col("b.comp") == F.col("b.top")) | (F.col("a.doc_id") < F.col("b.doc_id"))) & _may_match("a", "b", num, den) & alike)
            met = met.select(F.least("a.doc_id", "b.doc_id").alias("x"), F.greatest("a.doc_id", "b.doc_id").alias("y"), F.least("a.ell", "b.ell").alias("ell"))
            more = met.groupBy("x", "y").agg(F.count("*").alias("k"), F.max("ell").alias("ell")).where("k >= ell").select("x", "y")
        else:
            rest = sizes.join(mixed, F.col("gram") == F.col("g")).where("comp <> top").groupBy(F.col("gram").alias("g")).agg(F.min(F.struct("best", "comp")).alias("hub"))
            b = rest.select("g", F.col("hub.comp").alias("hub_comp"), F.col("hub.best").alias("b"))
            met = placed.join(b, F.col("gram") == F.col("g")).where(F.col("comp") != F.col("hub_comp")).select("doc_id", F.struct("n", "ell", "at").alias("a"), "b")
            more = met.where(_may_match("a", "b", num, den)).select(F.least("doc_id", "b.doc_id").alias("x"), F.greatest("doc_id", "b.doc_id").alias("y")).distinct()
        more = cut(more.join(pairs, ["x", "y"], "left_anti"), "join-more")
        links = links.union(_linked(docs, signed, None if last else shared, more, width, num, den))
        pairs = pairs.union(more)
    comps = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "join-components")

    out = rows.join(classes, "digest", "left").join(comps, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "rep", "doc_id")).alias("component_id"))
