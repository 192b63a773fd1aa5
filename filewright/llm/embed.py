"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products within them.

Centroids are fitted on a bounded sample; those within the threshold of each other share a cell, so a dense group is one
cell, however many centroids it draws. Every vector has a home, the cell of its nearest centroid. It looks into the
PROBES nearest cells at least, and into every cell that a vector at the threshold may call its home: there a neighbour's
cosines stray, and a cell is left out only if that takes more than STRAY standard deviations. A cell compares its homes with each other and with the vectors that look into it, as matrix
products of blocks of bounded size: a cell that holds a large part of all vectors becomes many tasks. A task returns
link counts and a spanning forest of its links, never its pairs. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filewright.llm.common import components, cut, join_counted, release_worker_state, share

THRESHOLD = 0.9
#: Cells, at least, that a vector looks into; how far a neighbour strays, in standard deviations.
PROBES, STRAY = 8, 1.5
#: Vectors, in the mean, to a cell; cells at most; vectors, at most, that fit the centroids.
CELL, MOST_CELLS, SAMPLE = 400, 8192, 20_000
#: Vectors of a block; an entry of a product takes 8 bytes.
BLOCK = 1024


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length 1, in double precision."""
    rows = flat.reshape(-1, dim).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit(rows: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means: k centroids of length 1. Cells left empty start anew at the worst placed vectors."""
    rng = np.random.default_rng(seed)
    k = min(k, len(rows))
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        home, near = np.empty(len(rows), np.int64), np.empty(len(rows))
        for at in range(0, len(rows), 4096):
            sims = rows[at : at + 4096] @ centres.T
            home[at : at + 4096] = sims.argmax(1)
            near[at : at + 4096] = sims.max(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, rows)
        empty = np.flatnonzero(np.linalg.norm(sums, axis=1) < 1e-9)
        sums[empty] = rows[np.argsort(near, kind="stable")[: len(empty)]]
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def merged(centres: np.ndarray, threshold: float) -> np.ndarray:
    """The cell of each centroid, from 0: chains of centroids within the threshold are one cell."""
    k = len(centres)
    near = np.concatenate([centres[at : at + 512] @ centres.T >= threshold for at in range(0, k, 512)])
    root = np.arange(k)
    while True:
        low = np.minimum(np.concatenate([np.where(near[at : at + 512], root, k).min(1) for at in range(0, k, 512)]), root)
        low = low[low]
        if (low == root).all():
            return np.unique(root, return_inverse=True)[1]
        root = low


def looks(rows: np.ndarray, centres: np.ndarray, cell_of: np.ndarray, threshold: float, probes: int) -> list[np.ndarray]:
    """For each vector the cells that it looks into, its home first.

    A vector with cosine t to y is t y + sqrt(1 - t^2) u with u across y: centroid c overtakes y's nearest one if u
    makes up t times the gap of their cosines with y. For u in any direction that is normal, with a deviation of the
    centroids' distance across y over sqrt(dim - 1).
    """
    order = np.argsort(cell_of, kind="stable")
    starts = np.searchsorted(cell_of[order], np.arange(cell_of.max() + 1))
    p, out = min(probes, len(starts)), []
    t = min(max(threshold, 0.0), 1.0)
    for at in range(0, len(rows), 256):
        sims = rows[at : at + 256] @ centres.T
        top = sims.argmax(1)
        gap = sims.max(1, keepdims=True) - sims
        across = np.sqrt(np.maximum(2 - 2 * (centres[top] @ centres.T) - gap**2, 0))
        within = t * gap <= STRAY * math.sqrt((1 - t * t) / max(1, rows.shape[1] - 1)) * across
        best = np.maximum.reduceat(sims[:, order], starts, axis=1)
        seen = np.logical_or.reduceat(within[:, order], starts, axis=1)
        np.put_along_axis(seen, np.argpartition(-best, p - 1, axis=1)[:, :p], True, 1)
        for i, home in enumerate(cell_of[top]):
            seen[i, home] = False
            out.append(np.concatenate([[home], np.flatnonzero(seen[i])]).astype(np.int32))
    return out


def _scan(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, digest, dim, vec): digest, dim and vec are null for vectors that link with nothing."""
    kind = table.schema[vec_col].dataType.elementType.simpleString()
    dtype = np.float32 if kind == "float" else np.float64
    schema = pa.schema([("vec_id", pa.int64()), ("digest", pa.binary()), ("dim", pa.int32()), ("vec", pa.binary())])

    def run(batches):
        release_worker_state()
        for batch in batches:
            digests, dims, vecs = [], [], []
            for value in batch.column(1):
                row = value.values.to_numpy(zero_copy_only=False).astype(dtype) if value.is_valid else np.empty(0, dtype)
                ok = len(row) and value.values.null_count == 0 and np.isfinite(row).all() and np.any(row != 0)
                if ok:
                    length = float(np.linalg.norm(row.astype(np.float64)))
                    ok = math.isfinite(length) and length > 0
                vecs.append(row.tobytes() if ok else None)
                dims.append(len(row) if ok else None)
                digests.append(hashlib.blake2b(vecs[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], schema=schema)

    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, digest binary, dim int, vec binary"), dtype


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, probes: int = PROBES, cell: int = CELL, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """A row for each row of ``table``: vec_id, n_links, component_id and kept.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more and one has its home among
    the cells that the other looks into, ``probes`` at least (recall is measured in the tests). component_id is the least id that links
    reach; the row of that id is kept. Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors of different lengths, are linked with nothing. Equal vectors (repeated rows too) are linked with each
    other and count as links one by one. A row without an id takes part in links, but is not kept and names no
    component. An empty table gives an empty one. Other columns are ignored.
    """
    spark = table.sparkSession
    scanned, dtype = _scan(table, id_col, vec_col)
    rows = cut(scanned, "embed-rows")
    classes = cut(rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("vec").alias("vec")), "embed-classes")
    links, edges = None, None
    for dim, n in classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect():
        one = classes.where(F.col("dim") == dim)
        part = _cells(spark, one, int(dim), int(n), dtype, threshold, probes, cell, sample, block)
        links = part if links is None else links.union(part)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links = cut(links, "embed-links")
    edges = links.where("toward is not null").select(F.col("digest").alias("a"), F.col("toward").alias("b"))
    comps = components(edges, "embed-components")
    counts = links.groupBy("digest").agg(F.sum("n").alias("n"))
    placed = cut(classes.select("digest", "rep", "copies").join(comps, F.col("digest") == F.col("node"), "left").select("digest", "rep", "copies", F.coalesce("comp", "digest").alias("comp")), "embed-components")
    least = placed.groupBy("comp").agg(F.min("rep").alias("least"), F.count("*").alias("size"))
    placed = join_counted(placed, least, ["comp"], "size").join(counts, "digest", "left").select("digest", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.select("vec_id", "digest").join(placed, "digest", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def _cells(spark, classes: DataFrame, dim: int, n: int, dtype, threshold: float, probes: int, cell: int, sample: int, block: int) -> DataFrame:
    """(digest, n, toward): link counts of vectors of one length, and the edges of spanning forests."""
    k = max(1, min(MOST_CELLS, math.ceil(n / cell)))
    some = classes.where(F.pmod(F.xxhash64("digest"), F.lit(n)) < sample).select("vec").limit(2 * sample).toArrow().column("vec").to_pylist()
    some = some or classes.select("vec").limit(1).toArrow().column("vec").to_pylist()
    fitted = fit(unit(np.frombuffer(b"".join(sorted(some)), dtype), dim), k)
    cell_of = merged(fitted, threshold)
    n_cells = int(cell_of.max()) + 1
    centres = share(spark, (fitted, cell_of))
    placed_schema = pa.schema([("digest", pa.binary()), ("copies", pa.int64()), ("vec", pa.binary()), ("cells", pa.list_(pa.int32()))])

    def place(batches):
        release_worker_state()
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = looks(unit(np.frombuffer(b"".join(batch.column("vec").to_pylist()), dtype), dim), *centres.value, threshold, probes)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("copies"), batch.column("vec"), pa.array(cells, pa.list_(pa.int32()))], schema=placed_schema)

    placed = cut(classes.select("digest", "copies", "vec").mapInArrow(place, "digest binary, copies long, vec binary, cells array<int>"), "embed-placed")
    seen = placed.select(F.posexplode("cells").alias("at", "cell")).groupBy("cell").agg(F.sum((F.col("at") == 0).cast("long")).alias("homes"), F.sum((F.col("at") > 0).cast("long")).alias("guests")).collect()
    home_blocks, guest_blocks = np.ones(n_cells, np.int64), np.ones(n_cells, np.int64)
    for r in seen:  # a row for each cell
        home_blocks[r.cell], guest_blocks[r.cell] = max(1, -(-r.homes // block)), max(1, -(-r.guests // (2 * block)))
    blocks = share(spark, (home_blocks, guest_blocks))
    task_schema = pa.schema([("task", pa.string()), ("role", pa.int32()), ("digest", pa.binary()), ("copies", pa.int64()), ("vec", pa.binary()), ("cells", pa.list_(pa.int32()))])

    def deal(batches):
        release_worker_state()
        homes, guests = blocks.value
        for batch in batches:
            tasks, roles, at = [], [], []

            def put(task: str, role: int, i: int) -> None:
                tasks.append(task)
                roles.append(role)
                at.append(i)

            for i, (digest, cells) in enumerate(zip(batch.column("digest").to_pylist(), batch.column("cells").to_pylist())):
                h = int.from_bytes(digest[:8], "little")
                c = cells[0]
                own = h % int(homes[c])
                for other in range(int(homes[c])):  # homes against homes, block by block
                    put(f"{c}/{min(own, other)}/{max(own, other)}", 0 if own <= other else 1, i)
                for g in range(int(guests[c])):  # homes wait for guests
                    put(f"{c}/{own}/g{g}", 0, i)
                for c in cells[1:]:
                    for b in range(int(homes[c])):
                        put(f"{c}/{b}/g{h % int(guests[c])}", 1, i)
            rows = batch.take(pa.array(at, pa.int64()))
            for begin in range(0, len(at), 8192):
                part = rows.slice(begin, 8192)
                yield pa.RecordBatch.from_arrays([pa.array(tasks[begin : begin + 8192]), pa.array(roles[begin : begin + 8192], pa.int32()), *(part.column(x) for x in ("digest", "copies", "vec", "cells"))], schema=task_schema)

    out_schema = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("toward", pa.binary())])

    def compare(group: pa.Table) -> pa.Table:
        role = group.column("role").to_numpy()
        digests, copies = np.array(group.column("digest").to_pylist(), object), group.column("copies").to_numpy()
        kind = group.column("task")[0].as_py().split("/")
        left, right = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        same = kind[1] == kind[2]
        if same:
            right = left
        if not len(left) or not len(right):
            return out_schema.empty_table()
        vectors = unit(np.frombuffer(b"".join(group.column("vec").to_pylist()), dtype), dim)
        linked = vectors[left] @ vectors[right].T >= threshold
        if same:
            np.fill_diagonal(linked, False)
        if kind[2][0] == "g":
            # a pair whose homes look into each other's cells is told in the lesser cell alone
            here, cells = int(kind[0]), group.column("cells").to_pylist()
            sees = np.zeros((len(left), len(right)), bool)
            home = np.array([cells[i][0] for i in right])
            for a, i in enumerate(left):
                sees[a] = np.isin(home, cells[i][1:])
            linked &= ~(sees & (home < here)[None, :])
        n = np.zeros(len(role), np.int64)
        np.add.at(n, left, linked @ copies[right])
        if not same:
            np.add.at(n, right, linked.T @ copies[left])
        root = np.arange(len(role))
        while True:
            low = root.copy()
            a = np.where(linked, root[right][None, :], len(role)).min(1)
            np.minimum.at(low, left, a)
            b = np.where(linked, low[left][:, None], len(role)).min(0)
            np.minimum.at(low, right, b)
            if (low == root).all():
                break
            root = low
        used = np.flatnonzero((n > 0) | (root != np.arange(len(role))))
        toward = [digests[root[i]] if root[i] != i else None for i in used]
        return pa.Table.from_arrays([pa.array(digests[used].tolist(), pa.binary()), pa.array(n[used]), pa.array(toward, pa.binary())], schema=out_schema)

    dealt = placed.mapInArrow(deal, "task string, role int, digest binary, copies long, vec binary, cells array<int>")
    return dealt.groupBy("task").applyInArrow(compare, "digest binary, n long, toward binary")
