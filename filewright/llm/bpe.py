"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary (compress, hash and displace): a pre-token that is a whole
vocabulary entry costs one hash and one comparison. Tier two, for the rest, merges the bytes of the pre-token: they
stand in a doubly linked list, a heap yields the pair of least rank (the leftmost of ties), and a merge relinks the
list. Both tiers work on distinct pre-tokens; a bounded cache in each Python worker repeats them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from filewright.llm.common import share, small_batches, worker_state

CACHE_ENTRIES = 200_000
_LOW = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one line for each entry, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys to n slots, with the key kept to reject strangers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.n = n = len(ranks)
        self.buckets = m = max(1, n // 4)
        groups: list[list[tuple[int, bytes]]] = [[] for _ in range(m)]
        for key in ranks:
            h = xxhash.xxh3_128_intdigest(key)
            groups[(h >> 64) % m].append((h & _LOW, key))
        self.shift = np.zeros(m, np.int64)
        self.keys: list[bytes | None] = [None] * n
        free = n - 1
        for at in sorted(range(m), key=lambda b: -len(groups[b])):
            group = groups[at]
            if not group:
                break
            if len(group) == 1:  # any free slot will do; it is stored itself, as a negative number
                while self.keys[free] is not None:
                    free -= 1
                self.shift[at] = -free - 1
                self.keys[free] = group[0][1]
                continue
            d = 1
            while True:
                slots = {self._slot(h, d) for h, _ in group}
                if len(slots) == len(group) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.shift[at] = d
            for h, key in group:
                self.keys[self._slot(h, d)] = key
        self.ranks = [ranks[k] for k in self.keys]
        self.shift = self.shift.tolist()

    def _slot(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15 & _LOW)) * 0xD6E8FEB86659FD93 & _LOW) % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_128_intdigest(key)
        d = self.shift[(h >> 64) % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(h & _LOW, d)
        return self.ranks[slot] if self.keys[slot] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece that is no entry: repeatedly merge the pair of least rank, the leftmost of ties."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged into the part before it
    prev = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop or mid >= stop:
            continue  # one of the two parts has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (before := prev[i]) >= 0 and (r := ranks.get(piece[before:stop])) is not None:
            heapq.heappush(heap, (r, before, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Encodes texts to packed ids and decodes them; keeps a bounded cache of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, pattern: str):
        self.ranks, self.table, self.split = ranks, table, regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        outer = self

        class Cache(dict):
            def __missing__(self, piece: str) -> bytes:
                raw = piece.encode()
                rank = outer.table.get(raw)
                packed = struct.pack("<I", rank) if rank is not None else np.array(merge(raw, outer.ranks), "<u4").tobytes()
                if len(raw) <= 64:
                    if len(self) >= CACHE_ENTRIES:
                        self.clear()
                    self[piece] = packed
                return packed

        self.cache = Cache()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.split(text or "")))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_TABLES: dict[str, tuple[dict[bytes, int], PerfectHash]] = {}


def _tables(path: str) -> tuple[str, dict[bytes, int], PerfectHash]:
    """A vocabulary's digest, ranks and perfect hash; the driver builds them once."""
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()
    if digest not in _TABLES:
        ranks = load_ranks(path)
        _TABLES[digest] = ranks, PerfectHash(ranks)
    return digest, *_TABLES[digest]


def encode(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns a row for each row of ``docs``: the id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` the
    ids themselves (array<int>). A null text counts as empty (no ids); repeated rows stay repeated rows; an empty
    table gives an empty table; other columns are ignored. ``vocabulary`` is read on the driver and broadcast: its
    size is that of the file, whatever the data. A match longer than the cache's bound is encoded but not cached.
    """
    spark = docs.sparkSession
    small_batches(spark)
    digest, *tables = _tables(vocabulary)
    tables = share(spark, tables)
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = [pa.field(id_col, to_arrow_type(docs.schema[id_col].dataType)), pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    if keep_ids:
        fields.append(pa.field("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    ddl = f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches):
        codec = worker_state(f"bpe {digest} {pattern}", lambda: Codec(*tables.value, pattern))
        for batch in batches:
            rows = [[], [], []]
            ids = []
            for text in batch.column(1).to_pylist():
                packed = codec.encode(text)
                rows[0].append(len(packed) // 4)
                rows[1].append(hashlib.sha256(packed).hexdigest())
                rows[2].append(hashlib.sha256(codec.decode(packed)).hexdigest())
                if keep_ids:
                    ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, f.type) for r, f in zip(rows, fields[1:4])), *([pa.array(ids, fields[4].type)] if keep_ids else [])], schema=schema)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl)
