"""What the training-data operators share: words, hashes, written cuts of the lineage, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_OWN_DIRS: dict[str, str] = {}
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018  other C libraries have none
except (OSError, AttributeError):
    _LIBC = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own; a cluster must name one.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="filewright-")
    return "file://" + _OWN_DIRS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/filewright/{label}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder; a path that is gone, or a session that ended, is no error."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have stopped already
        return


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later work doesn't depend on its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._filewright_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Remove what ``cut`` wrote, once nothing reads it any more."""
    if path := getattr(df, "_filewright_path", None):
        remove_path(df.sparkSession, path)


def small_batches(spark: SparkSession, rows: int = 256, size: int = 4 << 20) -> None:
    """Bound what one Arrow batch of whole texts holds, in rows and in bytes (a longer text is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


#: What AQE merges small shuffle partitions up to: a task fetches and sorts about as much at a time.
TASK_BYTES = 16 << 20


def small_tasks(spark: SparkSession, most: int = TASK_BYTES) -> None:
    """Bound what AQE merges into one task of an exchange; a smaller setting of the session stays."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > most:
        spark.conf.set(key, str(most))


def text_bytes(name: str = "text") -> Column:
    """A text as its UTF-8 bytes; null stays null."""
    return F.col(name).cast("binary")


#: Bits of the filter in ``split_by``, at least and at most: one megabyte to 32, whatever the data.
FILTER_BITS, MOST_FILTER_BITS = 1 << 23, 1 << 28


def filter_bits(n: int) -> int:
    """Bits for a filter of n keys: sixteen or so for each, within the bounds."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, 1 << (16 * n).bit_length()))


def split_by(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(maybe, never): the rows of ``df`` whose key may be among ``wanted``'s, and those whose key certainly isn't.

    A bitmap of hashed keys, of a fixed size, is broadcast; so a join of wide rows with few keys needn't exchange
    the rows that can't match. A null key is never wanted. With more keys than bits nearly all rows are maybe, which
    is right all the same.
    """
    bit = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits)) + 1
    marks = wanted.where(F.col(wanted_key).isNotNull()).select(bit(wanted_key).alias("b"))
    bitmap = marks.groupBy(F.bitmap_bucket_number("b").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("__bitmap"))
    at = F.bitmap_bit_position(bit(key))
    byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2.0), at % 8)), F.lit(2)) == 1, F.lit(False))
    marked = df.join(F.broadcast(bitmap), F.bitmap_bucket_number(bit(key)) == F.col("__bucket"), "left").withColumn("__maybe", found)
    return marked.where("__maybe").select(*df.columns), marked.where("NOT __maybe").select(*df.columns)


def trim() -> None:
    """Give memory that this Python worker no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


#: Of n rows, a key that holds more than n over this many, and more than a hundred, is hot: so there are fewer hot keys.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, side: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join of ``rows`` with ``side(keys, n, ...)``, whose n says how many of the rows have each key.

    Hot keys, HOT_KEYS at most by their definition, are broadcast, so that no task gets all rows of one.
    """
    side = cut(side, "counted")
    total = side.agg(F.sum(n)).first()[0] or 0
    most = max(100, total // HOT_KEYS)
    hot = F.broadcast(side.where(F.col(n) > most).drop(n))
    mild = side.where(F.col(n) <= most).drop(n).hint("shuffle_merge")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(mild, keys))


_SHARED: list = []


def share(spark: SparkSession, value):
    """Broadcast a value. The executors let go of what earlier operators broadcast; a later task of theirs fetches it again."""
    while _SHARED:
        old = _SHARED.pop()
        if old._jbroadcast is not None and spark.sparkContext._jsc is not None:
            try:
                old.unpersist()
            except Exception:  # noqa: BLE001  of a session that has ended
                continue
    out = spark.sparkContext.broadcast(value)
    _SHARED.append(out)
    return out


_WORKER: dict = {}


def worker_state(name: str, build):
    """What a task of an operator keeps in its Python worker; a worker holds the state of one operator at a time."""
    if name not in _WORKER:
        _WORKER.clear()
        trim()
        _WORKER[name] = build()
    return _WORKER[name]


def release_worker_state() -> None:
    """Let go of another operator's state, in a task of an operator that keeps none: workers outlive a job."""
    if _WORKER:
        _WORKER.clear()
        trim()


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


_MIX = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> _S33)
    x = x * _MIX
    x ^= x >> _S33
    x *= _MIX2
    x ^= x >> _S33
    return x


def rolling(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of every ``width`` consecutive numbers of ``h``.

    Built by doubling: the hash of 2n numbers is hash(first n) * base**n + hash(next n).
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    have, have_len, block, block_len = None, 0, h, 1
    left = width
    while left:
        if left & 1:
            if have is None:
                have, have_len = block, block_len
            else:
                factor = np.uint64(pow(base, block_len, 1 << 64))
                size = len(have) - block_len
                # the blocks used later stand to the right of those used earlier
                have = have[:size] * factor + block[have_len : have_len + size]
                have_len += block_len
        left >>= 1
        if left:
            factor = np.uint64(pow(base, block_len, 1 << 64))
            block = block[:-block_len] * factor + block[block_len:]
            block_len *= 2
    return have[:n]


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive numbers."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    step = 1
    while step * 2 <= width:
        a = np.minimum(a[:-step], a[step:])
        step *= 2
    return np.minimum(a[:n], a[width - step : width - step + n])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, comp) for each node that has an edge.

    comp is the least node of the component. Each round joins every group with the least neighbouring group
    (followed one step further), then contracts the edges to groups; groups at least halve. Rounds are cut by
    written tables; nothing is collected but the number of edges left.
    """
    spark = edges.sparkSession
    edges = cut(edges.select("a", "b").where("a <> b").distinct(), label)
    nodes = cut(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("comp", F.col("node")), label)
    left = edges.count()
    while left:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        jump = least.alias("x").join(least.select(F.col("a").alias("to"), F.col("to").alias("to2")), "to", "left").select(F.col("a").alias("comp"), F.least("to", F.coalesce("to2", "to")).alias("to"))
        jump = cut(jump, label)
        new_nodes = cut(nodes.join(jump, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), label)
        new_edges = cut(
            edges.join(jump.select(F.col("comp").alias("a"), F.col("to").alias("x")), "a").join(jump.select(F.col("comp").alias("b"), F.col("to").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(),
            label,
        )
        for old in (nodes, edges, jump):
            drop_cut(old)
        nodes, edges = new_nodes, new_edges
        left = edges.count()
    drop_cut(edges)
    return nodes
