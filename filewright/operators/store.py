"""Typed tables and keyed writes (K*, U*, A6): upsert, insert-if-absent, delete, update, consistency.

A table is a folder of versions, each a set of Parquet files, and a pointer to the current one. A write reads the
current version, writes the next and then moves the pointer; readers never see half a write, and a job that dies
leaves the table as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SEQ = "__seq"


@dataclass(frozen=True)
class TableSpec:
    """A table: name, schema as DDL, primary key, and the columns that its files are clustered by."""

    name: str
    ddl: str
    pk: tuple[str, ...]
    cluster: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def last_writer(df: DataFrame, pk: list[str], order: str = SEQ) -> DataFrame:
    """Of each key the row with the greatest ``order``; an aggregate, so repeated writes shrink before the exchange."""
    rest = [c for c in df.columns if c not in pk]
    best = df.groupBy(*pk).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__r"))
    return best.select(*pk, *(F.col("__r")[c].alias(c) for c in rest)).select(*df.columns)


def upsert(existing: DataFrame, new: DataFrame, pk: list[str], order: str | None = None) -> DataFrame:
    """``new`` over ``existing``; among new rows of a key the greatest ``order`` wins, else any of them."""
    old = existing.withColumn(SEQ, F.struct(F.lit(0).alias("batch"), F.lit(None).cast(new.schema[order].dataType if order else "long").alias("at")))
    fresh = new.select(*existing.columns, F.struct(F.lit(1).alias("batch"), (F.col(order) if order else F.monotonically_increasing_id()).alias("at")).alias(SEQ))
    return last_writer(old.unionByName(fresh), pk).drop(SEQ)


def delete(df: DataFrame, keys: DataFrame, pk: list[str]) -> DataFrame:
    """U4: without the rows of the keys."""
    return df.join(keys.select(*pk).distinct(), pk, "left_anti")


def update(df: DataFrame, values: DataFrame, pk: list[str], column: str) -> DataFrame:
    """One column from ``values`` where the key is there."""
    new = values.select(*pk, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    out = df.join(new, pk, "left")
    return out.select(*(F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns))


def mismatches(a: DataFrame, b: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Pairs of rows that belong together but differ in one of the columns."""
    left, right = a.alias("a"), b.alias("b")
    pairs = left.join(right, reduce(lambda x, y: x & y, (F.col(f"a.{c}") == F.col(f"b.{c}") for c in on)))
    return pairs.where(reduce(lambda x, y: x | y, (~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns)))


def require_consistent(a: DataFrame, b: DataFrame, on: list[str], columns: list[str]) -> None:
    if mismatches(a, b, on, columns).limit(1).count():
        raise ValueError(f"rows that belong together differ in one of {columns}")


class Store:
    """The tables under a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _pointer(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}/_current"

    def _version(self, spec: TableSpec) -> str | None:
        fs, where = self._fs(self._pointer(spec))
        if not fs.exists(where):
            return None
        found = fs.listStatus(where)
        return max((s.getPath().getName() for s in found), default=None)

    def create(self, spec: TableSpec) -> None:
        """K3, L1: an empty table, unless it is there."""
        if self._version(spec) is None:
            self._write(spec, self.spark.createDataFrame([], spec.schema))

    def read(self, spec: TableSpec) -> DataFrame:
        """P4."""
        version = self._version(spec)
        if version is None:
            return self.spark.createDataFrame([], spec.schema)
        return self.spark.read.schema(spec.schema).parquet(f"{self.root}/{spec.name}/{version}")

    def _write(self, spec: TableSpec, df: DataFrame) -> None:
        before = self._version(spec)
        number = int(before.split("-")[0]) + 1 if before else 1
        version = f"{number:012d}-{uuid.uuid4().hex}"
        by = list(spec.cluster or spec.pk)
        df.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{self.root}/{spec.name}/{version}")
        fs, where = self._fs(f"{self._pointer(spec)}/{version}")
        fs.create(where, False).close()  # the pointer is the greatest name; to create it is atomic
        if before:
            fs.delete(self._fs(f"{self._pointer(spec)}/{before}")[1], False)
            # readers that hold the version before still find it; the one before that goes
            older = sorted(s.getPath().getName() for s in fs.listStatus(self._fs(f"{self.root}/{spec.name}")[1]))
            for name in older:
                if name[0].isdigit() and name < before:
                    fs.delete(self._fs(f"{self.root}/{spec.name}/{name}")[1], True)

    def staged(self, df: DataFrame) -> DataFrame:
        """``df`` written once beside the tables, so that several writes needn't work it out again."""
        path = f"{self.root}/_staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        fs, where = self._fs(f"{self.root}/_staged")
        fs.delete(where, True)

    def put(self, spec: TableSpec, rows: DataFrame, order: str | None = None) -> None:
        """K1, K2, U3."""
        self._write(spec, upsert(self.read(spec), rows, list(spec.pk), order))

    def insert_if_absent(self, spec: TableSpec, rows: DataFrame, order: list) -> None:
        from filewright.operators.lookup import insert_if_absent

        old = self.read(spec)
        self._write(spec, old.unionByName(insert_if_absent(rows, old, list(spec.pk), F.lit(False), order).select(*old.columns)))

    def delete(self, spec: TableSpec, keys: DataFrame) -> bool:
        """U4: whether there was anything to delete."""
        old = self.read(spec)
        there = old.join(keys.select(*spec.pk), list(spec.pk), "left_semi").limit(1).count() > 0
        if there:
            self._write(spec, delete(old, keys, list(spec.pk)))
        return there

    def update(self, spec: TableSpec, values: DataFrame, column: str) -> None:
        self._write(spec, update(self.read(spec), values, list(spec.pk), column))
