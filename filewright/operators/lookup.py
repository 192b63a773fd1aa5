"""Lookups, searches, thresholds, top-k and relationship joins (P*, J*, O*), as functions on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SECURITY_FLAGS = ["is_equity", "is_debt", "is_option", "is_security_to_be_acquired", "is_pooled_investment", "is_tenant_in_common", "is_mineral_property", "is_business_combination", "is_other"]


def search(df: DataFrame, **criteria) -> DataFrame:
    """Rows equal to all criteria (null matches null); without criteria, all rows."""
    return df.where(reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.lit(v)) for k, v in criteria.items()))) if criteria else df


def get(df: DataFrame, **key) -> DataFrame:
    """The row of a primary key."""
    return search(df, **key).limit(1)


def above(df: DataFrame, column: str, than: float) -> DataFrame:
    """P5: known values strictly above a threshold; the predicate reaches the scan."""
    return df.where(F.col(column).isNotNull() & (F.col(column) > than))


def present(df: DataFrame, column: str) -> DataFrame:
    """Known values above zero."""
    return df.where(F.col(column) > 0)


def by_flag(df: DataFrame, flag: str, value, flags: list[str] = SECURITY_FLAGS) -> DataFrame:
    """Rows by one of a closed list of flags."""
    if flag not in flags:
        raise ValueError(f"{flag} is none of {flags}")
    return df.where(F.col(flag) == F.lit(value))


def first_by(df: DataFrame, order: list, **criteria) -> DataFrame:
    """The first match in a stated order."""
    return search(df, **criteria).orderBy(*order).limit(1)


def exists(df: DataFrame, other: DataFrame, on: list[str] | str) -> DataFrame:
    """The rows that have a match."""
    return df.join(other, on, "left_semi")


def insert_if_absent(new: DataFrame, target: DataFrame, pk: list[str], skip: Column, order: list) -> DataFrame:
    """The rows to insert: not skipped, not in the target, the first of each key."""
    fresh = new.where(~F.coalesce(skip, F.lit(False))).join(target.select(*pk), pk, "left_anti")
    first = fresh.withColumn("__n", F.row_number().over(Window.partitionBy(*pk).orderBy(*order)))
    return first.where("__n = 1").drop("__n")


def traverse(junction: DataFrame, dimension: DataFrame, key: str, entity: dict | None = None, relation: str | None = None) -> DataFrame:
    """The dimension rows that a junction leads to; a row for each edge, dangling edges go."""
    edges = search(junction, **(entity or {}))
    if relation is not None:
        edges = edges.where(F.col("relation_name") == relation)
    return edges.join(dimension, key)


def describe(df: DataFrame, dimension: DataFrame, on: Column, description: str, name: str) -> DataFrame:
    """Rows with the description of a code, null without a match."""
    return df.join(dimension, on, "left").select(*(df[c] for c in df.columns), dimension[description].alias(name))


def nest(parent: DataFrame, child: DataFrame, on: list[str], name: str, columns: list[str]) -> DataFrame:
    """Rows with their children as a sorted array (empty without any); children are grouped before the join."""
    grouped = child.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
    out = parent.join(grouped, on, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(grouped.schema[name].dataType)))


def top_k(df: DataFrame, order: list, k: int = 10) -> DataFrame:
    """O2: the first k rows, by a heap in each task."""
    return df.orderBy(*order).limit(k)


def top_k_each(df: DataFrame, by: list[str], order: list, k: int = 10) -> DataFrame:
    """O2 for every key: Spark prunes to k rows of a key before the exchange."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= k).drop("__n")
