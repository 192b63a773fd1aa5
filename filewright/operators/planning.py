"""Work lists: what is stale, what was never processed, and what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filewright.functions.scalars import backoff


def stale(updates: DataFrame, processed: DataFrame, key: str = "cik") -> DataFrame:
    """Updated after they were last processed, latest first."""
    rows = updates.join(processed.select(key, "last_processed"), key).where("last_update > last_processed")
    return rows.orderBy(F.desc("last_update"), key)


def unprocessed(updates: DataFrame, processed: DataFrame, key: str = "cik") -> DataFrame:
    """Never processed, latest first."""
    return updates.join(processed, key, "left_anti").orderBy(F.desc("last_update"), key)


def work_list(updates: DataFrame, processed: DataFrame, key: str = "cik") -> DataFrame:
    """Both, without order: one join serves the two."""
    rows = updates.join(processed.select(key, "last_processed"), key, "left").where("last_processed is null or last_update > last_processed")
    return rows.select(key, "last_update", F.when(F.col("last_processed").isNull(), "unprocessed").otherwise("stale").alias("reason"))


def counts(work: DataFrame) -> DataFrame:
    """A7."""
    return work.groupBy("reason").agg(F.count("*").alias("n"))


def marker(results: DataFrame, today: Column, key: str = "cik", retry_later: bool = True) -> DataFrame:
    """Rows of a processed_* table from (key, success): a failure counts as processed a year from now, or today."""
    failed = backoff(today) if retry_later else today
    return results.select(key, F.date_format(F.when(F.col("success"), today).otherwise(failed), "yyyy-MM-dd").alias("last_processed"), "success")
