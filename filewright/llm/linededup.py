"""Boilerplate lines by their frequency within a site.

Documents are grouped by host. A line's frequency is the number of the host's pages that contain it divided by the
number of the host's pages; a line above the ratio is boilerplate there and is dropped from every page of the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filewright.llm.common import cut, filter_bits, split_by

RATIO = 0.1
#: Boilerplate lines of all hosts, at most, that every task gets as a whole: 16 bytes each and the host names.
BROADCAST_LINES = 500_000
#: Parts that a host's pages are dealt in where there are more lines.
SALTS = 16


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; null without one."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _key(line: Column) -> Column:
    """A line by two hashes: lines are counted and compared by 128 bits."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """(host, lines): for each host, the keys of its boilerplate lines.

    A host's pages hold, in the mean, m distinct lines; as each boilerplate line takes more than ``ratio`` of the
    pages, a host has fewer than m / ratio of them, so the array is short however many pages the host has.
    """
    pages = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    lines = pages.where("text is not null").select("host", F.explode(F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), _key))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    return (
        counts.join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("n") > F.col("pages") * ratio).groupBy("host").agg(F.collect_list("line").alias("lines"))
    )


def _with_lines(docs: DataFrame, found: DataFrame, host: Column, text_col: str, broadcast_lines: int) -> DataFrame:
    """``docs`` and __lines, the boilerplate of its host (null where it has none). Texts don't move if they needn't.

    A short list, counted first, is broadcast. With a long one, the pages of hosts that a bitmap says have no
    boilerplate stay where they are; the others are joined in SALTS parts of each host.
    """
    found = cut(found.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"), F.xxhash64("host").alias("__key")), "linededup-lines")
    size = found.agg(F.count("*"), F.sum(F.size("__lines"))).first()
    if (size[1] or 0) <= broadcast_lines:
        return docs.join(F.broadcast(found.drop("__key")), host.eqNullSafe(F.col("__host")), "left").drop("__host")
    maybe, never = split_by(docs.withColumn("__at", F.xxhash64(host)), "__at", found, "__key", filter_bits(size[0]))
    parts = found.select("__host", "__lines", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__part")).hint("shuffle_merge")
    salt = F.pmod(F.xxhash64(F.col(text_col)), F.lit(SALTS)).cast("int")
    joined = maybe.withColumn("__salt", salt).join(parts, host.eqNullSafe(F.col("__host")) & (F.col("__salt") == F.col("__part")), "left")
    whole = never.withColumn("__lines", F.lit(None).cast(found.schema["__lines"].dataType))
    return joined.drop("__host", "__part", "__salt", "__at").unionByName(whole.drop("__at"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with its boilerplate lines dropped from the text, and two more columns: n_lines and n_dropped.

    Lines are separated by a line feed; blank lines are never boilerplate. Frequencies are of the host's pages that
    contain the line, once a page, over all its pages (a page without text counts). However few pages a host has, the
    share decides, but a line on one page alone is never boilerplate. A null host is a host of its own; a null
    text stays null with no lines; repeated rows are pages each; a very long text is judged line by line like any
    other; an empty table gives an empty one. Every row and every other column stays (n_lines and n_dropped are replaced).
    """
    docs = docs.drop("n_lines", "n_dropped")
    found = boilerplate(docs, host_col, text_col, ratio)
    rows = _with_lines(docs, found, F.col(host_col).cast("string"), text_col, broadcast_lines)
    has = F.col("__lines").isNotNull() & F.col(text_col).isNotNull()
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("__lines"), _key(x)))
    rows = rows.withColumn("__kept", F.when(has, kept))
    total = F.when(F.col(text_col).isNotNull(), F.size(lines)).otherwise(0).cast("long")
    return rows.select(
        *(F.when(has, F.array_join("__kept", "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns),
        total.alias("n_lines"), F.when(has, total - F.size("__kept")).otherwise(0).cast("long").alias("n_dropped"),
    )
