"""A corpus pipeline of five of the training-data operators, from documents to token ids.

Each stage takes (spark, docs, sf_dir), where docs has the columns of documents, works on all that its predecessor
kept and returns a DataFrame; all but the last return the columns of documents. Between stages the rows are written
as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from filewright.llm import bpe, decontam, linededup, ngram_join, toxicity
from filewright.llm.common import cut, read_table, split_by


def _beside(docs: DataFrame, added: set[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``stage`` keeps, with the columns of ``docs``, also those named like what the stage adds."""
    own = {c: f"__own_{c}" for c in docs.columns if c in added}
    out = stage(docs.withColumnsRenamed(own))
    return out.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. Null and empty texts, rows without an id and repeated rows are scored like any other."""
    labels = read_table(spark, sf_dir, "labels")
    return _beside(docs, {"held_out", "score", "predicted"}, lambda d: toxicity.score(d, labels, toxicity.default_held_out()).where("predicted = 0"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; every document stays, and n_chars follows its text.

    A null text stays null, a null source is one source, repeated rows are documents each.
    """
    left = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return _beside(docs, {"n_lines", "n_dropped"}, lambda d: linededup.drop_boilerplate(d).withColumn("n_chars", left))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one of least id stays.

    Texts without words are linked with nothing, and rows without an id stay. Rows of one id are one document: they
    stay or go together.
    """
    gone = cut(ngram_join.join(docs, 5, 80, 100).where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "pipeline-copies")
    maybe, never = split_by(docs, "doc_id", gone, "__gone")
    return never.unionByName(maybe.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes that they decode to; a null text has none."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL can express neither the models nor the encoding; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on documents. An empty table gives an empty one with the columns of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
