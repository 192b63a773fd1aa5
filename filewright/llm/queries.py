"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from filewright.llm import bpe, decontam, embed, langid, linededup, ngram_join, pii, substring, toxicity, warc
from filewright.llm.common import read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"), toxicity.default_held_out())
    return out.select("doc_id", "held_out", "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS s, words FROM d WHERE len(words) >= 50
), h AS (
  SELECT doc_id, s, md5(array_to_string(words[s : s + 49], ' ')) AS h FROM w
), least AS (
  SELECT h, min(doc_id) AS lo FROM h GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM h JOIN least USING (h) WHERE doc_id > lo
), cut AS (
  SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(words) AS n, list_filter(words, lambda x, i: NOT list_contains(coalesce(cut, []), i)) AS kept FROM d LEFT JOIN cut USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read_table(spark, sf_dir, "documents"), 3, 90, 100)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.predict(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), langid.default_held_out())
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents")).drop("base")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN g.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first < p.page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 100
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents, with the source as the host: what is left of each text, as a digest."""
    rows = linededup.drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = f"""
WITH totals AS (
  SELECT source, count(*) AS pages FROM documents GROUP BY source
), lines AS (
  SELECT DISTINCT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL
), plate AS (
  SELECT l.source, list(l.line) AS lines FROM (SELECT source, line, count(*) AS n FROM lines WHERE trim(line) <> '' GROUP BY source, line HAVING count(*) > 1) l
  JOIN totals t ON l.source IS NOT DISTINCT FROM t.source WHERE l.n > t.pages * {linededup.RATIO} GROUP BY l.source
), split AS (
  SELECT d.doc_id, string_split(d.text, chr(10)) AS own, coalesce(p.lines, []) AS plate
  FROM documents d LEFT JOIN plate p ON d.source IS NOT DISTINCT FROM p.source
), kept AS (
  SELECT doc_id, own, list_filter(own, lambda x: trim(x) = '' OR NOT list_contains(plate, x)) AS kept FROM split
)
SELECT doc_id, CAST(coalesce(len(own), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(own) - len(kept), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM kept
"""


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE u AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return decontam.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_toxicity": op1_toxicity, "op2_substring_dedup": op2_substring_dedup, "op3_ngram_join": op3_ngram_join, "op4_language": op4_language, "op5_byte_bpe": op5_byte_bpe, "op6_pii": op6_pii, "op7_warc": op7_warc, "op8_line_dedup": op8_line_dedup, "op9_embedding_dedup": op9_embedding_dedup, "op10_decontamination": op10_decontamination}

ORACLE_SQL: dict[str, str] = {"op9_embedding_dedup": OP9_SQL, "op2_substring_dedup": OP2_SQL, "op7_warc": OP7_SQL, "op8_line_dedup": OP8_SQL}
