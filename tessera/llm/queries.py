"""The registered queries: one per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.centroids import cluster
from tessera.llm.chat import digests, format_conversations
from tessera.llm.common import table
from tessera.llm.decontamination import contaminated
from tessera.llm.exact_dedup import exact_groups
from tessera.llm.fingerprints import fingerprints
from tessera.llm.html_extract import extract
from tessera.llm.language_id import identify
from tessera.llm.lm_scoring import score
from tessera.llm.ngram_join import near_groups
from tessera.llm.packing import pack
from tessera.llm.url_filters import ORACLE as URL_ORACLE, captures_of, judge, list_of, validity
from tessera.llm.vector_codes import codes
from tessera.llm.vector_oracles import CENTROIDS as CENTROID_ORACLE, CODES as CODE_ORACLE
from tessera.llm.warc import read_archives, resolved, write_archives

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = r"\### Assistant: </turn> ok"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(spark, table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = judge(captures_of(pages), validity(list_of(pages)))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "valid_from")})


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark, table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(turns.unionByName(extra)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(spark, table(spark, sf_dir, "pages"))
    return resolved(spark, read_archives(manifest), manifest)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, table(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark, table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark, table(spark, sf_dir, "embeddings")).drop("n_compared")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_lm_scoring, op3_url_filters, op4_ngram_jaccard_join, op5_chat_formatting, op6_language_id,
    op7_html_extraction, op8_warc, op9_benchmark_decontamination, op10_exact_dedup,
    op11_document_fingerprints, op12_centroid_clustering, op13_vector_codes)}

ORACLES = {
    "op12_centroid_clustering": CENTROID_ORACLE,
    "op13_vector_codes": CODE_ORACLE,
    "op3_url_filters": URL_ORACLE,
    "op5_chat_formatting": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') AS body FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(body) + 15)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op8_warc": r"""
WITH t AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT html, min(page_id) AS first FROM t WHERE n >= 100 GROUP BY html)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(t.html) AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM t LEFT JOIN g ON t.html = g.html AND t.n >= 100""",
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)""",
}
