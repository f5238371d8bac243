"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.common import read_table
from tidemark.llm.context_tree import score_texts
from tidemark.llm.conversations import conversation_digests, damage
from tidemark.llm.extraction import extract_main_text
from tidemark.llm.language import identify_language
from tidemark.llm.ngram_join import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.postings import nearest_neighbours
from tidemark.llm.quality import score_quality
from tidemark.llm.recipes import dedup_exact
from tidemark.llm.surrogates import replace_personal_data
from tidemark.llm.warc import archive_pages
from tidemark.llm.whitening import whiten

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# A user of the library passes a secret of their own; this one makes results repeatable.
SURROGATE_KEY = "tidemark"
# So short that a good part of ordinary pages is cut into continuation records and put together again.
SEGMENT_BYTES = 4_096
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=75, count_links=True)


def op2_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read_table(spark, sf_dir, "pages"), smallest_revisit=0, segment_bytes=SEGMENT_BYTES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=2, size=4096, keep_ids=False, added_tokens=True)


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, SURROGATE_KEY)


def op5_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(read_table(spark, sf_dir, "documents"))


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), depth=5)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_encode(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read_table(spark, sf_dir, "documents"))


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op10_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(damage(read_table(spark, sf_dir, "conversations")))


def op12_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"), components=4).drop("eigenvalue")


def op13_cut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


# Base 32 of the SHA-1: each five hex digits are twenty bits, four digits of base 32.
OP2_SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), digested AS (
    SELECT page_id, payload, list_aggregate(list_transform(range(32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + (CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS INTEGER)
                >> CAST(15 - 5 * (k % 4) AS INTEGER)) % 32, 1)), 'string_agg', '') AS digest
    FROM payloads
), placed AS (
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes, digest,
        min(page_id) OVER (PARTITION BY payload) AS first_page
    FROM digested
)
SELECT page_id, payload_bytes, digest AS payload_digest,
    CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM placed
"""

# Equal texts and the row that stays, as one window over the text without white space.
OP5_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
    FROM documents
), grouped AS (
    SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
        first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id) AS keep_id
    FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM grouped
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_warc_segments": op2_warc_segments,
        "op3_packing": op3_packing,
        "op4_surrogates": op4_surrogates,
        "op5_chunk_recipes": op5_chunk_recipes,
        "op6_context_tree": op6_context_tree,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_language_codes": op8_language_codes,
        "op9_posting_lists": op9_posting_lists,
        "op10_quality_discriminant": op10_quality_discriminant,
        "op11_audit_repair": op11_audit_repair,
        "op12_spectrum_whitening": op12_spectrum_whitening,
        "op13_cut_extraction": op13_cut_extraction,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_segments": OP2_SQL, "op5_chunk_recipes": OP5_SQL}
