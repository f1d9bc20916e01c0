"""The registered queries of this subpackage, each with its SQL counterpart if there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.bin_completion import pack_fewest
from martloom.llm.common import documents
from martloom.llm.conversation_repair import conversations, damage, repair_report
from martloom.llm.exact_dedup import dedup_report, new_index
from martloom.llm.hard_negatives import embeddings, mine_hard_negatives, relabelled
from martloom.llm.jaccard_join import jaccard_components
from martloom.llm.license_scan import scan_licenses
from martloom.llm.oracles import HARD_NEGATIVES_SQL, JACCARD_SQL, REPAIR_SQL, license_sql
from martloom.llm.packing import pack_documents
from martloom.llm.quality_classifier import classify, fit, read_labels
from martloom.llm.quality_rules import judge_documents
from martloom.llm.secret_scan import scan_secrets
from martloom.llm.sentencepiece_fst import encoding_report
from martloom.llm.sharding import assign_shards
from martloom.llm.token_files import new_folder, token_file_digest, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_OF_DOCUMENT, END_OF_PACKED, END_OF_FILE_DOCUMENT = 0, 1, 2
#: Ids in a sequence of the fewest.
WINDOW = 4096


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


@query(
    "op2_exact_dedup",
    r"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS content FROM documents
    ), digests AS (
        SELECT doc_id, length(content) AS points,
               sha256(regexp_replace(content, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM texts
    ), grouped AS (
        SELECT text_sha256, count(*) AS group_size,
               arg_min(doc_id, (-points, doc_id)) AS keep_id
        FROM digests GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM digests JOIN grouped USING (text_sha256)
    """,
)
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return dedup_report(docs, new_index(docs))


# The checksum runs over the bytes with a table of 256 remainders, itself made by the rule.
RENDEZVOUS_SQL = f"""
    WITH remainders AS (
        SELECT list(r ORDER BY b) AS t FROM (
            SELECT b, list_reduce(
                list_prepend(b::BIGINT, range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            ) AS r FROM range(256) AS bytes(b))
    ), texts AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
    ), rows AS (
        SELECT doc_id, length(digits) // 2 + 16 AS size,
               xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                       regexp_extract_all(digits, '..'), lambda d: ('0x' || d)::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
               )) AS text_crc32
        FROM texts, remainders
    ), bids AS (
        SELECT doc_id, shard,
               -ln((('0x' || left(md5(doc_id || ':' || shard), 13))::BIGINT + 1) / 2.0 ** 52)
               AS cost
        FROM rows, range({SHARDS} + 1) AS shards(shard)
    ), best AS (
        SELECT doc_id,
               arg_min(shard, (cost, shard)) FILTER (shard < {SHARDS}) AS shard,
               arg_min(shard, (cost, shard)) AS grown_shard
        FROM bids GROUP BY doc_id
    )
    SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
           row_number() OVER (
               PARTITION BY shard ORDER BY md5(concat_ws(':', doc_id, size, text_crc32))
           ) - 1 AS slot,
           grown_shard::INT AS grown_shard
    FROM rows JOIN best USING (doc_id)
    """


@query("op6_rendezvous_shards", RENDEZVOUS_SQL)
def op6_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(documents(spark, folder), [1.0] * SHARDS, added=[1.0])


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return classify(docs, fit(docs, read_labels(spark, folder)))


@query("op4_retrieval_packing")
def op4_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder), BYTE_BPE, END_OF_DOCUMENT)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = new_folder(spark)
    write_token_files(documents(spark, folder), files, BYTE_BPE, END_OF_FILE_DOCUMENT)
    return token_file_digest(spark, files)


@query("op7_license_scan", license_sql())
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(documents(spark, folder))


@query("op9_compression_rules")
def op9_compression_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_documents(documents(spark, folder))


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(documents(spark, folder))


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_report(documents(spark, folder), PIECES)


@query("op8_jaccard_join", JACCARD_SQL)
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(documents(spark, folder))


@query("op12_conversation_repair", REPAIR_SQL)
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations(spark, folder)
    return repair_report(damage(rows), rows)


@query("op13_hard_negatives", HARD_NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return mine_hard_negatives(relabelled(embeddings(spark, folder)), F.col("vec_id") % 100 == 0)


@query("op11_bin_completion")
def op11_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return pack_fewest(documents(spark, folder), WORD_BPE, END_OF_PACKED, WINDOW)
