"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import alignment, bpe, chat, credentials, decontaminate, licenses, merkle, minhash, pii, quality, suffixes, topk, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), words=4)


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf, "pages"))


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf, "documents")).drop("licenses")


def op4_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    found = topk.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    fits = F.col("score").between(-(2**63), 2**63 - 1)
    too_large = F.raise_error(F.lit("a score does not fit a long"))
    return found.withColumn("score", F.when(fits, F.col("score").cast("long")).otherwise(too_large))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return credentials.secret_digests(_table(spark, sf, "documents"))


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.benchmark_digests(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = chat.with_control_strings(_table(spark, sf, "conversations"))
    return chat.conversation_digests(chat.format_trees(chat.chain(turns)))


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(_table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


def op10_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_data_digests(_table(spark, sf, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf, "documents")).drop("kept")


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    bpe_path, piece_path = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_digests(_table(spark, sf, "documents"), bpe_path, public_tokenizers.PATTERN, piece_path)


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf, "documents")).drop("proof")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf).drop("ids")


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_minhash_dedup, op2_url_filter, op3_license_scan, op4_topk_search, op5_quality, op6_secret_scan,
            op7_decontaminate, op8_chat_format, op9_byte_bpe, op10_personal_data, op11_suffix_dedup, op12_token_alignment, op13_merkle_manifest,
            pipeline,
        )
    }
