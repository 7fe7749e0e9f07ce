"""Documents to training tokens, in five stages.

``STAGES`` lists (name, function).  A function takes the session, the documents
that its predecessor kept and the folder of the other tables; all but the last
return the columns of ``documents``.  ``run`` writes each stage's rows to the
shared folder before the next one reads them, so a lost executor costs a part
of one stage at most.

Null and empty texts are judged by the classifier like any other, are copies of
nothing, hold no passages and no secrets, and have no tokens.  Repeated rows of
an id are one document, of which one row stays; rows without id stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import bpe, credentials, decontaminate, minhash, quality
from earshot.llm.tables import keep

#: No SQL can express the classifier or the tokenizer.
ORACLE_SQL = None

RANKS = "byte_bpe_50k.tiktoken"


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts; it learns from ``labels``."""
    return quality.drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies:
    sets of five words, similarity of 0.8 and more."""
    return minhash.drop_near_duplicates(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their secrets replaced by a mark, ``n_chars`` counted anew."""
    redacted = credentials.redact_secrets(docs)
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each row."""
    path = public_tokenizers.path(RANKS)
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", keep_good_text),
    ("near-duplicates", drop_near_copies),
    ("benchmark", drop_benchmark_text),
    ("secrets", redact_secrets),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
