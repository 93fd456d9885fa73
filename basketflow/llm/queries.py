"""The operators over their whole tables, with the parameters for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import archives, bpe_codec, host_rules, line_crf, merkle, minhash_join, mixing, projection_forest, stream_dedup, surrogates, token_alignment, token_counts, url_filters
from basketflow.llm.common import table

#: For tests and demonstrations; a real run passes a secret of its own.
SURROGATE_KEY = b"a key for demonstrations"
COUNTING_TOKENIZER, ENCODING_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(COUNTING_TOKENIZER), limit=2048)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(ENCODING_TOKENIZER))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replaced(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", "entities", F.size("entities").alias("n_entities"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.embedding_links(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.through_archives(table(spark, sf_dir, "pages"))


def op10_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, similarity=80)


def op11_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = map(public_tokenizers.path, (ENCODING_TOKENIZER, PIECE_TOKENIZER))
    return token_alignment.aligned_documents(table(spark, sf_dir, "documents"), *files)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_bpe_round_trip,
        op3_surrogates,
        op4_host_rules,
        op5_projection_forest,
        op6_url_filters,
        op7_mixing,
        op8_line_crf,
        op9_archives,
        op10_minhash_join,
        op11_stream_dedup,
        op12_token_alignment,
        op13_merkle_manifest,
    )
}
