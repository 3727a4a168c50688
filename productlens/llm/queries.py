"""One registered query per operator: ``(spark, sf_dir) -> DataFrame`` over the operator's whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from productlens.llm import (collocations, decontamination, hmm, html_text, nearest, oracle, quality, sentencepiece_codec,
                             sharding, simhash, tasks, token_counts, toxicity, url_filters, vector_codes)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digest(table(spark, sf_dir, "documents"))


def sentencepiece_digest(docs: DataFrame) -> DataFrame:
    """doc_id, number of ids, and the digests of the ids and of the text they decode to."""
    pieces = sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return pieces.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


KEEP_FROM = 0.3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), folds=5)
    return quality.score(docs, model).select(
        "doc_id", tasks.held_out(F.col("doc_id"), 5).alias("held_out"), "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_text.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


# The rules of the URL query, and the sites that its block list names (those that the given tables hold).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_ZONES = ["example.com", "example.net", "example.org"]
LISTED_URLS = [(f"{site}.{zone}", "/", "block") for site in LISTED_SITES for zone in LISTED_ZONES]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = spark.createDataFrame([(*r, True) for r in URL_RULES] + [(*r, False) for r in LISTED_URLS],
                                     "host string, path string, verdict string, is_rule boolean")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), listings, canonical=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
            .withColumn("over_limit", F.col("n_tokens") > 512))


def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), folds=10)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, _ = toxicity.train(docs, table(spark, sf_dir, "labels"), folds=5)
    return toxicity.score(docs, model).select(
        "doc_id", tasks.held_out(F.col("doc_id"), 5).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top(collocations.collocations(table(spark, sf_dir, "documents")), 2000)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality": op2_quality,
    "op3_html_text": op3_html_text,
    "op4_url_filters": op4_url_filters,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_token_counts": op7_token_counts,
    "op8_hmm": op8_hmm,
    "op9_nearest": op9_nearest,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_toxicity": op12_toxicity,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op4_url_filters": oracle.url_filters(URL_RULES, LISTED_URLS),
    "op11_vector_codes": oracle.VECTOR_CODES,
    "op13_collocations": oracle.COLLOCATIONS,
}
