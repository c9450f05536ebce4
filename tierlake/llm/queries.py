"""The operators over the given tables, each with the production parameters; SQL twins where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import (
    divergence,
    fingerprints,
    language_id,
    licences,
    packing,
    sentencepieces,
    simhash,
    substrings,
    token_counts,
    topk,
    toxicity,
    vector_codes,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents")).drop("matches")


@query
def op2_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


@query
def op5_sentencepiece(spark, sf_dir):
    return sentencepieces.encode(table(spark, sf_dir, "documents"), PIECES, with_ids=False)


@query
def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, with_ids=False)


@query
def op3_warc(spark, sf_dir):
    return warc.deduplicated_pages(table(spark, sf_dir, "pages"), min_bytes=0)


@query
def op4_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def is_held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~F.coalesce(is_held_out(), F.lit(False)))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    shares = F.transform("languages", lambda x: F.concat_ws(":", x["lang"], F.round(x["share"], 4)))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "unknown",
        F.concat_ws(",", shares).alias("shares"),
    ).withColumn("held_out", F.coalesce(is_held_out(), F.lit(False)))


@query
def op9_simhash(spark, sf_dir):
    found = simhash.groups(table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select(
        F.col("key").alias("doc_id"), simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query
def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = substrings.remove_repeats(docs, width=20, carry=["doc_id"], with_kept=False)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op11_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), least=3, best=200)


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.encode(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


@query
def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    eligible = ~F.coalesce(is_held_out(), F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), eligible)
    return toxicity.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.concat_ws(",", "matches.entry").alias("entries"),
    ).withColumn("held_out", F.coalesce(is_held_out(), F.lit(False)))
