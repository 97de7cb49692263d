"""The queries of the operators, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (
    decontaminate, html_text, kdsearch, kdshards, licenses, lines, packing, secrets, simhash, spelling, substrings, toxicity,
    whitening,
)
from tessera.llm.common import sha256_hex, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    return kdsearch.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs, "found").select(
        "doc_id", "found.n_words", "found.n_base", "found.first_word", "found.last_word",
        F.array_join("found.base_labels", ",").alias("base_labels"),
        F.array_join("found.labels", ",").alias("labels"), "found.score")


@query
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents"))


@query
def op5_kd_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return kdshards.shard(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity of every document; ``toxic`` documents are the rejected ones."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rated, name = toxicity.rate(docs, table(spark, sf, "labels"))
    return rated.select("doc_id", f"{name}.severity", f"{name}.grade", toxicity.toxic(name).alias("toxic"))


@query
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf, "benchmark"), "found")
    items = F.array_sort("found.items")
    return marked.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        sha256_hex(F.array_join(items, ",")).alias("items_sha256"),
        decontaminate.contaminated("found").alias("contaminated"))


@query
def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages").select("page_id", "url", "html"), "found").select(
        "page_id", "url", "found.text", "found.n_chars")


@query
def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        sha256_hex(secrets.listed("base")).alias("base_sha256"), secrets.listed("spans").alias("spans"))


@query
def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


@query
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(vectors, whitening.fit(vectors), "w")
    entries = F.arrays_zip(F.col("w.whitened").alias("whitened"), F.col("w.explained").alias("explained"))
    return white.select("vec_id", "w.n", "w.deviation", "w.identity_error", F.posexplode(entries).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


@query
def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.remove_repeated_lines(docs, "made").select(
        "doc_id", "made.n_lines", "made.n_dropped", sha256_hex(F.col("made.text")).alias("kept_sha256"))


@query
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf, "documents"), noise=97))
