"""Registered queries of this package: each applies its operator to the whole of its table and derives digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.llm import (
    decontaminate,
    language,
    licenses,
    lines,
    neighbours,
    packing,
    quality,
    ranking,
    simhash,
    substrings,
    token_files,
    toxicity,
    variants,
)
from ratinglens.llm.common import crc_remainder
from ratinglens.llm.tokens import tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), words=4, radius=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), end_id=1, capacity=4096)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_shards(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return token_files.read_documents(manifest)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), window=35, digest=True)
    return kept.withColumnRenamed("kept", "kept_sha256")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_shared_lines(documents(spark, sf_dir).select("doc_id", "text", "source"), min_sites=5)
    return cut.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_remainder("doc_id", 5) != 0)
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels), keep_text=False)
    return scored.select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_leaks(documents(spark, sf_dir).select("doc_id", "text"), benchmark, window=10, keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("item_ids", 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = docs.select("doc_id", "lang").where(crc_remainder("doc_id", 3) != 1)
    found = language.identify(docs.select("doc_id", "text"), language.train(docs, labels), keep_text=False)
    return found.select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.pmod("id", F.lit(50)) == 0, k=5)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranking.rank_documents(documents(spark, sf_dir).select("doc_id", "text"), benchmark, top=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir).select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository top; it uses this package

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_dedup,
        op2_best_fit_packing,
        op3_token_files,
        op4_license_scan,
        op5_substring_dedup,
        op6_line_dedup,
        op7_toxicity,
        op8_decontamination,
        op9_quality_rules,
        op10_language_id,
        op11_nearest_vectors,
        op12_ranked_search,
        op13_spelling_variants,
        pipeline,
    )
}
SQL: dict[str, str] = {
    "op5_substring_dedup": substrings.sql(window=35),
    "op6_line_dedup": lines.SQL,
    "op8_decontamination": decontaminate.sql(window=10),
    "op9_quality_rules": quality.sql(),
    "op12_ranked_search": ranking.sql(top=10),
}
