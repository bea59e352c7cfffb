"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.

Null texts go in the first stage. Texts that a later stage cuts down to nothing stay as empty texts: they are
near-duplicates of each other, so the one with the smallest id stays. Documents with a null id take part in every stage; of a component of
near-duplicates whose ids are all null one document stays. Repeated rows are exact copies. Without documents the result is
empty; without benchmark items nothing is cut. Further columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.llm import decontaminate, language, lines, packing, simhash
from ratinglens.llm.common import crc_remainder
from ratinglens.llm.tokens import tokenizer_file
from ratinglens.session import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found for sure stay.

    Null texts and texts without letters go, and texts that the machines place with a smaller score than any labelled text, or
    stretch of one, whose language they found.
    """
    labels = docs.select("doc_id", "lang").where(crc_remainder("doc_id", 3) != 1)
    model = language.train(docs, labels)
    found = language.identify(docs, model)
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= model.least)
    return found.where(sure).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five or more sources share are cut, but for their first place; n_chars follows the text."""
    cut = lines.drop_shared_lines(docs, min_sites=5)
    return _with_length(cut.drop("_n_lines", "_n_removed"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, words=4, radius=4)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a benchmark window covers are cut; n_chars follows the text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(decontaminate.remove_leaks(docs, benchmark, window=10), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=1, capacity=4096)


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_boilerplate),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("best-fit packing", pack_sequences),
]

#: The stages use tokenizers and fitted models, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
