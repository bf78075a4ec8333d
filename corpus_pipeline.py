"""From raw documents to packed sequences: five stages over the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import languages, packing, quality, simhash, substrings
from fareloom.llm.common import ship, written
from fareloom.llm.queries import WORD_TOKENIZER, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Least probability of a document's language.
LEAST_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship(spark)
    return quality.passing(docs).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a sure enough language, which becomes their ``lang``."""
    ship(spark)
    found = languages.identify(docs, F.lit(True))
    sure = (F.col("lang_pred") != languages.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(sure).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the least id.

    Groups, shingles and differing bits are those of ``simhash.near_duplicates``. Rows
    without an id stay, and rows with one id are one document.
    """
    ship(spark)
    found = simhash.near_duplicates(docs)
    copies = found.where(F.col("doc_id") > F.col("component_id")).select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that documents with smaller ids hold.

    Texts that lose words become their kept words, joined by one blank, and
    documents that lose all their words go; other texts stay as they are.
    """
    ship(spark)
    cleaned = substrings.remove_repeats(docs).where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return (
        cleaned.withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*docs.columns)
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Token ids and sampled models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i}")
    return docs
