"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    chat,
    infill,
    languages,
    lm,
    packing,
    phrases,
    pieces,
    quality,
    shards,
    simhash,
    substrings,
    topk,
    windows,
)
from fareloom.llm.common import crc_fold, ship

PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_check(_documents(spark, sf_dir), tokenizer_path(PIECE_MODEL))


def op2_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_documents(spark, sf_dir), crc_fold(F.col("doc_id"), 7) == 2)


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(_documents(spark, sf_dir), [1.0] * 40, [1.0] * 41)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op6_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir), keep=["doc_id"])


def op7_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op8_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_examples(turns.unionByName(more)))


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER))


def op10_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = languages.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_documents(spark, sf_dir))


def op12_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.pack(_documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.measured(infill.fill_in_middle(_documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_sentencepiece_dropout,
        op2_block_topk,
        op3_simhash_balls,
        op4_pitman_yor,
        op5_rendezvous_shards,
        op6_divergence_rules,
        op7_repeated_windows,
        op8_prefix_targets,
        op9_best_fit,
        op10_word_backoff,
        op11_son_phrases,
        op12_concat_and_cut,
        op13_fill_in_middle,
    )
}
