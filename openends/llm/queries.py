"""One query per text operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    html_text,
    jaccard_join,
    packing,
    phrases,
    quality,
    quotes,
    simhash,
    token_files,
    toxicity,
    vptree,
)
from openends.llm.common import read, tokenizer_path

WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return simhash.edit_digest(docs, queries=F.col("doc_id") % 50 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(read(spark, sf_dir, "conversations"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.simhash_groups(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(WORDS), 2048)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"), keep="largest")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), tokenizer_path(BYTES))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), tokenizer_path(WORDS))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(read(spark, sf_dir, "documents"), percent=80, size=5)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), least=10, covered=50, top=2000)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, anchors=F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_quotes": op4_quotes,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_files": op8_token_files,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_phrases": op12_phrases,
    "op13_hard_negatives": op13_hard_negatives,
}
