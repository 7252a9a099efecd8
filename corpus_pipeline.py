"""A corpus pipeline of text operators: four stages keep documents, the last one packs them.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; what it
returns is written as Parquet and read again as the next one's docs. All but the last return
the columns of `documents`. Documents without an id leave in the first stage, of
documents that repeat an id one stays; null texts are empty texts throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.llm import exact_dedup, packing, quality, toxicity, vptree
from openends.llm.common import read, tokenizer_path, unique
from openends.sources.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose doc_id is in `kept`, with their columns."""
    columns = [F.col(f"`{name}`") for name in docs.columns]
    return unique(docs).join(kept.select("doc_id"), "doc_id", "left_semi").select(columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps, learned from labels.quality."""
    judged = quality.quality(docs, read(spark, sf_dir, "labels"))
    return _kept(docs, judged.filter("kept"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic, learned from labels.toxic."""
    scored = toxicity.toxicity(docs, read(spark, sf_dir, "labels"))
    return _kept(docs, scored.filter("predicted = 0"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    return _kept(docs, exact_dedup.exact_duplicates(docs).filter("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Groups are those of `op5_simhash_dedup`: fingerprints within two bits, found by the vantage-point tree.
    """
    groups = vptree.simhash_groups(docs, radius=2, size=3)
    return _kept(docs, groups.filter("doc_id = component_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document left, with its place in a sequence of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("packing", packed),
]

# Trained models, fingerprints and a tokenizer: not for SQL. Tests hold the near copies against
# all pairs of fingerprints and union-find, and the run against its stages; the fitted models have no plain version of their own.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole of `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
