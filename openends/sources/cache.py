"""Vector cache: a parquet table (key, vector, batch) that only grows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, vector array<float>, batch bigint"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table; empty if nothing was written yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def append_cache(vectors: DataFrame, path: str, batch: int) -> None:
    """Add new vectors under a batch number; nothing is rewritten."""
    vectors.select(
        "key",
        F.col("vector").cast("array<float>").alias("vector"),
        F.lit(batch).cast("bigint").alias("batch"),
    ).write.mode("append").parquet(path)


def next_batch(cache: DataFrame) -> int:
    """Batch number after the latest one in the table."""
    return (cache.agg(F.max("batch")).first()[0] or 0) + 1


def latest(cache: DataFrame) -> DataFrame:
    """One vector per key; of several, the one of the latest batch."""
    return cache.groupBy("key").agg(F.max_by("vector", "batch").alias("vector"))


def misses(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """Keys (with their texts) that have no cached vector."""
    return keyed.join(cache.select("key"), "key", "left_anti")


def lookup(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """Vectors of the wanted keys (key, n_rows); duplicates go after the pruning."""
    return (
        cache.join(keyed.select("key", "n_rows"), "key")
        .groupBy("key", "n_rows")
        .agg(F.max_by("vector", "batch").alias("vector"))
    )


def hit_counts(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """Wanted keys, hits and misses."""
    hits = cache.select("key").distinct().withColumn("_hit", F.lit(True))
    return keyed.join(hits, "key", "left").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count("_hit").alias("n_hits"),
        F.count_if(F.col("_hit").isNull()).alias("n_misses"),
    )


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """Cache after adding a batch: new vectors win over old ones of the same key."""
    return latest(cache.unionByName(new))
