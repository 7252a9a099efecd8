"""Texts to unit vectors, each distinct text encoded once."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openends.errors import EncoderConfigError
from openends.functions import text as tx
from openends.functions import vectors as vx
from openends.operators.lookup import attach_lookup
from openends.sources import cache as vector_cache

log = logging.getLogger("openends")

Encoder = Callable[[list[str]], np.ndarray]


@dataclass(frozen=True)
class EncoderSettings:
    """How texts become vectors. `encode` maps a list of texts to a matrix."""

    model: str
    dim: int
    encode: Encoder | None = None
    batch_size: int = 16
    max_tries: int = 5
    backoff_seconds: float = 1.5
    instruction: str | None = None


def retrying(settings: EncoderSettings) -> Encoder:
    """The encoder with exponential backoff; setup errors are not tried again."""

    def call(texts: list[str]) -> np.ndarray:
        for attempt in range(settings.max_tries):
            try:
                matrix = np.asarray(settings.encode(texts), dtype=np.float32)
                break
            except EncoderConfigError:
                raise
            except Exception:
                if attempt + 1 == settings.max_tries:
                    raise
                wait = settings.backoff_seconds * 2**attempt
                log.warning("encoder failed, next try in %.1f s", wait, exc_info=True)
                time.sleep(wait)
        if matrix.ndim != 2 or len(matrix) != len(texts):
            raise EncoderConfigError(
                f"the encoder returned shape {matrix.shape} for {len(texts)} texts"
            )
        if matrix.shape[1] < settings.dim:
            raise EncoderConfigError(
                f"output dimension {settings.dim} exceeds the encoder's {matrix.shape[1]}"
            )
        return matrix

    return call


def _encode_batches(settings: EncoderSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = retrying(settings)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            kept = batch.drop_columns(["text"])
            # One output per encoder call keeps memory at batch_size vectors.
            for start in range(0, len(texts), settings.batch_size):
                part = texts[start : start + settings.batch_size]
                matrix = encode(part)
                offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
                vectors = pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))
                rows = kept.slice(start, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, vectors], names=[*rows.schema.names, "vector"]
                )

    return run


def encode_texts(keyed: DataFrame, settings: EncoderSettings) -> DataFrame:
    """Replace `text` by `vector`: unit, cut to the dimension, unit again."""
    kept = [c for c in keyed.columns if c != "text"]
    text = tx.apply_instruction(F.col("text"), settings.instruction)
    if settings.encode is None:
        return keyed.select(*kept, vx.hashed_vector(text, settings.dim).alias("vector"))
    schema = T.StructType(
        [keyed.schema[c] for c in kept] + [T.StructField("vector", T.ArrayType(T.FloatType()))]
    )
    raw = keyed.select(*kept, text.alias("text")).mapInArrow(_encode_batches(settings), schema)
    return truncated_vectors(unit_vectors(raw), settings.dim)


def distinct_texts(rows: DataFrame, settings: EncoderSettings) -> DataFrame:
    """(key, text, n_rows) per distinct text; copies are combined before the shuffle."""
    return (
        rows.groupBy("text")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            tx.content_key(
                F.col("text"), settings.model, settings.dim, settings.instruction
            ).alias("key"),
            "text",
            "n_rows",
        )
    )


def embed_segments(
    segments: DataFrame, settings: EncoderSettings, cache_path: str | None = None
) -> DataFrame:
    """Add a `vector` column to segments.

    The built-in encoder is a row-local expression, so it needs neither
    deduplication nor a join. For any other encoder each distinct text is encoded
    once; with a cache path only unknown texts are, and their vectors are written
    before they are used, so no later step can run the encoder again.
    """
    if settings.encode is None and cache_path is None:
        text = tx.apply_instruction(F.col("text"), settings.instruction)
        return segments.withColumn("vector", vx.hashed_vector(text, settings.dim))
    wanted = distinct_texts(segments.select("text"), settings)
    if cache_path is None:
        vectors = encode_texts(wanted, settings)
    else:
        spark = segments.sparkSession
        cached = vector_cache.read_cache(spark, cache_path)
        batch = vector_cache.next_batch(cached)
        unknown = vector_cache.misses(wanted.select("key", "text"), cached)
        vector_cache.append_cache(encode_texts(unknown, settings), cache_path, batch)
        vectors = vector_cache.lookup(wanted, vector_cache.read_cache(spark, cache_path))
    keyed = segments.withColumn(
        "key",
        tx.content_key(F.col("text"), settings.model, settings.dim, settings.instruction),
    )
    row_hash = F.xxhash64("segment_id", "row_seq")
    sizes = wanted.select("key", "n_rows")
    joined = attach_lookup(keyed, vectors.drop("text"), ["key"], row_hash, sizes=sizes)
    return joined.drop("key")


def check_dimension(vectors: DataFrame, dim: int) -> DataFrame:
    """Shortest and longest vector and whether the wanted dimension fits."""
    return vectors.agg(
        F.min(F.size("vector")).alias("shortest"),
        F.max(F.size("vector")).alias("longest"),
        F.count(F.lit(1)).alias("n_vectors"),
    ).withColumn("dim_ok", F.col("shortest") >= dim)


def unit_vectors(vectors: DataFrame, column: str = "vector") -> DataFrame:
    """Replace a vector column by unit vectors."""
    return vectors.withColumn(column, vx.normalize(F.col(column)))


def truncated_vectors(vectors: DataFrame, dim: int, column: str = "vector") -> DataFrame:
    """Replace a vector column by its first `dim` elements as unit vectors."""
    return vectors.withColumn(column, vx.truncate(F.col(column), dim))

