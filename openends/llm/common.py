"""What the text operators share: reading tables, one row per document, number of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def unique(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by key (doc_id unless others are named), without rows that lack one, each key once.

    Of rows with the same key the greatest stays, comparing `text`, if there is one, and then
    the other columns in order (null is lowest; columns with maps by their JSON). The reduction shuffles whole rows, so it runs only where a key
    does repeat; that is found out from the key columns alone.
    """
    keys = keys or ("doc_id",)
    rows = rows.dropna(subset=list(keys))
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    others = [c for c in rows.columns if c not in keys]
    if repeated.isEmpty():
        return rows
    if not others:
        return rows.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    order = F.struct(
        *[
            F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) if "map<" in kinds[c] else F.col(f"`{c}`")
            for c in sorted(others, key=lambda c: c != "text")
        ]
    )
    reduced = rows.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return reduced.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`") for c in rows.columns])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with one row per document and no null text."""
    named = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return unique(named)


def hashed_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About `size` rows, all if there are no more: those whose key's hash is small.

    Which rows are chosen depends on their keys only; nothing is sorted or gathered.
    """
    n = rows.count()
    if n <= size:
        return rows
    limit = (1 << 40) * size // n
    return rows.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < limit)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is on this machine; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)
