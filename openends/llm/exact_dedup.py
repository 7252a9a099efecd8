"""Exact duplicates by 128-bit content hash, with the bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.llm.common import ascii_lower, texts
from openends.sources.shared import stored

# Digests of repeated texts that may be sent to every task: 16 bytes each, some 50 MB
# in a hash table. Beyond that the texts are shuffled to the digests instead.
MAX_BROADCAST_DIGESTS = 500_000


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    max_broadcast: int = MAX_BROADCAST_DIGESTS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. `keep`
    names the id that stays, the "smallest" or the "largest" of a group.

    Digests are counted with map-side combining, so a hot text costs one row per task.
    Only texts whose digest repeats are read again and grouped by digest *and* bytes; map-side
    combining leaves one copy of a text per task to shuffle. A digest with a single
    text is proven free of collisions and its rows are answered by digest; rows of a digest with more
    texts are answered by the text itself. Rows join on narrow keys, which Spark splits
    where one of them is hot.

    Rows without an id are left out, rows that repeat an id count once (the one with
    the greatest text stays). An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    chosen = F.min if keep == "smallest" else F.max
    plain = texts(docs, id_col, text_col).select("doc_id", ascii_lower(F.col("text")).alias("text"))
    hashed = plain.withColumn("digest", F.unhex(F.md5("text")))
    rows = stored(
        hashed.select("doc_id", "digest", F.unhex(F.sha2("text", 256)).alias("sha")), "digests"
    )
    repeated = stored(
        rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"),
        "repeated",
    )
    small = repeated.count() <= max_broadcast
    copies = hashed.join(F.broadcast(repeated) if small else repeated, "digest", "left_semi")
    by_bytes = copies.groupBy("digest", "text").agg(
        F.count(F.lit(1)).alias("n"), chosen("doc_id").alias("keep_id")
    )
    groups = stored(
        by_bytes.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n_texts"),
            F.sum("n").alias("n"),
            chosen("keep_id").alias("keep_id"),
        ),
        "groups",
    )
    collided = groups.filter("n_texts > 1").select("digest")
    answered = rows.join(groups.filter("n_texts = 1").drop("n_texts"), "digest", "left")
    if not collided.isEmpty():
        of_collided = hashed.join(collided, "digest", "left_semi")
        own = of_collided.groupBy("digest", "text").agg(
            F.count(F.lit(1)).alias("n"), chosen("doc_id").alias("keep_id")
        )
        exact = of_collided.join(own, ["digest", "text"]).select(
            "digest", "doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), "n", "keep_id"
        )
        answered = answered.join(collided, "digest", "left_anti").unionByName(exact)
    keep_id = F.coalesce(F.col("keep_id"), F.col("doc_id"))
    return answered.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("bigint").alias("group_size"),
        (keep_id == F.col("doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
