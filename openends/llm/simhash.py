"""SimHash fingerprints of documents and a search by permuted block tables, in built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openends.llm.common import texts
from openends.llm.votes import as_hex, differing_bits, fingerprints
from openends.sources.shared import stored

BITS = 64
# Ids are put in order in so many ranges, each by one task: narrow rows, which may spill.
ID_RANGES = 256


def weighted_terms(docs: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keys` and the arrays h, w: hashes and weights of the word triples of every text.

    Words are what white space separates, in lower case; a text of fewer words is one
    term. Long triples name a text better than triples of common short words, so a
    triple weighs 1, 2 or 3 by its length. Repeats are counted again.
    """
    words = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    rows = docs.select(*keys, words.alias("words"))
    triple = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
        lambda i: F.concat_ws(" ", F.slice("words", i + 1, 3)),
    )
    none = F.array().cast("array<string>")
    rows = rows.select(*keys, F.when(F.size("words") > 0, triple).otherwise(none).alias("terms"))
    length = lambda t: F.least(F.floor(F.octet_length(t) / 10), F.lit(2)) + 1
    return rows.select(
        *keys,
        F.transform("terms", lambda t: F.xxhash64(t)).alias("h"),
        F.transform("terms", length).alias("w"),
    )


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint). Equal texts have equal fingerprints; no words: 0.

    Rows without an id are left out, rows that repeat an id count once, null texts are empty.
    """
    return _simhash(texts(docs, id_col, text_col))


def _simhash(docs: DataFrame) -> DataFrame:
    return fingerprints(weighted_terms(docs), "h", "w")


def likeness(left: Column, right: Column) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return 1.0 - differing_bits(left, right) / F.lit(float(BITS))


def block_keys(fingerprint: Column, radius: int, blocks: int) -> Column:
    """One key per table of the permuted block tables, as an array of (table, key).

    The bits are cut into `blocks` runs. Two fingerprints with at most `radius` differing
    bits agree on at least `blocks - radius` runs, so there is a table for every choice of
    that many runs: its permutation brings them to the front and the front is the key.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("take 0 <= radius < blocks <= 64")
    keys = [
        F.struct(F.lit(t).alias("table"), fingerprint.bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
        for t, m in enumerate(_masks(radius, blocks))
    ]
    return F.array(*keys)


def near_fingerprints(
    queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int = 5
) -> DataFrame:
    """All pairs (query, fingerprint) with at most `radius` differing bits, each once.

    Both inputs have a column `fingerprint` with distinct values. A pair that
    meets in several tables is taken from the first of them, so none is lost and
    nothing has to be made distinct.
    """
    tables = lambda df, name: df.select(
        F.col("fingerprint").alias(name),
        F.explode(block_keys(F.col("fingerprint"), radius, blocks)).alias("k"),
    ).select(name, "k.table", "k.key")
    q, r = tables(queries, "query"), tables(rows, "fingerprint")
    apart = F.col("query").bitwiseXOR(F.col("fingerprint"))
    masks = _masks(radius, blocks)
    earlier = F.lit(False)
    for table, mask in enumerate(masks[:-1]):
        agrees = apart.bitwiseAND(F.lit(mask).cast("bigint")) == 0
        earlier = earlier | ((F.col("table") > table) & agrees)
    near = q.join(r, ["table", "key"]).filter((F.bit_count(apart) <= radius) & ~earlier)
    return near.select("query", "fingerprint", F.bit_count(apart).alias("bits"))


def _masks(radius: int, blocks: int) -> list[int]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    found = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        found.append(mask - ((mask >> 63) << 64))
    return found


def next_ids(rows: DataFrame) -> DataFrame:
    """Add next_id: the next higher doc_id, for the highest the lowest of all.

    Ids are cut into ranges by their quantiles; each range is ordered on its own, and the
    last id of a range is followed by the first of the next range that has any. The cuts and the
    first ids, at most ID_RANGES of each, pass through the driver.
    """
    fractions = [(i + 1) / ID_RANGES for i in range(ID_RANGES - 1)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", fractions, 10_000)).first()[0] or []))
    cut_at = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    placed = rows.withColumn("part", F.size(F.filter(cut_at, lambda c: c < F.col("doc_id"))))
    firsts = placed.groupBy("part").agg(F.min("doc_id").alias("first")).collect()
    after: list[int | None] = [None] * (len(cuts) + 1)
    following = min((r["first"] for r in firsts), default=None)
    for part, first in sorted(((r["part"], r["first"]) for r in firsts), reverse=True):
        after[part], following = following, first
    own = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    first_after = F.get(F.array(*[F.lit(x).cast("bigint") for x in after]), F.col("part"))
    return placed.withColumn("next_id", F.coalesce(own, first_after)).drop("part")


def edited_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, n_chars, edited): the last quarter replaced by the next text's start.

    The last floor(n_chars / 4) code points go; as many come from the start of the next
    document by doc_id, or all it has. Texts are dealt by id once, for both sides of the
    exchange of starts; only the starts move a second time.
    """
    rows = docs.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"))
    order = stored(next_ids(rows), "order")
    take = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = order.select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("by"), take.alias("take")
    )
    starts = docs.join(wanted, "doc_id").select(
        F.col("by").alias("doc_id"), F.substring("text", F.lit(1), F.col("take")).alias("start")
    )
    joined = docs.join(order, "doc_id").join(starts, "doc_id")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - take)
    return joined.select("doc_id", "next_id", "n_chars", F.concat(kept, "start").alias("edited"))


def edit_digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = 3,
    blocks: int = 5,
    queries: Column | None = None,
) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are.

    Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next and, for the documents that `queries` names (all by default),
    n_near: how many other documents have a fingerprint within `radius` bits, found in the
    block tables among all documents; null for the others.

    Null texts are empty, rows without an id are left out, rows that repeat an id count
    once, an only document is its own next one, an empty table gives no rows.
    """
    plain = texts(docs, id_col, text_col)
    own = stored(_simhash(plain), "fingerprints")
    edited = edited_texts(plain).select(
        "doc_id", "next_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.col("edited").alias("text"),
    )
    keys = ["doc_id", "next_id", "n_chars", "sha"]
    changed = fingerprints(weighted_terms(edited, keys), "h", "w", keys)
    changed = changed.withColumnRenamed("fingerprint", "edited_fingerprint")
    following = own.select(F.col("doc_id").alias("next_id"), F.col("fingerprint").alias("next_fp"))
    asked = own.filter(F.lit(True) if queries is None else queries)
    counts = own.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_docs"))
    near = near_fingerprints(asked.select("fingerprint").distinct(), counts, radius, blocks)
    near = near.join(counts, "fingerprint").groupBy("query").agg(F.sum("n_docs").alias("n"))
    found = asked.join(near, asked["fingerprint"] == near["query"]).select(
        "doc_id", (F.col("n") - 1).alias("n_near")
    )
    rows = changed.join(own, "doc_id").join(following, "next_id").join(found, "doc_id", "left")
    return rows.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )
