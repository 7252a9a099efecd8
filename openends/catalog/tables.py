"""The given test tables as survey tables.

conversations -> raw responses: a respondent is a conversation, each block of five
                 turns is one ad, the turns of a block are its five answers
documents     -> long segments: respondent = source, ad = language
embeddings    -> segments with vectors, and anchor phrase vectors by label
events        -> ad labels;  labels -> judge replies on documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends import defaults
from openends.config import KEY_COLUMNS, Study
from openends.functions import vectors as vx

STUDY = Study()
THEME_NAMES = list(defaults.THEMES)
ANSWERS = [c for spec in defaults.THEMES.values() for c in spec["source_columns"]]
# Ads follow the data: so many conversations, or vectors, make one.
PER_AD = 10
VECTORS_PER_AD = 25
# Density topics of documents; buckets are fixed so that the SQL can name them at every size.
DENSITY = {"dim": 64, "radius": 0.35, "min_points": 3, "directions": 8, "tables": 5}
# The label tables name ten groups of vectors; they act as constructs here.
VECTOR_CONSTRUCTS = {f"c{i}": THEME_NAMES[i % 4] for i in range(10)}
# Common English words kept out of topic labels.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before "
    "being below between both but by can could did do does doing down during each few for "
    "from further had has have having he her here hers herself him himself his how i if in "
    "into is it its itself just me more most my myself no nor not now of off on once only or "
    "other our ours ourselves out over own same she should so some such than that the their "
    "theirs them themselves then there these they this those through to too under until up "
    "very was we were what when where which while who whom why will with would you your "
    "yours yourself yourselves"
).split()


def signs(axis: int, dim: int = 64) -> list[int]:
    """+1 or -1 per number of a vector, another pattern for each axis."""
    return [1 if (i + 1) * (2 * axis + 3) % 7 < 3 else -1 for i in range(dim)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, split as the scan splits it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide raw responses, as untidy as a survey export: all keys and orders are text."""
    turns = table(spark, sf_dir, "conversations").withColumns(
        {"block": F.floor(F.col("turn") / 5), "slot": F.col("turn") % 5}
    )
    wide = turns.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("text"))).alias(c) for i, c in enumerate(ANSWERS)]
    )
    ad = F.floor(F.col("conv_id") / PER_AD) + F.col("block")
    fraction = F.when(F.col("conv_id") % 3 == 0, ".7").otherwise("")
    keys = [
        F.concat(F.lit(" R"), F.col("conv_id"), F.lit(" ")),
        F.concat(F.lit("AD"), ad, F.lit("\t")),
        F.concat(F.lit(" Brand  "), ad % 5),
        F.concat(F.lit("Platform\n"), ad % 3),
        F.concat(F.lit(" "), F.col("block") + 1, fraction),
    ]
    return wide.select(
        *[k.alias(name) for k, name in zip(keys, KEY_COLUMNS, strict=True)],
        *[F.col(f"`{c}`") for c in ANSWERS],
    )


def document_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as long segments, whole texts."""
    docs = table(spark, sf_dir, "documents")
    themes = F.array(*[F.lit(t) for t in THEME_NAMES])
    return docs.select(
        F.concat(F.lit("D"), F.col("doc_id")).alias("segment_id"),
        "doc_id",
        F.col("doc_id").alias("row_seq"),
        F.col("source").alias("respondent_id"),
        F.col("lang").alias("ad_id"),
        F.element_at(themes, (F.length("text") % 4 + 1).cast("int")).alias("theme"),
        "text",
    )


def vector_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as scoreable segments, VECTORS_PER_AD of an ad."""
    themes = F.array(*[F.lit(t) for t in THEME_NAMES])
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("V"), F.col("vec_id")).alias("segment_id"),
        "vec_id",
        F.col("vec_id").alias("row_seq"),
        F.concat(F.lit("R"), F.col("vec_id") % VECTORS_PER_AD).alias("respondent_id"),
        F.concat(F.lit("AD"), F.floor(F.col("vec_id") / VECTORS_PER_AD)).alias("ad_id"),
        F.lit("b").alias("brand"),
        F.lit("p").alias("platform"),
        (F.col("vec_id") % 3 + 1).cast("int").alias("order_shown"),
        F.element_at(themes, F.col("label") % 4 + 1).alias("theme"),
        F.col("embedding").alias("vector"),
        F.lit(False).alias("quarantined"),
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("topic_id"),
    )


def label_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as phrase vectors of ten constructs, one per label."""
    themes = F.array(*[F.lit(t) for t in THEME_NAMES])
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("c"), F.col("label")).alias("construct"),
        F.element_at(themes, F.col("label") % 4 + 1).alias("theme"),
        F.col("embedding").alias("vector"),
    )


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A band and a score per user, standing in for ads."""
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    scored = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg((1 + F.pmod(cents, F.lit(99))).alias("result"))
    )
    band = F.when(F.col("result") >= 70, "Strong").when(F.col("result") >= 31, "Average")
    return scored.select(
        F.concat(F.lit("AD"), F.col("user_id")).alias("Ad ID"),
        band.otherwise("Weak").alias("band"),
        "result",
    )


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies on documents; every seventh cannot be parsed."""
    good = F.concat(
        F.lit('Rating:\n{"score": '),
        ((F.col("quality") * 3 + F.col("toxic") + F.col("doc_id") % 5) / 8.0).cast("string"),
        F.lit("} done"),
    )
    raw = F.when(F.col("doc_id") % 7 == 0, '{"score": null}').when(
        F.col("doc_id") % 7 == 1, "no answer"
    )
    constructs = F.array(*[F.lit(c) for c in STUDY.judge_constructs])
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("D"), F.col("doc_id")).alias("segment_id"),
        F.explode(constructs).alias("construct"),
        raw.otherwise(good).alias("raw"),
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per turn that has a next one: itself against itself said twice, and the next turn."""
    dim = STUDY.output_dim
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    follows = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    turns = turns.withColumnRenamed("text", "opening").join(follows, ["conv_id", "turn"])
    pairs = F.array(
        F.struct(F.lit("similar").alias("kind"), F.concat_ws(" ", "opening", "opening").alias("other")),
        F.struct(F.lit("unrelated").alias("kind"), F.col("reply").alias("other")),
    )
    probe = F.concat_ws("-", "conv_id", "turn")
    exploded = turns.select(probe.alias("probe"), "opening", F.explode(pairs).alias("p"))
    return exploded.select(
        "probe",
        F.col("p.kind").alias("kind"),
        vx.hashed_vector(F.col("opening"), dim).alias("left"),
        vx.hashed_vector(F.col("p.other"), dim).alias("right"),
    )
