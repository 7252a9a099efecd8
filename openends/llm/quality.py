"""Document quality: a text classifier's evidence, moved by what is known of the site.

Hierarchical empirical Bayes: the share of good documents of a host is shrunk towards the
share of all, the share of a path towards its host's, the more the fewer documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.llm import linear
from openends.llm.common import hashed_sample, unique
from openends.sources.shared import stored

# The classifier is fitted on about this many labelled documents of each label, by hash.
MAX_TRAIN = 20_000
SYMBOLS = "*$%&#|!@{}<>=~^_\\"
FEATURES = (
    "log_words", "short", "letters", "upper_words", "symbols", "digits", "symbol_words",
    "repeated_next", "distinct_words", "distinct_lines", "word_length", "bare_symbols",
    "sentence_ends", "largest_word",
)


def text_features(text: str) -> list[float]:
    """What a text looks like, as FEATURES; the whole text is read."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    distinct = set(words)
    lines = [line for line in text.split("\n") if line.strip()]
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    upper = sum(map(str.isupper, words))
    ends = text.count(". ") + text.count(".\n") + text.endswith(".")
    letters = sum(map(len, filter(str.isalpha, words))) / chars
    odd = sum(not w[-1].isalnum() and w[-1] not in ".,;:?\"')" for w in words) / n
    digits = sum(map(text.count, "0123456789")) / chars
    repeated = sum(map(eq, words, words[1:])) / n
    return [
        float(np.log1p(n)),
        float(n < 5),
        letters,
        upper / n,
        min(1.0, symbols / chars),
        digits,
        odd,
        repeated,
        len(distinct) / n,
        len(set(lines)) / max(1, len(lines)),
        min(20.0, chars / n) / 20.0,
        sum(w in SYMBOLS for w in words) / n,
        min(1.0, ends / n),
        min(200, max(map(len, distinct))) / 200.0,
    ]


def _squared(x: np.ndarray) -> np.ndarray:
    """Features and their squares, so that too little and too much can both count."""
    return np.column_stack([x, x * x])


def shape(rows: DataFrame) -> DataFrame:
    """`rows` with `text` replaced by `shape`, an array of FEATURES."""
    others = [f for f in rows.schema.fields if f.name != "text"]

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop(columns="text").assign(shape=list(map(text_features, frame["text"])))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.mapInPandas(look, f"{schema}, shape array<double>")


def fit_evidence(shaped: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights of the text classifier; None without labelled documents of both kinds."""
    marked = unique(labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality"))
    rows = shaped.select("doc_id", "shape").join(marked.filter("quality in (0, 1)"), "doc_id")
    found: list = []
    for label in (0, 1):
        found += hashed_sample(rows.filter(F.col("quality") == label), "doc_id", MAX_TRAIN).collect()
    found.sort(key=lambda r: r["doc_id"])
    y = np.array([r["quality"] for r in found], dtype=float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array([r["shape"] for r in found])
    return linear.fit(_squared(x), y, ridge=0.05)


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength of shares around `mean`, by moments, in documents.

    Shares that differ no more than chance allows give a strong prior, shares that
    differ much a weak one.
    """
    share = F.col("good") / F.col("n")
    found = (
        groups.filter("n > 1")
        .agg(
            F.sum(F.col("n") * (share - mean) ** 2).alias("between"),
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("n") * mean * (1 - mean)).alias("within"),
        )
        .first()
    )
    if not found["k"] or not found["n"]:
        return 1_000.0
    within = found["within"] / found["n"]
    size = found["n"] / found["k"]
    spread = found["between"] / found["n"] - within / size
    return float(min(1_000.0, max(1.0, within / spread - 1 if spread > 1e-9 else 1_000.0)))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, host, path, evidence, host_share, path_share, score, kept.

    `evidence` is the classifier's probability that the text is good. Sites are summed up over
    all documents, with map-side combining, a document's own evidence being taken out of
    what its site says about it. The log-odds of the evidence are moved by those
    of the path's share against the share of all; a document stays at 0.5 or more.

    `host` and `path` are columns of `docs`, by default source and lang (the parts a source
    has); null is a site of its own. Null texts are empty. Without labelled documents of
    both kinds all evidence is 1 and everything stays. Rows without an id are left out, rows that repeat an id count once.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = unique(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            F.coalesce(host.cast("string"), F.lit("")).alias("host"),
            F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        )
    )
    shaped = stored(shape(rows), "shapes")
    weights = fit_evidence(shaped, labels)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if weights is None or not len(frame):
                yield frame.drop(columns="shape").assign(evidence=1.0)
                continue
            odds = linear.scores(_squared(np.stack(frame["shape"].to_numpy())), weights)
            yield frame.drop(columns="shape").assign(evidence=linear.sigmoid(odds))

    judged = shaped.mapInPandas(judge, "doc_id bigint, host string, path string, evidence double")
    judged = stored(judged, "evidence")
    paths = judged.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("good")
    )
    paths = stored(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (total["good"] / total["n"]) if total["n"] else 1.0
    for_hosts = _strength(hosts, F.lit(overall))
    named = hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    within = paths.join(named, "host").withColumn("_mean", F.col("host_good") / F.col("host_n"))
    for_paths = _strength(within, F.col("_mean"))

    own = F.col("evidence")
    host_share = (F.lit(for_hosts * overall) + F.col("host_good") - own) / (
        F.lit(for_hosts) + F.col("host_n") - 1
    )
    path_share = (F.lit(for_paths) * F.col("host_share") + F.col("good") - own) / (
        F.lit(for_paths) + F.col("n") - 1
    )
    moved = _logit(own) + _logit(F.col("path_share")) - _logit(F.lit(overall))
    score = 1 / (1 + F.exp(-moved))
    out = (
        judged.join(within.drop("_mean"), ["host", "path"])
        .withColumn("host_share", host_share)
        .withColumn("path_share", path_share)
        .withColumn("score", score)
    )
    return out.select(
        "doc_id", "host", "path", "evidence", "host_share", "path_share", "score",
        (F.col("score") >= 0.5).alias("kept"),
    )
