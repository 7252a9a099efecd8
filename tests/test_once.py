"""Costly columns are computed once, and by work in proportion to the texts."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from openends.catalog.queries import QUERIES
from openends.functions import text as tx
from openends.functions import vectors as vx
from openends.operators import density, quality

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_projected_topics_encode_a_text_once(spark):
    df = QUERIES["topics_projected"](spark, SMALL)
    # What is left to do reads stored vectors, not texts.
    assert "regexp_extract_all" not in plan_of(df)
    assert df.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_hashed_counts_do_not_pass_over_the_tokens_per_bucket(spark):
    df = spark.createDataFrame([(None,), ("",), ("a b a",)], "text string").select(
        vx.hashed_counts(F.col("text"), 5).alias("n")
    )
    assert "array_remove" not in plan_of(df)
    found = [r.n for r in df.collect()]
    assert found[0] is None and found[1] == [0.0] * 5
    assert sorted(found[2])[-2:] in ([1.0, 2.0], [0.0, 3.0])


def test_buckets_are_whole_numbered_products(spark):
    plan = density.directions_of(3, 4, 2, 7)
    steps = [[0, 0, 0], [2**43, -(2**43), 5], [-1, 2, -3]]
    df = spark.createDataFrame([(q,) for q in steps], "q array<bigint>")
    width = density.WIDTH * density.STEPS * density.UNIT
    found = [r.b for r in df.select(density._buckets(F.col("q"), plan).alias("b")).collect()]
    for q, names in zip(steps, found, strict=True):
        cells = [
            [t, *((sum(x * a for x, a in zip(q, v, strict=True)) + b) // width for v, b in table)]
            for t, table in enumerate(plan)
        ]
        assert [np.frombuffer(name, dtype=np.int64).tolist() for name in names] == cells


@pytest.mark.parametrize(
    "name",
    [
        "qc_flags",
        "qc_flags_distinct_respondents",
        "qc_report",
        "qc_totals",
        "ads_fully_quarantined",
        "quarantine_free_segments",
    ],
)
def test_quality_queries_normalise_a_text_once(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    # Both copy checks read stored digests.
    assert "regexp_replace" not in plan and "sha2(" not in plan


def test_flags_without_texts_are_those_of_the_gate(spark):
    texts = ["Same words here, for both of us", "same  words here for both of us!", "", "no", "a\tb c d e"]
    rows = [(f"s{i}", i, f"r{i % 3}", "a1", "Memory", texts[i % 5]) for i in range(12)]
    names = "segment_id string, row_seq int, respondent_id string, ad_id string, theme string, text string"
    df = spark.createDataFrame(rows, names)
    for people in (False, True):
        found = quality.quality_flags(df, distinct_respondents=people)
        gated = quality.quality_gate(df, distinct_respondents=people).select(found.columns)
        assert "text" not in found.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, gated.collect()))


def test_quicker_patterns_give_the_same_match_text(spark):
    odd = [
        "A  b  c", "  x\ty \x1c z ", "a-b - c", "Ünï\u0085cödé  …  ЖЗ, 12_3", "\n\n", "a 　", "İ ẞ ²½ Ⅷ",
        "tab\there", "x​y", "~!@[]^{}|`", None, *[chr(c) + "a " + chr(c) for c in range(1, 0x2100)],
    ]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, t string")
    plain = F.regexp_replace(F.lower("t"), tx.NOT_WORD_OR_SPACE, "")
    old = F.trim(F.regexp_replace(plain, tx.SPACES, " "))
    assert df.filter(~tx.match_text(F.col("t")).eqNullSafe(old)).count() == 0
    assert df.filter(~tx.collapse_spaces(F.col("t")).eqNullSafe(
        F.trim(F.regexp_replace("t", tx.SPACES, " ")))).count() == 0
