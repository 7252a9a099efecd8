import numpy as np
import pytest
from pyspark.sql import functions as F

from openends.config import Calibration
from openends.operators import anchors, rollup

SCHEMA = (
    "segment_id string, respondent_id string, ad_id string, theme string, order_shown int, "
    "brand string, platform string, row_seq bigint, quarantined boolean"
)


def segment(who, ad, theme, order=1, seq=1, quarantined=False, brand="Acme"):
    return (f"{who}__{ad}__{theme}", who, ad, theme, order, brand, "Web", seq, quarantined)


def score_table(spark, rows):
    return spark.createDataFrame(rows, "segment_id string, anchor_enjoyability double")


@pytest.fixture(scope="module")
def plane(spark):
    segments = spark.createDataFrame(
        [("r1__a1__Emotion", "Emotion", [1.0, 0.0]), ("r1__a1__Meaning", "Meaning", [0.0, 1.0]),
         ("r1__a1__Memory", "Memory", [0.0, 1.0]), ("r2__a1__Emotion", "Emotion", None)],
        "segment_id string, theme string, vector array<float>",
    )
    centroids = spark.createDataFrame(
        [("enjoyability", "Emotion", [1.0, 0.0]), ("relevance", "Meaning", [0.0, 1.0]),
         ("valence", "Emotion", [0.0, -1.0])],
        "construct string, theme string, centroid array<double>",
    )
    return segments, centroids


NAMES = ["enjoyability", "relevance", "valence"]
EXPECTED = {
    "r1__a1__Emotion": (1.0, None, 0.5),
    "r1__a1__Meaning": (None, 1.0, None),
    "r1__a1__Memory": (None, None, None),
    "r2__a1__Emotion": (None, None, None),
}


def as_dict(df):
    rows = df.select("segment_id", *[f"anchor_{n}" for n in NAMES]).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_scores_stay_on_the_constructs_theme(plane):
    segments, centroids = plane
    assert as_dict(anchors.score_wide(segments, centroids, NAMES)) == EXPECTED
    long = anchors.score_long(segments, centroids, NAMES).filter("score IS NOT NULL")
    assert {(r.segment_id, r.construct): r.score for r in long.collect()} == {
        (s, n): v for s, row in EXPECTED.items() for n, v in zip(NAMES, row, strict=True)
        if v is not None
    }


def test_arrow_scores_equal_expression_scores(plane):
    segments, centroids = plane
    found = anchors.collect_centroids(centroids, NAMES)
    scored = anchors.score_wide_arrow(segments.repartition(3), found, NAMES)
    assert as_dict(scored) == EXPECTED
    assert "vector" not in scored.columns


def test_arrow_scores_on_random_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{i}", "TM"[i % 2], rng.normal(size=9).tolist()) for i in range(200)]
    segments = spark.createDataFrame(rows, "segment_id string, theme string, vector array<double>")
    cents = [(f"c{i}", "TMX"[i % 3], rng.normal(size=9).tolist()) for i in range(6)]
    table = spark.createDataFrame(cents, "construct string, theme string, centroid array<double>")
    names = [c[0] for c in cents]
    a = anchors.score_wide(segments, table, names).drop("vector").orderBy("segment_id").collect()
    b = anchors.score_wide_arrow(segments, anchors.collect_centroids(table, names), names)
    for x, y in zip(a, b.select(*a[0].asDict()).orderBy("segment_id").collect(), strict=True):
        for name in names:
            left, right = x[f"anchor_{name}"], y[f"anchor_{name}"]
            assert (left is None) == (right is None)
            assert left is None or left == pytest.approx(right)


def test_centroid_is_the_unit_mean(spark):
    df = spark.createDataFrame(
        [("c", "T", [1.0, 0.0]), ("c", "T", [0.0, 1.0]), ("z", "T", [1.0, 0.0]),
         ("z", "T", [-1.0, 0.0])],
        "construct string, theme string, vector array<float>",
    )
    found = {r.construct: r.centroid for r in anchors.centroids(df).collect()}
    assert found["c"] == pytest.approx([0.5**0.5, 0.5**0.5])
    assert found["z"] == [0.0, 0.0]


def test_construct_without_segments_is_reported(plane, spark):
    segments, centroids = plane
    extra = spark.createDataFrame(
        [("x", "Recall", [1.0, 0.0])], centroids.schema
    ).unionByName(centroids)
    assert [tuple(r) for r in anchors.constructs_without_segments(extra, segments).collect()] == [
        ("Recall", "x")
    ]


def test_rescale(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "anchor_x double")
    found = [r[0] for r in anchors.rescale_scores(df, ["anchor_x"]).collect()]
    assert found == [0.0, 0.5, 1.0, None]


@pytest.mark.parametrize("calibration, expected", [
    (Calibration(), [0.0, 0.5, 1.0]),
    (Calibration(False, 0, 10), [0.0, 0.5, 1.0]),
    (Calibration(True, 0, 10), [0.0, 5.0, 10.0]),
    (Calibration(True, -1, 1), [-1.0, 0.0, 1.0]),
])
def test_calibration(spark, calibration, expected):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "anchor_x double")
    found = anchors.calibrate_scores(df, ["anchor_x"], calibration).collect()
    assert [r[0] for r in found] == expected


def test_calibration_without_range_raises(spark):
    df = spark.createDataFrame([(0.0,)], "anchor_x double")
    with pytest.raises(ValueError, match="range"):
        anchors.calibrate_scores(df, ["anchor_x"], Calibration(True))


def test_respondent_level_is_one_row_with_one_score(spark):
    themes = ["Emotion", "Meaning", "Memory", "Optimisation"]
    segments = spark.createDataFrame([segment("r1", "a1", t) for t in themes], SCHEMA)
    scores = score_table(
        spark, [("r1__a1__Emotion", 0.8)] + [(f"r1__a1__{t}", float("nan")) for t in themes[1:]]
    )
    rows = rollup.respondent_features(anchors.attach_scores(segments, scores)).collect()
    assert len(rows) == 1
    assert rows[0].anchor_enjoyability == 0.8
    assert rows[0].n_themes_scored == 4
    assert (rows[0].brand, rows[0].platform, rows[0].order_shown) == ("Acme", "Web", 1)


def ads(spark, segments, scores, **options):
    frame = spark.createDataFrame(segments, SCHEMA)
    scored = anchors.attach_scores(frame, score_table(spark, scores))
    conversations = rollup.respondent_features(scored, **options)
    return {r.ad_id: r for r in rollup.ad_features(conversations).collect()}


def test_ad_level_averages_the_mapped_theme_only(spark):
    segments = [segment(w, "a1", t, order) for w, order in (("r1", 1), ("r2", 2))
                for t in ("Emotion", "Meaning")]
    row = ads(spark, segments, [("r1__a1__Emotion", 0.6), ("r2__a1__Emotion", 0.8)])["a1"]
    assert row.anchor_enjoyability_mean == pytest.approx(0.7)
    assert row.anchor_enjoyability_std == pytest.approx(0.02**0.5)
    assert (row.order_shown_mean, row.n_conversations) == (1.5, 2)


def test_std_of_one_conversation_is_missing(spark):
    row = ads(spark, [segment("r1", "a1", "Emotion")], [("r1__a1__Emotion", 0.6)])["a1"]
    assert row.anchor_enjoyability_std is None and row.order_shown_std is None


def test_quarantined_segments_and_ads_are_left_out_unless_asked_for(spark):
    segments = [
        segment("r1", "a1", "Emotion"),
        segment("r2", "a1", "Emotion", quarantined=True, order=3),
        segment("r3", "a2", "Emotion", quarantined=True),
    ]
    scores = [("r1__a1__Emotion", 0.6)]
    assert ads(spark, segments, scores)["a1"].n_conversations == 1
    assert set(ads(spark, segments, scores)) == {"a1"}
    everything = ads(spark, segments, scores, exclude_quarantined=False)
    assert set(everything) == {"a1", "a2"}
    assert everything["a1"].n_conversations == 2
    assert everything["a1"].order_shown_mean == 2.0
    flagged = spark.createDataFrame(segments, SCHEMA)
    assert [tuple(r) for r in rollup.fully_quarantined_ads(flagged).collect()] == [("a2", 1)]


def test_metadata_comes_from_the_first_row(spark):
    segments = [
        segment("r1", "a1", "Emotion", order=2, seq=7, brand="late"),
        segment("r1", "a1", "Meaning", order=1, seq=3, brand="early"),
        segment("r1", "a1", "Memory", order=3, seq=1, brand="flagged", quarantined=True),
    ]
    row = rollup.respondent_features(spark.createDataFrame(segments, SCHEMA)).first()
    assert (row.order_shown, row.brand, row.n_themes_scored) == (1, "early", 2)


def test_coverage_flags_constructs_without_scores(spark):
    frame = spark.createDataFrame([segment("r1", "a1", "Emotion")], SCHEMA)
    frame = frame.withColumns({"anchor_x": F.lit(0.5), "anchor_y": F.lit(None).cast("double")})
    found = {r.score_column: (r.n_scored, r.all_missing)
             for r in rollup.construct_coverage(frame).collect()}
    assert found == {"anchor_x": (1, False), "anchor_y": (0, True)}
    with pytest.raises(ValueError):
        rollup.construct_coverage(spark.createDataFrame([segment("r", "a", "T")], SCHEMA))
