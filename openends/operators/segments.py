"""Wide responses to one row per respondent, ad and theme."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends import config

ROW_COLUMNS = ["respondent_id", "ad_id", "brand", "platform", "order_shown", "row_seq"]


def build_segments(
    responses: DataFrame, themes: Mapping[str, Mapping], within: Sequence[str] = ()
) -> DataFrame:
    """Unpivot the answers of every enabled theme; a map-only step.

    A theme with several answer columns joins the filled ones with ' || '.
    `within` names further columns to carry along, such as a resampling cell.
    """
    joined = [
        F.concat_ws(" || ", *[F.nullif(F.col(f"`{c}`"), F.lit("")) for c in columns]).alias(theme)
        for theme, columns in config.active_themes(themes).items()
    ]
    ids = [*within, *ROW_COLUMNS]
    long = responses.select(*ids, *joined).unpivot(
        ids, [f"`{theme}`" for theme in config.active_themes(themes)], "theme", "text"
    )
    return long.withColumn("segment_id", F.concat_ws("__", "respondent_id", "ad_id", "theme"))


def scoreable(segments: DataFrame) -> DataFrame:
    """Segments that passed the quality gate."""
    return segments.filter(~F.col("quarantined"))
