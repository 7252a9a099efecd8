"""Study settings: themes, constructs and thresholds.

All checks here run on the driver while the plan is built; nothing in this file
touches data. Themes and anchors are plain dicts so a parsed settings file can
be passed as it is:

    themes  = {"Emotion": {"enabled": True, "source_columns": ["..."]}, ...}
    anchors = {"enjoyability": {"enabled": True, "phrases": ["..."]}, ...}
"""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from openends import defaults

log = logging.getLogger("openends")

# Display name in response files -> name used inside the plans.
KEY_COLUMNS = {
    "Respondent ID": "respondent_id",
    "Ad ID": "ad_id",
    "Brand": "brand",
    "Ad / Platform": "platform",
    "Order Shown": "order_shown",
}


def active_themes(themes: Mapping[str, Mapping]) -> dict[str, list[str]]:
    """Enabled themes with their source columns, in the given order."""
    active = {
        name: list(spec["source_columns"])
        for name, spec in themes.items()
        if spec.get("enabled", True)
    }
    if not active:
        raise ValueError("No themes are enabled; at least one question must be scored.")
    return active


def text_columns(themes: Mapping[str, Mapping]) -> list[str]:
    """Answer columns of the enabled themes."""
    return [
        column
        for spec in themes.values()
        if spec.get("enabled", True)
        for column in spec["source_columns"]
    ]


def required_columns(themes: Mapping[str, Mapping]) -> list[str]:
    """Columns a response table must have, in contract order."""
    return [*KEY_COLUMNS, *text_columns(themes)]


@dataclass(frozen=True)
class AnchorSet:
    """One construct, its phrases and the one theme it is scored against."""

    construct: str
    theme: str
    phrases: tuple[str, ...]


def anchor_sets(
    anchors: Mapping[str, Mapping],
    construct_themes: Mapping[str, str],
    active: Collection[str],
) -> list[AnchorSet]:
    """Constructs to score: enabled, mapped, and on a theme that was asked."""
    enabled = {name: spec for name, spec in anchors.items() if spec.get("enabled", True)}
    unmapped = [name for name in enabled if name not in construct_themes]
    if unmapped:
        raise ValueError(
            f"Enabled construct(s) {unmapped} have no theme; "
            "every enabled construct needs exactly one."
        )
    kept = []
    for name, spec in enabled.items():
        theme, phrases = construct_themes[name], tuple(spec["phrases"])
        if len(phrases) < 3:
            log.warning("construct %s has only %d phrase(s)", name, len(phrases))
        if theme in active:
            kept.append(AnchorSet(name, theme, phrases))
        else:
            log.warning("construct %s skipped: theme %s is not active", name, theme)
    return kept


@dataclass(frozen=True)
class Calibration:
    """Optional linear stretch of the 0-1 scores; off unless enabled."""

    enabled: bool = False
    low: float | None = None
    high: float | None = None

    def check(self) -> None:
        if not self.enabled:
            return
        if self.low is None or self.high is None:
            raise ValueError("calibration is enabled but its range lacks low or high")
        if self.high <= self.low:
            raise ValueError(
                f"calibration range must have high > low, got {self.low} and {self.high}"
            )


@dataclass(frozen=True)
class Study:
    """Everything a predict or train run needs to know."""

    themes: Mapping[str, Mapping] = field(default_factory=lambda: defaults.THEMES)
    anchors: Mapping[str, Mapping] = field(default_factory=lambda: defaults.ANCHORS)
    construct_themes: Mapping[str, str] = field(
        default_factory=lambda: defaults.CONSTRUCT_THEMES
    )
    min_tokens: int = 4
    near_duplicate_min_len: int = 20
    encoder_name: str = "hashed-tokens"
    output_dim: int = 64
    calibration: Calibration = Calibration()
    exclude_quarantined: bool = True
    run_discovery: bool = True
    # "kmeans" makes `topics` groups of reduced vectors; "density" finds their number itself.
    topic_method: str = "kmeans"
    topics: int = 10
    min_cluster_size: int = 8
    reduced_dim: int = 5
    # Density topics: reach of a group's core, in the units of the vectors (or of their first
    # `density_dim` principal components), and the rows that make a core.
    density_radius: float = 0.35
    density_dim: int | None = None
    density_min_points: int = 3
    # So many topics, the largest, become feature columns; the long table of shares has all.
    share_columns: int = 100
    model_name: str = "random_forest"
    n_splits: int = 5
    n_trees: int = 300
    conversations_grid: tuple[int, ...] = (5, 10, 20, 30, 50)
    n_repeats: int = 5
    judge_sample_size: int | None = None
    judge_constructs: tuple[str, ...] = ("enjoyability", "authenticity")
    seed: int = 42

    def check_topics(self) -> None:
        if self.topic_method not in ("kmeans", "density"):
            raise ValueError(f"unknown topic method {self.topic_method!r}; kmeans or density")
        if self.topic_method == "density" and self.density_radius <= 0:
            raise ValueError(f"the density radius must be positive, got {self.density_radius}")

    def anchor_sets(self) -> list[AnchorSet]:
        return anchor_sets(self.anchors, self.construct_themes, active_themes(self.themes))
