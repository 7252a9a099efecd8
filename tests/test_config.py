"""Settings: which constructs are scored, which columns are needed, what is refused."""

import logging

import pytest

from openends.config import (
    KEY_COLUMNS,
    Calibration,
    Study,
    active_themes,
    anchor_sets,
    required_columns,
)

# A study of a museum visit, with questions, concepts and phrases of its own.
QUESTIONS = {
    "Arrival": {"source_columns": ["How did you find the way in?"]},
    "Exhibits": {"enabled": True, "source_columns": ["Which room stayed with you?", "Why that one?"]},
    "Staff": {"enabled": False, "source_columns": ["Who helped you?"]},
}
CONCEPTS = {
    "signage": {"phrases": ["arrows at every corner", "the map was wrong", "lost at the gate"]},
    "wonder": {"enabled": True, "phrases": ["stood there for ages", "goosebumps", "never seen that"]},
    "patience": {"enabled": False, "phrases": ["took time for us", "no rush"]},
    "warmth": {"phrases": ["a smile at the desk", "felt welcome", "kind guards"]},
}
HOME = {"signage": "Arrival", "wonder": "Exhibits", "warmth": "Staff"}


@pytest.mark.parametrize(
    "asked, switched_off, scored",
    [
        (["Arrival", "Exhibits", "Staff"], [], ["signage", "wonder", "warmth"]),
        (["Exhibits"], [], ["wonder"]),
        (["Arrival", "Staff"], ["warmth"], ["signage"]),
        (["Staff"], ["warmth"], []),
        ([], [], []),
    ],
)
def test_scored_concepts(asked, switched_off, scored):
    concepts = {
        name: spec | ({"enabled": False} if name in switched_off else {})
        for name, spec in CONCEPTS.items()
    }
    found = anchor_sets(concepts, HOME, asked)
    assert [s.construct for s in found] == scored
    assert all(s.theme == HOME[s.construct] for s in found)
    assert all(s.phrases == tuple(CONCEPTS[s.construct]["phrases"]) for s in found)


@pytest.mark.parametrize(
    "refused, call",
    [
        ("lighting", lambda: anchor_sets(CONCEPTS | {"lighting": {"phrases": ["dim"]}}, HOME, QUESTIONS)),
        ("No themes", lambda: active_themes({"Staff": QUESTIONS["Staff"]})),
        ("lacks low or high", Calibration(True, None, 5).check),
        ("lacks low or high", Calibration(True, 1, None).check),
        ("high > low", Calibration(True, 5, 5).check),
        ("high > low", Calibration(True, 9, 1).check),
    ],
)
def test_refused_settings_name_the_culprit(refused, call):
    with pytest.raises(ValueError, match=refused):
        call()


def test_thin_and_unasked_concepts_are_reported(caplog):
    caplog.set_level(logging.WARNING, "openends")
    anchor_sets({"warmth": CONCEPTS["warmth"], "wonder": {"phrases": ["one"]}}, HOME, ["Exhibits"])
    assert "wonder has only 1 phrase" in caplog.text and "warmth skipped" in caplog.text


def test_needed_columns_follow_the_questions_asked():
    assert active_themes(QUESTIONS) == {
        "Arrival": ["How did you find the way in?"],
        "Exhibits": ["Which room stayed with you?", "Why that one?"],
    }
    needed = required_columns(QUESTIONS)
    assert needed == [*KEY_COLUMNS, "How did you find the way in?", "Which room stayed with you?", "Why that one?"]


def test_calibration_is_off_unless_asked_for():
    Calibration().check()
    Calibration(False, 9, 1).check()
    assert not Study().calibration.enabled


def test_the_default_study_is_whole():
    study = Study()
    assert {s.theme for s in study.anchor_sets()} <= set(active_themes(study.themes))
    assert len(study.anchor_sets()) == 13 and study.judge_sample_size is None
