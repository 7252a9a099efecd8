"""Open-ended survey answers as Spark jobs.

Answers come in as one wide row per respondent and ad, become one long row per
question (theme), pass a quality gate, get a vector, are scored against the
concept anchors of their theme, and are rolled up to respondent and ad level.
"""
