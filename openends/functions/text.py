"""Text expressions. All are built-in Spark functions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode letters, numbers and underscore make a word; the space
# class lists every character a Unicode-aware split treats as white space. Both
# patterns mean the same in Java and RE2.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = f"[{WORD_CHARS}]+"
TERM = f"[{WORD_CHARS}]{{2,}}"
SPACES = f"[{SPACE_CHARS}]+"
NOT_WORD_OR_SPACE = f"[^{WORD_CHARS}{SPACE_CHARS}]"
# The same two for Java, quicker: listed characters are looked up at once, and the long classes are
# only asked about the others. A single space between words is no run that has to be replaced.
_PLAIN = "abcdefghijklmnopqrstuvwxyz0123456789_ "
_OTHER_SPACE = SPACE_CHARS.replace(r"\x1c-\x20", r"\x1c-\x1f")
DROPPED = f"[[^{_PLAIN}]&&{NOT_WORD_OR_SPACE}]"
RUNS = f"[[^!-~ ]&&[{_OTHER_SPACE}]][{SPACE_CHARS}]*| {SPACES}"


def collapse_spaces(text: Column) -> Column:
    """Trim and turn each run of white space into one space."""
    return F.trim(F.regexp_replace(text, RUNS, " "))


def clean_text(text: Column) -> Column:
    """An answer as the contract wants it; a missing answer becomes ''."""
    return F.coalesce(collapse_spaces(text.cast("string")), F.lit(""))


def clean_key(key: Column) -> Column:
    """A respondent or ad key as trimmed text; a missing key becomes ''."""
    edges = f"^{SPACES}|{SPACES}$"
    return F.coalesce(F.regexp_replace(key.cast("string"), edges, ""), F.lit(""))


def token_count(text: Column) -> Column:
    """Number of words; "don't" counts as two."""
    return F.regexp_count(text, F.lit(WORD))


def tokens(text: Column) -> Column:
    """Lower-case words in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def terms(text: Column) -> Column:
    """Lower-case words of two or more characters, for topic labels."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def match_text(text: Column) -> Column:
    """Lower case, no punctuation, single spaces: the form used to find copies."""
    return collapse_spaces(F.regexp_replace(F.lower(text), DROPPED, ""))


def digest(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes, a short stand-in for long texts in keys."""
    return F.unhex(F.sha2(text, 256))


def apply_instruction(text: Column, instruction: str | None) -> Column:
    """Put a text into a '{text}' template; no template leaves it unchanged."""
    if not instruction:
        return text
    head, *rest = instruction.split("{text}")
    parts = [F.lit(head)]
    for piece in rest:
        parts += [text, F.lit(piece)]
    return F.concat(*parts)


def content_key(text: Column, model: str, dim: int, instruction: str | None = None) -> Column:
    """Key of a text's vector: depends on model, instruction, dimension and text."""
    prefix = f"{model}|{instruction or ''}|{dim}|"
    return F.sha2(F.concat(F.lit(prefix), text), 256)
