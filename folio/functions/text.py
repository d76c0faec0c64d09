"""Text columns that follow Unicode rules for white space and lines, as Column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in Unicode's sense, for patterns with the (?U) flag: the engine's own \s lacks the four separators.
BLANK = r"[\s\x1c-\x1f]"
#: What ends a line, for reading Markdown lines.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def lines(text: Column) -> Column:
    """The lines of a text; a line end at the end of the text opens no further line."""
    parts = F.split(text, LINE_END)
    drop = F.element_at(parts, -1) == ""
    return F.when(drop, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def collapse_blank(text: Column) -> Column:
    """At most two empty lines in a row."""
    return F.regexp_replace(text, r"\n{4,}", "\n\n\n")


def escape_pipes(text: Column) -> Column:
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def replace_all(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Each old string replaced by its new one, wherever it stands, one pair after the other."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text
