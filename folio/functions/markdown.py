"""Headings, titles and keys of Markdown documents, and pipe tables, as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.text import BLANK, strip

#: Punctuation that titles are compared without.
TITLE_PUNCTUATION = "·•・、，,。．.：:；;！!？?()（）[]【】《》“”\"'‘’`"
HEADING = rf"(?U)\A{BLANK}*(#{{1,6}}){BLANK}+([^\n]+?){BLANK}*\z"
#: Lines that only separate.
RULES = ("---", "***", "___")


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition; no built-in function has it. Null stays null."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalised(text: Column) -> Column:
    """nfkc() of a text; plain ASCII, which stays as it is, is not sent to Python."""
    plain = text.rlike(r"\A\p{ASCII}*+\z")
    return F.when(plain, text).otherwise(nfkc(F.when(~plain, text)))


def heading_level(line: Column) -> Column:
    return F.length(F.regexp_extract(line, HEADING, 1))


def heading_text(line: Column) -> Column:
    return strip(F.regexp_extract(line, HEADING, 2))


def trim_emphasis(title: Column) -> Column:
    return strip(F.btrim(title, F.lit("*_`~ ")))


def _without_punctuation(text: Column) -> Column:
    signs = "".join("\\" + c if c in "[]()\\^-&.?\"'`" else c for c in TITLE_PUNCTUATION)
    return F.regexp_replace(text, rf"(?U)[{BLANK[1:-1]}{signs}]+", "")


def toc_key(title: Column, ready: bool = False) -> Column:
    """A title for matching with a table of contents: no punctuation, white space or case. ready: NFKC is done already."""
    return _without_punctuation(F.lower(strip(title if ready else normalised(title))))


def title_key(title: Column, ready: bool = False) -> Column:
    """A title for finding duplicates: as toc_key, without tags and emphasis signs as well."""
    text = F.lower(strip(title if ready else normalised(title)))
    return _without_punctuation(F.regexp_replace(F.regexp_replace(text, r"</?[^>]+?>", ""), r"[*_~`]", ""))


def section_number(title: Column) -> Column:
    """The dotted number that a title begins with, or the empty string."""
    return F.regexp_extract(title, rf"(?U)\A{BLANK}*(\d+(?:\.\d+)*)\.?{BLANK}+", 1)


def without_number(title: Column) -> Column:
    rest = F.regexp_extract(title, rf"(?U)\A{BLANK}*\d+(?:\.\d+)*\.?{BLANK}+([^\n]+?){BLANK}*\z", 1)
    return F.when(rest != "", rest).otherwise(strip(title))


def pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def pipe_table(rows: Column) -> Column:
    """Rows (arrays of strings, the first is the header) as a pipe table; short rows are padded, empty cells are a space."""
    width = F.array_max(F.transform(rows, F.size))
    padded = F.transform(rows, lambda r: F.transform(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), lambda c: F.when(c == "", " ").otherwise(c)))
    rule = pipe_row(F.array_repeat(F.lit("---"), width))
    body = F.transform(F.slice(padded, 2, F.greatest(F.size(padded) - 1, F.lit(0))), pipe_row)
    return F.concat(F.array_join(F.concat(F.array(pipe_row(F.element_at(padded, 1)), rule), body), "\n"), F.lit("\n"))
