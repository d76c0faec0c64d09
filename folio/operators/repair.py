"""Repairs of tables that lost their markup: level tables and tier tables.

A table's lines are found by one pattern over the whole text, written anew as columns, and put back between what
stands around them. All of it happens within the row: nothing is exploded, shuffled or put in a window, however
long a document is. Patterns have no nested repetition that could backtrack.

compat=True, the default of whole jobs, gives the tables with the irregularities that readers of the older output rely on
(a separator one column short, signs' digits twice); without it tables are regular.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import BLANK, strip

#: The labels of the tables.
LEVEL, POINTS = "**等级**", "**经历点**"
EXPECTED, ATTACK = "**期望**", "**攻击**"
TIERS = ("传闻", "怪谈", "传说", "恶疾", "梦魇", "星辰", "杂质")
#: The first level of a table that follows right after another.
SECOND_FROM = 11
#: The documents that are repaired, under the folder of documents, and by what.
LISTED = {"核心规则/基本规则/等级.md": "level", "创作指南/战技平衡.md": "tier", "核心规则/速查图表/经历与晋升一览表.md": "level"}


#: Patterns see Unicode's classes, and lines that end at LF only. EDGE: white space within a line.
FLAGS = "(?Udm)"
EDGE = rf"[{BLANK}&&[^\n]]*+"
#: A level line and a line of points with two numbers at least; at most two pairs that touch are one find.
PAIR = rf"^{EDGE}{re.escape(LEVEL)}{EDGE}\n{EDGE}{re.escape(POINTS)}(?=[^\n\d]*+\d++[^\n\d]++\d)[^\n]*+"
PAIRS = rf"{FLAGS}{PAIR}(?:\n{PAIR})?+"
#: A line of a tier, or one of expectations with four pairs of signs; never with a pipe.
TIER_LINE = rf"(?![^\n]*\|)(?:(?=[^\n]*?\*\*(?:{'|'.join(TIERS)})\*\*)|(?={EDGE}{re.escape(EXPECTED)}(?:[^\n]*?\*\*){{2}}))[^\n]*+"
#: The first line that holds both labels, and the tier lines right after it.
TIER_RUN = rf"{FLAGS}^(?=[^\n]*?{re.escape(EXPECTED)})(?=[^\n]*?{re.escape(ATTACK)}){TIER_LINE}(?:\n{TIER_LINE})++"


def rewritten(text: Column, pattern: str, table: Callable[[Column], Column]) -> Column:
    """text with each find of the pattern as table() makes it."""
    made = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), table)
    between = F.split(text, pattern, -1)
    joined = F.array_join(F.flatten(F.zip_with(between, made, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return F.when(text.rlike(pattern), joined).otherwise(text)


def _row(label: str, cells: Column) -> Column:
    return F.concat(F.lit(f"|{label}|"), F.array_join(cells, "|"), F.lit("|"))


def _level_table(numbers: Column, first: Column, compat: bool) -> Column:
    n = F.size(numbers)
    heads = F.transform(F.sequence(first, first + n - 1), lambda x: F.concat(F.lit("**"), x.cast("string"), F.lit("**")))
    # the older form lacks the label's column
    wide = n if compat else n + 1
    rule = F.concat(F.lit("|---"), F.lit("---|") if compat else F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), wide - 1), "|"), F.lit("|"))
    return F.concat_ws("\n", _row(LEVEL, heads), rule, _row(POINTS, numbers))


def level_tables(text: Column, compat: bool = False) -> Column:
    """A text with each pair of a level line and a line of points (two numbers at least) as a pipe table.

    A second pair right after a first is numbered from SECOND_FROM on, after an empty line; a third begins anew.
    """

    def table(found: Column) -> Column:
        numbers = F.transform(F.split(found, "\n", -1), lambda x: F.regexp_extract_all(x, F.lit(r"(?U)\d+"), F.lit(0)))
        made = F.transform(F.filter(numbers, lambda n, i: i % 2 == 1), lambda n, i: _level_table(n, F.when(i == 0, F.lit(1)).otherwise(F.lit(SECOND_FROM)), compat))
        return F.array_join(made, "\n\n")

    return rewritten(text, PAIRS, table)


def tier_cells(line: Column, compat: bool = False) -> Column:
    """Bold words, then numbers outside of them, then signed amounts; without compat the amounts' own digits are not numbers as well."""
    special = r"(?U)[+\-]?\d+光|x\d+%|升[半\d]+阶"
    plain = F.regexp_replace(line, r"\*\*[^*]+\*\*", "")
    signs = F.regexp_extract_all(line, F.lit(special), F.lit(0))
    if not compat:
        plain = F.regexp_replace(plain, special, " ")
    cells = F.concat(F.regexp_extract_all(line, F.lit(r"\*\*([^*]+)\*\*"), F.lit(1)), F.regexp_extract_all(plain, F.lit(r"(?U)\d+\.?\d*"), F.lit(0)), signs)
    return F.filter(cells, lambda c: c != "")


def tier_tables(text: Column, compat: bool = False) -> Column:
    """A text with each run of tier lines that starts at an expectation line (two lines at least) as a pipe table.

    A run begins at its first line that holds both labels; what stands before that stays as it is. Lines with fewer
    than two cells go.
    """

    def line(cells: Column, i: Column) -> Column:
        rule = F.when(i == 0, F.concat(F.lit("\n|"), F.array_join(F.array_repeat(F.lit("---"), F.size(cells)), "|"), F.lit("|"))).otherwise("")
        return F.when(F.size(cells) >= 2, F.concat(F.lit("|"), F.array_join(cells, "|"), F.lit("|"), rule))

    def table(found: Column) -> Column:
        cells = F.transform(F.split(found, "\n", -1), lambda x: tier_cells(strip(x), compat))
        return F.array_join(F.transform(cells, line), "\n")

    return rewritten(text, TIER_RUN, table)


def repaired(docs: DataFrame, kinds: dict[str, str] = LISTED, compat: bool = True) -> DataFrame:
    """(path, text, status) for each wished path: kinds maps a path to "level" or "tier". status: ok, unchanged or missing."""
    wished = docs.sparkSession.createDataFrame(sorted(kinds.items()), "path string, kind string")
    found = wished.join(docs.where(F.col("path").isin(*kinds)).select("path", "text"), "path", "left")
    new = F.when(F.col("kind") == "level", level_tables(F.col("text"), compat)).otherwise(tier_tables(F.col("text"), compat))
    out = found.withColumn("new", new)
    status = F.when(F.col("text").isNull(), "missing").when(F.col("new") == F.col("text"), "unchanged").otherwise("ok")
    return out.select("path", F.col("new").alias("text"), status.alias("status"))
