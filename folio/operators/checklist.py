"""Work lists in Markdown: pending items, and the list with items marked as done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import lines

#: Fixed value: the heading of the notes.
DONE = "### 已完成"
PENDING = r"(?U)\A- \[ \] `([^`]+)`[\s\x1c-\x1f]*\z"


def pending(lists: DataFrame, text_col: str = "text") -> DataFrame:
    """(line_no, path) of the items that are not ticked, with all other columns of lists but the text."""
    rest = [c for c in lists.columns if c != text_col]
    rows = lists.select(*rest, F.posexplode(lines(F.col(text_col))).alias("line_no", "line"))
    return rows.where(F.col("line").rlike(PENDING)).select(*rest, "line_no", F.regexp_extract("line", PENDING, 1).alias("path"))


def mark_done(text: Column, path: Column, note: Column) -> Column:
    """The list with the first pending item of that path ticked, and a note at its end, under the heading (put in if it is not there)."""
    item = F.concat(F.lit("- [ ] `"), path, F.lit("`"))
    at = F.instr(text, item)
    tick = F.concat(F.substring(text, F.lit(1), at - 1), F.lit("- [x] `"), path, F.lit("`"), F.substring(text, at + F.length(item), F.length(text)))
    rows = lines(F.when(at > 0, tick).otherwise(text))
    headed = F.exists(rows, lambda x: F.trim(x) == DONE)
    rows = F.when(headed, rows).otherwise(F.concat(rows, F.array(F.lit(""), F.lit(DONE), F.lit(""))))
    last = F.try_element_at(rows, F.lit(-1))
    rows = F.when(F.trim(last) != "", F.concat(rows, F.array(F.lit("")))).otherwise(rows)
    line = F.concat(F.lit("- `"), path, F.lit("`："), note)
    return F.array_join(F.concat(rows, F.array(line, F.lit(""))), "\n")


def mark_all(text: Column, done: Column) -> Column:
    """The list with several items marked one after the other; done: an array of (path, note). One fold, however many there are."""
    return F.aggregate(done, text, lambda now, x: mark_done(now, x["path"], x["note"]))
