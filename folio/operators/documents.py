"""Documents by title and body: description, duplicate groups and their report."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import markdown as md
from folio.functions.text import BLANK, lines, strip
from folio.sources.scratch import stored

#: Lines among which the first one with text is looked for; in a table of contents, the first heading.
TITLE_WITHIN, HEADING_WITHIN = 120, 80
#: Documents with content that a group's report names.
TOP_CONTENT = 10
#: A line with text, and one that is blank or a rule: told by one match, without a stripped copy of each line.
FILLED = rf"(?U)(?!{BLANK})(?s:.)"
NO_BODY = rf"(?U)\A{BLANK}*(?:{'|'.join(re.escape(r) for r in md.RULES)})?{BLANK}*\z"


def described(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, title, title_level, body_nonempty_lines, body_chars, is_title_only) of documents whose first line with text is a heading."""
    all_ = docs.select(F.col(path_col).alias("path"), lines(F.col(text_col)).alias("lines"))
    numbered = F.filter(F.transform(F.slice("lines", 1, TITLE_WITHIN), lambda x, i: F.struct((i + 1).alias("n"), x.alias("line"))), lambda s: s["line"].rlike(FILLED))
    found = all_.withColumn("first", F.get(numbered, F.lit(0))).where(F.col("first").isNotNull())
    found = found.withColumn("title", md.trim_emphasis(md.heading_text(F.col("first.line")))).where("title <> ''")
    body = F.filter(F.slice("lines", F.col("first.n") + 1, F.size("lines")), lambda x: ~x.rlike(NO_BODY))
    return found.select("path", "title", md.heading_level(F.col("first.line")).alias("title_level"), body.alias("body")).select(
        "path", "title", "title_level", F.size("body").alias("body_nonempty_lines"), F.length(strip(F.array_join("body", "\n"))).alias("body_chars"), (F.size("body") == 0).alias("is_title_only")
    )


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(.)\.[^.]*\z", "$1")


def keyed(info: DataFrame) -> DataFrame:
    """described() documents with the keys of their title and of their stem, as a stored table: documents are read, and keys made, once."""
    name = stem(F.col("path"))
    return stored(info.withColumns({"stem": name, "title_key": md.title_key(F.col("title")), "stem_key": md.title_key(name)}), "keyed")


def duplicate_groups(known: DataFrame, key: str) -> DataFrame:
    """(key, path, title, stem, kind, rank, body_nonempty_lines, body_chars) of groups with both title-only documents and ones with content.

    known: keyed() documents; key: one of its key columns. Groups are found by an aggregate of flags that is combined before
    the shuffle. Of the documents with content only the TOP_CONTENT longest of a key go on, cut in each task
    before they are shuffled; a key that most documents share sends no more than that from a task. Title-only
    documents stay all; they meet the groups, which are distinct, in a join that the engine splits where it is hot.
    """
    rows = known.withColumn("key", F.col(key)).where("key <> ''").select("key", "path", "title", "stem", "is_title_only", "body_nonempty_lines", "body_chars")
    groups = rows.groupBy("key").agg(F.bool_or("is_title_only").alias("some"), F.bool_and("is_title_only").alias("every")).where("some and not every").select("key")
    longest = Window.partitionBy("key").orderBy(F.desc("body_chars"), "path")
    content = rows.where(~F.col("is_title_only")).withColumn("rank", F.row_number().over(longest)).where(F.col("rank") <= TOP_CONTENT).withColumn("kind", F.lit("has_content"))
    only = rows.where("is_title_only").withColumns({"rank": F.lit(None).cast("int"), "kind": F.lit("title_only")})
    return content.unionByName(only).join(groups, "key", "left_semi").select("key", "path", "title", "stem", "kind", "rank", "body_nonempty_lines", "body_chars")


def by_title(known: DataFrame) -> DataFrame:
    return duplicate_groups(known, "title_key")


def by_stem(known: DataFrame) -> DataFrame:
    return duplicate_groups(known, "stem_key")


def group_heads(groups: DataFrame, name: str) -> DataFrame:
    """(key, least_path, name) of each group: its first title-only path, and that document's `name`."""
    first = F.min(F.when(F.col("kind") == "title_only", F.struct("path", name)))
    return groups.groupBy("key").agg(first.alias("first")).select("key", F.col("first.path").alias("least_path"), F.col(f"first.{name}").alias("name"))


def group_lines(groups: DataFrame, heads: DataFrame) -> DataFrame:
    """(key, least_path, block, place, path, line): the report's lines of each group, a row each; in the order of all but the last column they are the report.

    Blocks: 0 the group's name and what stands before its title-only documents, 1 these by path, 2 what stands before those with
    content, 3 these by rank, 4 an empty line.
    """
    fixed = [(0, 0, F.concat(F.lit("== "), "name", F.lit(" =="))), (0, 1, F.lit("title_only:")), (2, 0, F.lit("has_content:")), (4, 0, F.lit(""))]
    around = heads.select("key", "least_path", F.inline(F.array(*(F.struct(F.lit(b).alias("block"), F.lit(p).alias("place"), F.lit("").alias("path"), x.alias("line")) for b, p, x in fixed))))
    has = F.col("kind") == "has_content"
    detail = F.when(has, F.format_string("  (body_lines=%d, body_chars=%d)", "body_nonempty_lines", "body_chars")).otherwise("")
    members = groups.join(heads, "key").select("key", "least_path", F.when(has, 3).otherwise(1).alias("block"), F.coalesce("rank", F.lit(0)).alias("place"), "path", F.concat(F.lit("- "), F.col("path"), detail).alias("line"))
    return around.unionByName(members)


def first_heading(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, title): the first heading among the first lines, else the file's stem."""
    headings = F.filter(F.transform(F.slice(lines(F.col(text_col)), 1, HEADING_WITHIN), md.heading_text), lambda t: t != "")
    return docs.select(F.col(path_col).alias("path"), F.coalesce(F.get(headings, F.lit(0)), stem(F.col(path_col))).alias("title"))


def without_heading(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Paths of documents in which no line is a heading."""
    return docs.where(~F.exists(lines(F.col(text_col)), lambda x: md.heading_level(x) > 0)).select(F.col(path_col).alias("path"))


def with_markup(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Paths of documents that hold an HTML tag."""
    return docs.where(F.col(text_col).rlike(r"</?[A-Za-z][^>]*>")).select(F.col(path_col).alias("path"))
