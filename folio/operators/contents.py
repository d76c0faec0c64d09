"""A table of contents matched with documents by title, with ordered fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import markdown as md
from folio.operators.documents import stem
from folio.sources.files import escape_unicode

#: The folder of each main section.
SECTION_FOLDERS = {"1": "docs", "2": "docs/核心规则", "4": "docs/资源目录", "5": "docs/创作指南", "6": "docs/都市箴言"}
#: Documents that stay for an entry, the shortest paths first.
CANDIDATES = 3


def titles(docs: DataFrame) -> DataFrame:
    """(key, path): each document under its title's and its stem's key, once if they are equal."""
    keys = F.array_distinct(F.array(md.toc_key(F.col("title")), md.toc_key(stem(F.col("path")))))
    return docs.select("path", F.explode(keys).alias("key")).where("key <> ''")


def candidates(docs: DataFrame, folders: list[str]) -> DataFrame:
    """(key, folder, rank, path): the CANDIDATES first documents of each key, among all (folder empty) and within each of the folders.

    Paths are distinct. A task sends on no more than CANDIDATES rows of a key and folder, so a title that a million documents
    share is as small as any other before it meets an entry.
    """
    within = F.filter(F.array(*(F.lit(f) for f in folders)), lambda f: F.col("path").startswith(F.concat(f, F.lit("/"))))
    rows = titles(docs).select("key", "path", F.explode(F.concat(F.array(F.lit("")), within)).alias("folder"))
    first = Window.partitionBy("key", "folder").orderBy(F.length("path"), "path")
    return rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= CANDIDATES)


def match(toc: DataFrame, docs: DataFrame, folders: dict[str, str] | None = None) -> DataFrame:
    """(toc_idx, level, title, page, rank, path) for each entry and candidate; path null and rank 1 if there is none.

    toc: toc_idx, level, title, page. docs: path, title. The key without section number counts; only where it finds
    nothing, the full title's does. Candidates under the section's folder win if there are any. An entry asks at most four
    times, by key and folder, and gets at most CANDIDATES rows for each: all joins are by equality, of bounded groups.
    """
    given = folders or SECTION_FOLDERS
    pairs = F.create_map(*(F.lit(x) for kv in given.items() for x in kv))
    own = F.try_element_at(pairs, F.split_part(md.section_number(F.col("title")), F.lit("."), F.lit(1)))
    keyed = toc.select("toc_idx", own.alias("own"), F.posexplode(F.array(md.toc_key(md.without_number(F.col("title"))), md.toc_key(F.col("title")))).alias("priority", "key"))
    places = F.filter(F.array(F.struct(F.lit(0).alias("outside"), F.col("own").alias("folder")), F.struct(F.lit(1).alias("outside"), F.lit("").alias("folder"))), lambda p: p["folder"].isNotNull())
    asked = keyed.select("toc_idx", "priority", "key", F.inline(places))
    hits = asked.join(candidates(docs, sorted(set(given.values()))), ["key", "folder"])
    best = F.struct("priority", "outside")
    kept = hits.withColumn("best", F.min(best).over(Window.partitionBy("toc_idx"))).where(best == F.col("best"))
    return toc.join(kept.select("toc_idx", "rank", "path"), "toc_idx", "left").select("toc_idx", "level", "title", "page", F.coalesce("rank", F.lit(1)).alias("rank"), "path")


def unmatched(toc: DataFrame, docs: DataFrame) -> DataFrame:
    """The entries for which match() finds no document."""
    return toc.join(match(toc, docs).where("path is not null"), "toc_idx", "left_anti")


def report_lines(matched: DataFrame) -> DataFrame:
    """(toc_idx, line): a bullet for each entry with its page and its documents."""
    page = F.format_string("[P%03d](../assets/pdf_pages_small/page_%03d.jpg)", "page", "page")
    relative = F.regexp_replace("path", r"\Adocs/", "")
    link = F.when(F.col("path").isNotNull(), F.struct("rank", F.concat(F.lit("[`docs/"), relative, F.lit("`]("), relative, F.lit(")")).alias("link")))
    g = matched.groupBy("toc_idx").agg(F.first("level").alias("level"), F.first("title").alias("title"), F.first(page).alias("page"), F.array_sort(F.collect_list(link)).alias("links"))
    to = F.when(F.size("links") > 0, F.array_join("links.link", ", ")).otherwise("（未匹配）")
    return g.select("toc_idx", F.concat(F.repeat(F.lit("  "), F.greatest(F.col("level") - 1, F.lit(0))), F.lit("- **"), "title", F.lit("**（"), "page", F.lit("） → "), to).alias("line"))


def sample(toc: DataFrame, n: int = 50) -> DataFrame:
    """(toc_idx, line): the first n entries as tab-separated level, page, title, and the title with all but ASCII as escapes. A limit is the feature."""
    first = toc.orderBy("toc_idx").limit(n)
    return first.select("toc_idx", F.concat_ws("\t", F.col("level").cast("string"), F.col("page").cast("string"), "title", escape_unicode(F.col("title"))).alias("line"))
