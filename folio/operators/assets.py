"""Images and other binary assets: numbering, size filter, keep-first by content, names, link rewriting and copy plans."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import html, png
from folio.functions.text import replace_all


def keep_first(images: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Images with at least min_bytes (and any), the first of equal contents by page and index, with their sha1.

    Equal contents meet by hash; a group limit in the window keeps one row a task before the shuffle.
    """
    big = images.where((F.length("content") > 0) & (F.length("content") >= min_bytes)).withColumn("sha1", F.sha1("content"))
    return big.withColumn("_n", F.row_number().over(Window.partitionBy("sha1").orderBy("page", "idx"))).where("_n = 1").drop("_n")


def extraction_counts(images: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row: extracted, skipped_dupe, skipped_small."""
    small = F.coalesce((F.length("content") == 0) | (F.length("content") < min_bytes), F.lit(True))
    g = images.select(small.alias("small"), F.sha1("content").alias("sha1")).agg(F.count_if("small").alias("skipped_small"), F.count_if(~F.col("small")).alias("big"), F.count_distinct(F.when(~F.col("small"), F.col("sha1"))).alias("extracted"))
    return g.select("extracted", (F.col("big") - F.col("extracted")).alias("skipped_dupe"), "skipped_small")


def extension(name: Column) -> Column:
    """In lower case; jpeg is jpg, none is bin."""
    low = F.lower(F.coalesce(F.nullif(name, F.lit("")), F.lit("bin")))
    return F.when(low == "jpeg", "jpg").otherwise(low)


def image_name(page: Column, idx: Column, ext: Column) -> Column:
    return F.format_string("page_%03d_img_%02d.%s", page, idx, extension(ext))


def pages_between(start: Column, end: Column, n: Column) -> tuple[Column, Column]:
    """First and last page of a wish (0: no bound) among n pages; empty if the first is beyond the last."""
    first = F.greatest(F.lit(1), start)
    return first, F.least(F.when((end != 0) & (end >= first), end).otherwise(n), n)


def scale(width: Column, max_width: Column) -> Column:
    """Factor that brings a page to at most max_width, at most 4; 1 for a page without width."""
    return F.when(width > 0, F.least(max_width / F.nullif(width, F.lit(0.0)), F.lit(4.0))).otherwise(F.lit(1.0))


def thumbnails(images: DataFrame, max_width: int, content_col: str = "content") -> DataFrame:
    """images with `thumbnail`: PNG images no wider than max_width, by box averages; null for other kinds, which nothing here can decode."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # an image at a time: its pixels are far larger than its bytes
                row = b.slice(i, 1)
                data = row.column(content_col)[0].as_py()
                yield row.append_column("thumbnail", pa.array([None if data is None else png.thumbnail(data, max_width)], pa.binary()))

    return images.mapInArrow(run, T.StructType([*images.schema.fields, T.StructField("thumbnail", T.BinaryType())]))


def links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(path, pos, src) of every image link of pages (path, html)."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(r'(?i)<img\b[^>]*?\bsrc\s*=\s*"([^"]+)"'), F.lit(1))
    return pages.select("path", F.posexplode(found).alias("pos", "src"))


@F.pandas_udf(T.StringType())
def resolve(folder: pd.Series, src: pd.Series) -> pd.Series:
    """src relative to folder, without . and .. parts."""
    return pd.Series([posixpath.normpath(posixpath.join(f, s.replace("\\", "/"))) for f, s in zip(folder, src, strict=True)], dtype="object")


@F.pandas_udf(T.StringType())
def relative_to(target: pd.Series, folder: pd.Series) -> pd.Series:
    return pd.Series([posixpath.relpath(t, f or ".") for t, f in zip(target, folder, strict=True)], dtype="object")


def copy_plan(pages: DataFrame, listing: DataFrame, assets: str = "assets/chm") -> DataFrame:
    """(path, pos, src, file, destination, link) of the image links that are copied: own, existing, of a known image kind.

    listing: path of every file that exists. Existence is one equi-join with it, never a look-up for each row.
    """
    own = links(pages).where(~html.nav_asset(F.col("src")) & ~html.external(F.col("src")))
    folder = F.regexp_replace("path", r"/?[^/]*\z", "")
    found = own.withColumn("folder", folder).withColumn("file", resolve(F.col("folder"), F.col("src"))).join(listing.select(F.col("path").alias("file")).distinct(), "file", "left_semi")
    found = found.where(html.image_path(F.col("file"))).withColumn("destination", resolve(F.concat(F.lit(f"{assets}/"), "folder"), F.col("src")))
    return found.withColumn("link", relative_to(F.col("destination"), F.col("folder"))).select("path", "pos", "src", "file", "destination", "link")


def rewrite_links(pages: DataFrame, plan: DataFrame) -> DataFrame:
    """pages with the links of the plan put in: cut at the links, which come back in order."""
    marked = F.regexp_replace("html", r'(?i)(<img\b[^>]*?\bsrc\s*=\s*")([^"]+)(")', "$1\u0001$2\u0001$3")
    parts = F.split(marked, "\u0001")
    new = plan.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("pos", "link"))).alias("links"))
    # odd parts (from 0) are links, the k-th of them at 2 k + 1
    put = F.transform(F.col("parts"), lambda x, i: F.when(i % 2 == 1, F.coalesce(F.try_element_at("links", ((i - 1) / 2).cast("int")), x)).otherwise(x))
    joined = pages.withColumn("parts", parts).join(new, "path", "left").withColumn("links", F.coalesce("links", F.create_map().cast("map<int,string>")))
    return joined.withColumn("html", F.array_join(put, "")).drop("parts", "links")


#: Documents that were given other names.
RENAMES = (("docs/资源目录/课程/古武术总纲.md", "docs/资源目录/课程/古武术.md"), ("docs/资源目录/能力列表/出身经历类.md", "docs/资源目录/能力列表/出身类.md"))


def renamed_references(text: Column, renames: tuple[tuple[str, str], ...] = RENAMES) -> Column:
    """A text whose quoted paths (in back quotes) are the new ones."""
    return replace_all(text, ((f"`{old}`", f"`{new}`") for old, new in renames))


def rename_outcome(src_exists: Column, dst_exists: Column) -> Column:
    return F.when(~src_exists, "missing").when(dst_exists, "exists").otherwise("renamed")


def rename_plan(renames: DataFrame, listing: DataFrame) -> DataFrame:
    """(src, dst, outcome, line) of each rename, from one listing of the files that exist."""
    there = listing.select("path").distinct()
    plan = renames.join(there.select(F.col("path").alias("src"), F.lit(True).alias("s")), "src", "left").join(there.select(F.col("path").alias("dst"), F.lit(True).alias("d")), "dst", "left")
    outcome = rename_outcome(F.coalesce("s", F.lit(False)), F.coalesce("d", F.lit(False)))
    line = F.concat(outcome, F.lit(": "), F.when(outcome == "exists", F.col("dst")).otherwise(F.col("src")), F.when(outcome == "renamed", F.concat(F.lit(" -> "), "dst")).otherwise(""))
    return plan.select("src", "dst", outcome.alias("outcome"), line.alias("line"))
