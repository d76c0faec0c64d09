"""Queries over PDF files that are made from pages, written, and read back: bookmarks, page sizes, embedded images, thumbnails."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import png
from folio.operators import assets
from folio.plans.catalog import longs, query, table, work_folder
from folio.sources import pdf, sinks

#: Pages of a file; each is a page there, a bookmark and an image.
GROUP = 20


def _string(text: str) -> bytes:
    if text.isascii():
        return b"(" + text.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)").encode() + b")"
    return b"<" + (b"\xfe\xff" + text.encode("utf-16-be")).hex().encode() + b">"


def document(entries: list[tuple[int, str]], images: list[tuple[bytes, bytes]], style: int) -> bytes:
    """A PDF with a page for each entry (level, title) and image (its dictionary's entries, its bytes).

    style 0: a table of references; 1: a reference stream and object streams, with a row predictor; 2: no references at all.
    """
    n = len(entries)
    page, item, image = (lambda i: 10 + i), (lambda i: 10 + n + i), (lambda i: 10 + 2 * n + i)
    body: dict[int, bytes] = {1: b"<< /Type /Catalog /Pages 2 0 R /Outlines 3 0 R /Names << /Dests 4 0 R >> >>"}
    body[2] = b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % k for k in (5, 6)) + b"] /Count %d >>" % n
    half = n // 2
    for k, part in ((5, range(half)), (6, range(half, n))):
        body[k] = b"<< /Type /Pages /Parent 2 0 R /MediaBox [0 0 200 50.5] /Kids [" + b" ".join(b"%d 0 R" % page(i) for i in part) + b"] /Count %d >>" % len(part)
    body[4] = b"<< /Names [" + b" ".join(b"(n%d) [%d 0 R /Fit]" % (i, page(i)) for i in range(n)) + b"] >>"
    parents, open_ = [], [(0, 3)]
    for i, (level, _) in enumerate(entries):
        open_ = [x for x in open_ if x[0] < level]
        parents.append(open_[-1][1])
        open_.append((level, item(i)))
    body[3] = b"<< /Type /Outlines" + (b" /First %d 0 R" % item(0) if n else b"") + b" >>"
    for i, (_, title) in enumerate(entries):
        after = next((item(j) for j in range(i + 1, n) if parents[j] == parents[i]), None)
        child = item(i + 1) if i + 1 < n and parents[i + 1] == item(i) else None
        to = (b"/Dest [%d 0 R /XYZ 0 0 null]" % page(i), b"/A << /S /GoTo /D [%d 0 R /Fit] >>" % page(i), b"/Dest (n%d)" % i)[i % 3]
        body[item(i)] = b"<< /Title %s /Parent %d 0 R %s%s%s >>" % (_string(title), parents[i], to, b" /Next %d 0 R" % after if after else b"", b" /First %d 0 R" % child if child else b"")
        size = b" /MediaBox [0 0 %d 100]" % (100 + i) if i % 2 else b""
        body[page(i)] = b"<< /Type /Page /Parent %d 0 R%s /Resources << /XObject << /I %d 0 R >> >> >>" % (5 if i < half else 6, size, image(i))
    streams = {image(i): (b"/Type /XObject /Subtype /Image " + info, data) for i, (info, data) in enumerate(images)}
    out, at, last = bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), {}, 10 + 3 * n

    def put(number: int, text: bytes) -> None:
        at[number] = len(out)
        out.extend(b"%d 0 obj\n" % number + text + b"\nendobj\n")

    def put_stream(number: int, info: bytes, data: bytes) -> None:
        put(number, b"<< %s /Length %d >>\nstream\r\n%s\nendstream" % (info, len(data), data))

    for number, (info, data) in streams.items():
        put_stream(number, info, data)
    if style != 1:
        for number, text in body.items():
            put(number, text)
        start = len(out)
        if style == 0:
            out.extend(b"xref\n0 %d\n" % last + b"".join(b"%010d %05d %c \n" % (at.get(k, 0), 0, b"n" if k in at else b"f") for k in range(last)))
        out.extend(b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (last, start))
        return bytes(out)
    numbers = list(body)
    starts, parts = [], b""
    for k in numbers:
        starts.append(len(parts))
        parts += body[k] + b" "
    heads = b" ".join(b"%d %d" % x for x in zip(numbers, starts, strict=True)) + b" "
    put_stream(last, b"/Type /ObjStm /N %d /First %d /Filter /FlateDecode" % (len(numbers), len(heads)), zlib.compress(heads + parts))
    at[last + 1] = len(out)
    rows = [(2, last, numbers.index(k)) if k in body else (1, at[k], 0) if k in at else (0, 0, 0) for k in range(last + 2)]
    flat = [bytes([a]) + b.to_bytes(4, "big") + bytes([c]) for a, b, c in rows]
    up = b"".join(b"\x02" + bytes((x - y) & 255 for x, y in zip(r, before, strict=True)) for r, before in zip(flat, [bytes(6), *flat], strict=False))
    put_stream(last + 1, b"/Type /XRef /Size %d /W [1 4 1] /Root 1 0 R /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 6 >>" % (last + 2), zlib.compress(up))
    out.extend(b"startxref\n%d\n%%%%EOF\n" % at[last + 1])
    return bytes(out)


def files_of_pages(spark: SparkSession, sf_dir: str) -> str:
    """A tree of PDF files, one for GROUP pages each; every second image is a JPEG by name, the others are grey samples, four by two."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for g, held in zip(b["g"], b["held"], strict=True):
                entries, images = [], []
                for i, page in enumerate(held):
                    entries.append((1 + i % 3, page["url"] + (" 中(" if i % 2 else " (")))
                    v, w = page["page_id"] % 200, page["page_id"] * 7 % 200
                    grey = bytes([v, v + 4, w, w + 4, v + 8, v + 12, w + 8, w + 12])
                    jpeg = (b"/Width 4 /Height 2 /Filter /DCTDecode", f"jpeg {page['url']}".encode())
                    images.append((b"/Width 4 /Height 2 /BitsPerComponent 8 /ColorSpace /DeviceGray /Filter [/FlateDecode]", zlib.compress(grey)) if i % 2 else jpeg)
                made.append(document(entries, images, g % 3))
            yield pd.DataFrame({"path": [f"g{g % 7}/b{g}.pdf" for g in b["g"]], "content": made})

    groups = table(spark, sf_dir, "pages").groupBy(F.expr(f"page_id div {GROUP}").alias("g")).agg(F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("held"))
    root = work_folder(spark)
    sinks.write_tree(groups.mapInPandas(run, "path string, content binary"), root, value_col="content")
    return root


PLACED_SQL = f"placed AS (SELECT *, 'g' || ((page_id // {GROUP}) % 7) || '/b' || (page_id // {GROUP}) || '.pdf' AS path, row_number() OVER (PARTITION BY page_id // {GROUP} ORDER BY page_id) - 1 AS i, page_id % 200 AS v, page_id * 7 % 200 AS w FROM pages)"


@query(f"WITH {PLACED_SQL} SELECT path, i AS toc_idx, 1 + i % 3 AS level, url || CASE WHEN i % 2 = 1 THEN ' 中(' ELSE ' (' END AS title, i + 1 AS page FROM placed")
def pdf_bookmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(pdf.read(spark, files_of_pages(spark, sf_dir), "bookmarks"), "toc_idx", "level", "page")


@query(f"WITH {PLACED_SQL}, p AS (SELECT path, i + 1 AS page, CASE WHEN i % 2 = 1 THEN 100.0 + i ELSE 200.0 END AS width, CASE WHEN i % 2 = 1 THEN 100.0 ELSE 50.5 END AS height FROM placed) SELECT path, page, CAST(width AS DOUBLE) AS width, CAST(height AS DOUBLE) AS height, CAST(least(500.0 / CAST(width AS DOUBLE), 4.0) AS DOUBLE) AS scale FROM p")
def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pdf.read(spark, files_of_pages(spark, sf_dir), "pages")
    return longs(pages.withColumn("scale", assets.scale(F.col("width"), F.lit(500.0))), "page")


@F.pandas_udf(T.StringType())
def shown(content: pd.Series) -> pd.Series:
    """A PNG's samples as numbers, other bytes as text."""

    def one(data: bytes | None) -> str | None:
        if data is None:
            return None
        pixels = png.read(data)
        return data.decode() if pixels is None else ",".join(map(str, pixels.ravel().tolist()))

    return content.map(one)


@query(
    f"""WITH {PLACED_SQL} SELECT path, i + 1 AS page, 1 AS idx, CAST(4 AS BIGINT) AS width, printf('page_%03d_img_01.%s', i + 1, CASE WHEN i % 2 = 1 THEN 'png' ELSE 'jpg' END) AS name,
    CASE WHEN i % 2 = 1 THEN concat_ws(',', v, v + 4, w, w + 4, v + 8, v + 12, w + 8, w + 12) ELSE 'jpeg ' || url END AS held FROM placed"""
)
def pdf_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = pdf.read(spark, files_of_pages(spark, sf_dir), "images")
    name = assets.image_name(F.col("page"), F.col("idx"), F.col("ext")).alias("name")
    return longs(images.select("path", "page", "idx", "width", name, shown("content").alias("held")), "page", "width").withColumn("idx", F.col("idx").cast("int"))


@query(f"WITH {PLACED_SQL} SELECT path, i + 1 AS page, CASE WHEN i % 2 = 1 THEN concat_ws(',', v + 6, w + 6) END AS held FROM placed")
def pdf_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = assets.thumbnails(pdf.read(spark, files_of_pages(spark, sf_dir), "images"), max_width=2)
    return longs(images.select("path", "page", shown("thumbnail").alias("held")), "page")
