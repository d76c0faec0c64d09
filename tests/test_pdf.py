"""PDF files made here are read back; PNG rows against the filters' definitions."""

import io
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from folio.functions import png
from folio.operators import assets
from folio.plans.pdf_cases import document
from folio.sources import pdf


def opened(data):
    return pdf.Pdf(pa.PythonFile(io.BytesIO(data), mode="r"))


@pytest.mark.parametrize("style", [0, 1, 2])
def test_documents_of_any_form(style):
    rnd = random.Random(style)
    for n in (0, 1, 2, 7, 60):
        level, entries = 0, []
        for i in range(n):
            level = rnd.randint(1, level + 1)
            entries.append((level, rnd.choice(["a (b) \\ c", "中文", "plain", "", "ü"]) + str(i)))
        images = [(b"/Width 1 /Height 1 /BitsPerComponent 8 /ColorSpace /DeviceRGB", bytes([i, 2, 3])) for i in range(n)]
        found = opened(document(entries, images, style))
        assert list(found.bookmarks()) == [(i, lv, t, i + 1) for i, (lv, t) in enumerate(entries)]
        assert [(p, i, k, w, h, png.read(d).ravel().tolist()) for p, i, k, w, h, d in found.images()] == [(i + 1, 1, "png", 1, 1, [i, 2, 3]) for i in range(n)]
        assert [p for p, _, _ in found.page_sizes()] == list(range(1, n + 1))


def test_broken_references_are_searched():
    made = document([(1, "x"), (2, "y")], [(b"/Width 1 /Height 1", b"g")] * 2, 0)
    for broken in (made.replace(b"startxref\n", b"startxref\n9"), made.replace(b"xref\n0", b"xerf\n0"), made[: made.rindex(b"startxref")], b"junk in front\n" + made):
        assert [t for _, _, t, _ in opened(broken).bookmarks()] == ["x", "y"]
    packed = document([(1, "x"), (2, "y")], [(b"/Width 1 /Height 1", b"g")] * 2, 1)
    assert [t for _, _, t, _ in opened(packed.replace(b"startxref\n", b"startxref\n9")).bookmarks()] == ["x", "y"]


def test_outlines_that_run_in_circles():
    made = document([(1, "x"), (1, "y")], [(b"/Width 1 /Height 1", b"g")] * 2, 2)
    assert b"/Next 13 0 R" in made
    looped = made.replace(b"/Title (y)", b"/Title (y) /Next 12 0 R /First 13 0 R")
    assert [t for _, _, t, _ in opened(looped).bookmarks()] == ["x", "y"]


def test_objects():
    assert pdf.scanned(rb"<< /A#20b [1 -2.5 (a\(b\)\053\nc(d)) <4 1 5> 3 0 R true null] >> endobj ")[:2] == ([{"A b": [1, -2.5, b"a(b)+\nc(d)", b"AP", pdf.Ref(3, 0), True, None]}], b"endobj")
    for cut in (b"(open", b"<< /A 1", b"[1 2"):
        with pytest.raises(pdf.Unfinished):
            pdf.scanned(cut + b" ")
    assert [pdf.text_of(x) for x in (b"\xfe\xff\x4e\x2d", b"\xef\xbb\xbf\xc3\xa9", b"\x80\xa0\x18A\xe9")] == ["中", "é", "•€˘Aé"]


def filtered(pixels, kinds):
    """PNG rows by the filters' definitions, byte by byte."""
    height, width, channels = pixels.shape
    rows = pixels.reshape(height, -1).astype(int)
    out = b""
    for y in range(height):
        row = bytearray([kinds[y % len(kinds)]])
        for x in range(width * channels):
            a = rows[y, x - channels] if x >= channels else 0
            b = rows[y - 1, x] if y else 0
            c = rows[y - 1, x - channels] if y and x >= channels else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            row.append(int(rows[y, x] - (0, a, b, (a + b) // 2, paeth)[row[0]]) & 255)
        out += bytes(row)
    return out


def test_png_rows():
    rnd = np.random.default_rng(1)
    for channels in (1, 2, 3, 4):
        pixels = rnd.integers(0, 256, (9, 7, channels), dtype=np.uint8)
        got = png.unfiltered(filtered(pixels, [4, 1, 3, 2, 0]), 7 * channels, channels)
        assert (got.reshape(pixels.shape) == pixels).all()
        assert (png.read(png.write(pixels)) == pixels).all()


def image(kind, bits, width, height, rows, palette=b""):
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, kind, 0, 0, 0)) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_png_of_few_bits_and_palettes():
    assert png.read(image(0, 1, 3, 2, b"\x00\xa0\x00\x40"))[:, :, 0].tolist() == [[255, 0, 255], [0, 255, 0]]
    assert png.read(image(3, 4, 2, 1, b"\x00\x10", b"\x01\x02\x03\x04\x05\x06")).tolist() == [[[4, 5, 6], [1, 2, 3]]]
    assert png.read(image(0, 16, 1, 1, b"\x00\x12\x34")).tolist() == [[[0x12]]]
    assert png.read(b"no image") is None


def test_smaller():
    one = np.arange(24, dtype=np.uint8).reshape(4, 6, 1)
    assert png.smaller(one, 3, 2)[:, :, 0].tolist() == np.rint(one[:, :, 0].reshape(2, 2, 3, 2).mean(axis=(1, 3))).tolist()
    assert png.smaller(np.full((5, 7, 3), 200, np.uint8), 3, 2).tolist() == [[[200] * 3] * 3] * 2
    assert png.smaller(np.array([[[0], [90], [30]]], np.uint8), 2, 1).ravel().tolist() == [30, 50]


def test_images_of_many_kinds():
    cases = [
        (b"/Width 2 /Height 1 /BitsPerComponent 8 /ColorSpace [/Indexed /DeviceRGB 1 <010203040506>]", b"\x01\x00", "png", [4, 5, 6, 1, 2, 3]),
        (b"/Width 1 /Height 1 /BitsPerComponent 8 /ColorSpace /DeviceCMYK", bytes([0, 255, 0, 0]), "png", [255, 0, 255]),
        (b"/Width 2 /Height 1 /BitsPerComponent 1 /ColorSpace /DeviceGray", b"\x40", "png", [0, 255]),
        (b"/Width 1 /Height 1 /BitsPerComponent 8 /ColorSpace [/CalRGB << >>] /Filter [/ASCIIHexDecode]", b"0a0b0c>", "png", [10, 11, 12]),
        (b"/Width 1 /Height 1 /Filter [/FlateDecode /JPXDecode]", zlib.compress(b"jpx"), "jpx", b"jpx"),
        (b"/Width 1 /Height 1 /ColorSpace [/Separation /X /DeviceGray 1 0 R]", b"raw", "bin", b"raw"),
        (b"/Width 9 /Height 9 /ColorSpace /DeviceRGB", b"short", "bin", b"short"),
    ]
    found = opened(document([(1, "t")] * len(cases), [c[:2] for c in cases], 0)).images()
    assert [(k, d if k != "png" else png.read(d).ravel().tolist()) for _, _, k, _, _, d in found] == [c[2:] for c in cases]


def test_source(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}/b.pdf").write_bytes(document([(1, f"t{i}"), (2, "u")], [(b"/Width 4 /Height 1", b"abcd"), (b"/Width 1 /Height 1 /Filter /DCTDecode", b"jpeg")], i % 3))
    (tmp_path / "x.txt").write_text("no")
    assert sorted(tuple(r) for r in pdf.read(spark, str(tmp_path), "bookmarks").where("toc_idx = 0").collect()) == [(f"d{i}/b.pdf", 0, 1, f"t{i}", 1) for i in range(5)]
    assert pdf.read(spark, str(tmp_path), "pages", "no*.pdf").collect() == []
    images = pdf.read(spark, str(tmp_path), "images")
    kept = assets.keep_first(images.withColumn("page", images["page"]), 4)
    assert kept.count() == 2
    small = assets.thumbnails(images, 2).where("path = 'd0/b.pdf'").orderBy("page").collect()
    assert png.read(bytes(small[0].thumbnail)).shape == (1, 2, 1) and small[1].thumbnail is None
    (tmp_path / "bad.pdf").write_text("not at all")
    with pytest.raises(Exception, match="bad.pdf: not a PDF file"):
        pdf.read(spark, str(tmp_path), "pages").collect()
