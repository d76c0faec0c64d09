import random

import numpy as np
import pytest

from folio.llm import webp
from tests.llm.cases import empty, rows, table


def _codes(w, lengths):
    webp._write_lengths(w, lengths)
    return webp.canonical(lengths)


def _flat(n, size):
    """2 ** n symbols of n bits each."""
    return [n] * (1 << n) + [0] * (size - (1 << n))


class Image:
    """A stream writer for tests: codes of equal lengths, pixels as given operations."""

    def __init__(self, width, height):
        self.w = webp.Writer()
        self.w.put(0x2F, 8)
        self.w.put(width - 1, 14)
        self.w.put(height - 1, 14)
        self.w.put(1, 1)
        self.w.put(0, 3)

    def entropy(self, ops, cache_bits=0, main=False):
        w = self.w
        w.put(bool(cache_bits), 1)
        if cache_bits:
            w.put(cache_bits, 4)
        if main:
            w.put(0, 1)
        size = 280 + (1 << cache_bits if cache_bits else 0)
        green = [9] * size if size == 512 else [8 if i < 232 else 9 for i in range(280)] if size == 280 else None
        assert green and abs(sum(2.0**-x for x in green) - 1) < 1e-9
        g = _codes(w, green)
        rest = [_codes(w, _flat(8, 256)) for _ in range(3)]
        far = _codes(w, [5] * 24 + [6] * 16)
        for op in ops:
            if op[0] == "argb":
                p = op[1]
                for (code, bits), v in zip((g, rest[0], rest[1], rest[2]), (p >> 8 & 255, p >> 16 & 255, p & 255, p >> 24)):
                    w.put(int(code[v]), int(bits[v]))
            elif op[0] == "copy":
                for (code, bits), base, v in ((g, 256, op[1]), (far, 0, op[2])):
                    symbol, extra, n = self.prefix(v)
                    w.put(int(code[base + symbol]), int(bits[base + symbol]))
                    w.put(extra, n)
            else:
                w.put(int(g[0][280 + op[1]]), int(g[1][280 + op[1]]))

    @staticmethod
    def prefix(v):
        v -= 1
        if v < 4:
            return v, 0, 0
        high = v.bit_length() - 1
        second = v >> (high - 1) & 1
        return 2 * high + second, v & ((1 << (high - 1)) - 1), high - 1

    def transform(self, kind):
        self.w.put(1, 1)
        self.w.put(kind, 2)

    def data(self):
        bits = np.array(self.w.bits + [0] * (-len(self.w.bits) % 8), np.uint8)
        return np.packbits(bits, bitorder="little").tobytes()


def argb(image):
    x = image.astype(np.uint32)
    return (x[..., 3] << 24 | x[..., 0] << 16 | x[..., 1] << 8 | x[..., 2]).reshape(-1).tolist()


def test_a_cut_stream_is_an_error():
    im = Image(10, 10)
    im.w.put(0, 1)
    im.entropy([("argb", 5)] * 100, main=True)
    with pytest.raises(ValueError):
        webp.decode_bits(im.data()[:-8])


def test_copies_whole():
    rnd = random.Random(2)
    pixels = [rnd.getrandbits(32) for _ in range(40)]
    im = Image(10, 10)
    im.w.put(0, 1)
    im.entropy([("argb", p) for p in pixels] + [("copy", 10, 1), ("copy", 20, 120 + 7), ("copy", 30, 2)], main=True)
    out = list(pixels)
    for n, d in ((10, 10), (20, 7), (30, 1)):
        for _ in range(n):
            out.append(out[-d])
    assert argb(webp.decode_bits(im.data())) == out


def test_colour_cache():
    bits, pixels = 8, [0xFF112233, 0x01020304, 0xFFFFFFFF]
    # an alphabet of 280 + 232 is no power of two cache: 8 bits give 536 symbols
    lengths = [9] * 488 + [10] * 48
    im = Image(6, 1)
    im.w.put(0, 1)
    im.w.put(1, 1)
    im.w.put(bits, 4)
    im.w.put(0, 1)
    g = _codes(im.w, lengths)
    rest = [_codes(im.w, _flat(8, 256)) for _ in range(3)]
    webp._write_only(im.w, 0)
    for p in pixels:
        for (code, n), v in zip((g, *rest), (p >> 8 & 255, p >> 16 & 255, p & 255, p >> 24)):
            im.w.put(int(code[v]), int(n[v]))
    for p in reversed(pixels):
        slot = 280 + ((0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - bits))
        im.w.put(int(g[0][slot]), int(g[1][slot]))
    assert argb(webp.decode_bits(im.data())) == pixels + pixels[::-1]


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    rnd = np.random.default_rng(mode)
    width, height = 7, 6
    want = argb(rnd.integers(0, 256, (height, width, 4), dtype=np.uint8))
    residual = []
    for i, p in enumerate(want):
        y, x = divmod(i, width)
        guess = (want[i - 1] if x else 0xFF000000) if y == 0 else want[i - width] if x == 0 else webp.predict(mode, want[i - 1], want[i - width], want[i - width + 1], want[i - width - 1])
        residual.append(sum((((p >> s) - (guess >> s)) & 255) << s for s in (0, 8, 16, 24)))
    im = Image(width, height)
    im.transform(0)
    im.w.put(0, 3)
    im.entropy([("argb", mode << 8)] * 4)
    im.w.put(0, 1)
    im.entropy([("argb", p) for p in residual], main=True)
    assert argb(webp.decode_bits(im.data())) == want


def test_predictors_by_hand():
    a, b, c = 0xFF102030, 0xFF203040, 0xFF182838
    assert webp.predict(1, a, b, 0, c) == a and webp.predict(2, a, b, 0, c) == b and webp.predict(4, a, b, 0, c) == c
    assert webp.predict(7, a, b, 0, c) == 0xFF182838
    assert webp.predict(12, a, b, 0, c) == 0xFF182838
    assert webp.predict(11, 0xFF000000, 0xFF0A0000, 0, 0xFF000000) == 0xFF0A0000
    assert webp.predict(13, a, b, 0, 0xFF000000) == 0xFF243C54


def test_cross_colour_and_subtract_green():
    rnd = np.random.default_rng(5)
    width, height = 5, 4
    want = argb(rnd.integers(0, 256, (height, width, 4), dtype=np.uint8))
    green_red, green_blue, red_blue = 40, -17, 99
    s8 = lambda v: v - 256 if v > 127 else v
    coded = []
    for p in want:
        r, g, b = p >> 16 & 255, p >> 8 & 255, p & 255
        r, b = (r - g) & 255, (b - g) & 255  # subtract green comes first when coding
        b = (b - (green_blue * s8(g) >> 5) - (red_blue * s8(r) >> 5)) & 255
        r = (r - (green_red * s8(g) >> 5)) & 255
        coded.append(p & 0xFF00FF00 | r << 16 | b)
    im = Image(width, height)
    im.transform(2)
    im.transform(1)
    im.w.put(0, 3)
    im.entropy([("argb", 0xFF000000 | (red_blue & 255) << 16 | (green_blue & 255) << 8 | green_red & 255)] * 2)
    im.w.put(0, 1)
    im.entropy([("argb", p) for p in coded], main=True)
    assert argb(webp.decode_bits(im.data())) == want


@pytest.mark.parametrize("colours", [2, 3, 9, 40])
def test_palette(colours):
    rnd = random.Random(colours)
    width, height = 11, 3
    table_ = [rnd.getrandbits(32) for _ in range(colours)]
    indices = [rnd.randrange(colours) for _ in range(width * height)]
    k = 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0
    each = 8 >> k
    packed = []
    for y in range(height):
        row = indices[y * width : (y + 1) * width]
        for x in range(0, width, 1 << k):
            packed.append(sum(v << (i * each) for i, v in enumerate(row[x : x + (1 << k)])) << 8)
    deltas = [table_[0]] + [sum((((b >> s) - (a >> s)) & 255) << s for s in (0, 8, 16, 24)) for a, b in zip(table_, table_[1:])]
    im = Image(width, height)
    im.transform(3)
    im.w.put(colours - 1, 8)
    im.entropy([("argb", p) for p in deltas])
    im.w.put(0, 1)
    im.entropy([("argb", p) for p in packed], main=True)
    assert argb(webp.decode_bits(im.data())) == [table_[i] for i in indices]
    # such an image also goes through the reader of many


def test_near_pixels():
    assert len(webp.NEAR) == 120
    assert webp.NEAR[:6] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0)] and webp.NEAR[-1] == (8, 7)


def awkward():
    rnd = random.Random(3)
    texts = [None, "", "a", "same " * 500, "x" * 5000, "ab" * 40, "abcd" * 400, "".join(rnd.choice("abcdefgh ") for _ in range(9000))]
    texts += ["line of sixty four characters, so it is found right above it. \n" * 60, " ".join(rnd.choice(("the", "word", "of", "a", "house")) for _ in range(4000))]
    payloads = [webp.payload_of(t)[1] for t in texts]
    payloads += [bytes(rnd.randrange(256) for _ in range(64 * n)) for n in (1, 2, 50)]
    # grey pixels, and steps from pixel to pixel
    payloads += [bytes(x for v in (rnd.randrange(256) for _ in range(640)) for x in (v, v, v, 255)), bytes((k * 3 + c) % 256 for k in range(1600) for c in range(4))]
    return payloads


def test_payload_round_trip():
    payloads = awkward()
    media = webp.encode_payloads(payloads)
    assert webp.decode_payloads(media) == payloads
    for m, p in zip(media, payloads):
        image = webp.decode_image(m)
        assert image.tobytes() == p and image.shape == (len(p) // 64, 16, 4)
        assert m[:4] == b"RIFF" and list(webp.chunks(m)) == [b"VP8L"] and len(m) % 2 == 0


def test_every_step_of_the_decoder_is_used(monkeypatch):
    """What the writer stores takes the reader through palettes, predictors, cross-colour, cache and back-references."""
    used = set()
    for name in ("undo_palette", "undo_predictor", "undo_cross_colour", "_extent"):
        step = getattr(webp, name)
        monkeypatch.setattr(webp, name, lambda *a, f=step, n=name: used.add(n) or f(*a))
    cached = []
    coded = webp._coded

    def seen(form, pixels, count):
        out = coded(form, pixels, count)
        if form.cache:
            codes, sizes = form.channels[0]
            at = set(zip(codes[280:].tolist(), sizes[280:].tolist()))
            cached.append(sum(x in at for x in zip(out[0].tolist(), out[1].tolist())))
        return out

    monkeypatch.setattr(webp, "_coded", seen)
    assert webp.decode_payloads(webp.encode_payloads(awkward())) == awkward()
    assert used == {"undo_palette", "undo_predictor", "undo_cross_colour", "_extent"} and sum(cached) > 100


def test_a_payload_that_is_too_high_is_one_wider_image():
    rnd = random.Random(9)
    payload = bytes(rnd.randrange(97, 105) for _ in range(64 * 600)) * 28
    media = webp.encode_payloads([payload, b"ab" * 32])
    assert webp.decode_payloads(media) == [payload, b"ab" * 32]
    assert webp.decode_image(media[0]).shape[1] == 32 and webp.LENGTH_CHUNK in webp.chunks(media[0])


def test_features_by_hand():
    assert webp.feature(bytes(64)) == "rows=1 distinct=1 mean=0.0000 entropy=0.0000 step=0.0000"
    assert webp.feature(bytes([0, 2] * 32)) == "rows=1 distinct=2 mean=1.0000 entropy=1.0000 step=2.0000"


def test_table(spark):
    import hashlib
    import zlib

    got = webp.round_trip(table(spark)).collect()
    want = sorted(((r[0], *webp.payload_of(r[1])) for r in rows()), key=repr)
    for g, (i, n, p) in zip(sorted(got, key=lambda g: repr((g.doc_id, g.n_bytes, dict((hashlib.sha256(w[2]).hexdigest(), w[2]) for w in want)[g.payload_sha256]))), want, strict=True):
        assert (g.doc_id, g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (i, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert len({(g.payload_sha256, g.media_sha256, g.feature) for g in got}) == len({g.payload_sha256 for g in got})
    assert webp.round_trip(empty(spark)).count() == 0
    assert webp.media_column(table(spark)).count() == len(rows())


def test_more_than_an_image_holds(monkeypatch):
    monkeypatch.setattr(webp, "MOST_BYTES", 640)
    assert webp.decode_payloads(webp.encode_payloads([bytes(640)])) == [bytes(640)]
    with pytest.raises(ValueError, match="more than one image holds"):
        webp.encode_payloads([bytes(64), bytes(704)])
