"""Media columns: payloads stored as lossless WebP images and read back as pixel arrays.

A payload is one image a document: four samples a pixel (red, green, blue, alpha), WIDTH pixels a
row; an image that would be too high is wider, and a chunk then tells the payload's length.
`encode_payloads` chooses for each document what it estimates to be smallest: as it is with a colour cache; a palette
(with bundled indices if it is small) for few distinct pixels; or predictor and cross-colour
transforms where pixels follow from those above or before. All of them have back-references.
Prefix codes are fixed by rule, one set for each of the three forms.

`decode_image` reads any VP8L image: transforms (predictor, cross-colour, subtract-green,
palette with bundled indices), colour cache, back-references, prefix codes with and
without groups. Every stored byte is read by it. Prefix codes are read by tables of all windows
of their longest code; equal headers are parsed once.

Defined results: a null text is an empty one, whose payload is 64 zero bytes. Each row
gives a row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm.batches import lean

from folio.llm.textnum import U64, mix, span_hashes

WIDTH, MAX_SIDE = 16, 1 << 14
#: What the widest and highest image holds, 1 GiB.
MOST_BYTES = 4 * MAX_SIDE * MAX_SIDE
#: Texts of a slice, beside its bound of bytes.
SLICE_ROWS = 1000
#: Payload bytes that are coded at once; bounds a worker's arrays.
BATCH_BYTES = 2 << 20
CACHE_BITS = 9
#: Pixels of a back-reference, at least and at most, and the farthest one.
LEAST_COPY, MOST_COPY, FARTHEST = 4, 4096, (1 << 20) - 120
#: Rows of a predictor tile, as a power of two.
TILE_BITS = 4

#: Fixed value of the format: the order in which lengths of the code-length code stand.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Near pixels by distance code: by squared distance, then columns away, the left one first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class Bits:
    """Bits of a byte string, lowest first."""

    def __init__(self, data: bytes):
        self.at, self.size = 0, 8 * len(data)
        self.data = data

    def peek(self) -> int:
        """The bits ahead, 64 at least as far as there are any."""
        a = self.at >> 3
        return int.from_bytes(self.data[a : a + 9], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        at = self.at
        self.at = at + n
        if self.at > self.size:
            raise ValueError("the image ends early")
        a = at >> 3
        return (int.from_bytes(self.data[a : a + (n + 14 >> 3)], "little") >> (at & 7)) & ((1 << n) - 1)


class Prefix:
    """A prefix code by its code lengths; a code of one symbol takes no bits.

    table: for each window of `width` bits the symbol that comes first, times 16, and its length.
    """

    def __init__(self, lengths: list[int]):
        self.lengths = lengths
        used = [s for s, n in enumerate(lengths) if n]
        if not used:
            raise ValueError("a prefix code without symbols")
        self.only = used[0] if len(used) == 1 else None
        self.codes: dict[tuple[int, int], int] = {}
        self.width, self.table = 0, [used[0] << 4]
        if self.only is None:
            code, last = 0, 0
            for s in sorted(used, key=lambda s: (lengths[s], s)):
                code <<= lengths[s] - last
                last = lengths[s]
                self.codes[last, code] = s
                code += 1
            if code != 1 << last:
                raise ValueError("a prefix code that is not complete")
            self.width = last
            table = np.zeros(1 << last, np.int64)
            for (n, c), s in self.codes.items():
                table[int(f"{c:0{n}b}"[::-1], 2) :: 1 << n] = s << 4 | n
            self.table = table.tolist()

    def read(self, bits: Bits) -> int:
        got = self.table[bits.peek() & (1 << self.width) - 1]
        bits.read(got & 15)
        return got >> 4


def read_prefix(bits: Bits, size: int) -> Prefix:
    lengths = [0] * size
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return Prefix(lengths)
    own = [0] * 19
    for s in LENGTH_ORDER[: 4 + bits.read(4)]:
        own[s] = bits.read(3)
    code = Prefix(own)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    at, last = 0, 8
    while at < size and left:
        left -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            last = s or last
            at += 1
            continue
        value, n = (last, 3 + bits.read(2)) if s == 16 else (0, 3 + bits.read(3)) if s == 17 else (0, 11 + bits.read(7))
        if at + n > size:
            raise ValueError("code lengths beyond the alphabet")
        lengths[at : at + n] = [value] * n
        at += n
    return Prefix(lengths)


def _extent(bits: Bits, symbol: int) -> int:
    """The number that a length or distance symbol and its extra bits stand for."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def _up(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


#: Parsed codes by the bits that they were read from, for images with equal headers: (bits, alphabet sizes) of each.
_parsed: dict[tuple[int, tuple[int, ...]], dict[int, list[Prefix]]] = {}


def read_codes(bits: Bits, sizes: tuple[int, ...]) -> list[Prefix]:
    start = bits.at

    def ahead(n: int) -> int:
        return int.from_bytes(bits.data[start >> 3 : (start + n + 7) >> 3], "little") >> (start & 7) & (1 << n) - 1

    for (n, kinds), heads in _parsed.items():
        if kinds == sizes and start + n <= bits.size and (got := heads.get(ahead(n))):
            bits.at = start + n
            return got
    codes = [read_prefix(bits, n) for n in sizes]
    n = bits.at - start
    if len(_parsed) < 32 and len(heads := _parsed.setdefault((n, sizes), {})) < 64:
        heads[ahead(n)] = codes
    return codes


def read_entropy_coded(bits: Bits, width: int, height: int, main: bool) -> list[int]:
    """ARGB numbers of an entropy-coded image."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    cache = [0] * (1 << cache_bits) if cache_bits else []
    group_bits, which, groups = 0, [], 1
    if main and bits.read(1):
        group_bits = bits.read(3) + 2
        which = [p >> 8 & 0xFFFF for p in read_entropy_coded(bits, _up(width, group_bits), _up(height, group_bits), False)]
        groups = max(which) + 1
    sets = [read_codes(bits, (280 + len(cache), 256, 256, 256, 40)) for _ in range(groups)]
    # tables and masks of each group's codes
    told = [[x for c in codes for x in (c.table, (1 << c.width) - 1)] for codes in sets]
    greens, g_mask, reds, r_mask, blues, b_mask, alphas, a_mask, fars, f_mask = told[0]
    out: list[int] = []
    wide, total, put, n = _up(width, group_bits), width * height, 0, 0
    data, at, shift, number = bits.data, bits.at, 32 - cache_bits, int.from_bytes
    while n < total:
        if which:
            greens, g_mask, reds, r_mask, blues, b_mask, alphas, a_mask, fars, f_mask = told[which[(n // width >> group_bits) * wide + (n % width >> group_bits)]]
        k = at >> 3
        ahead = number(data[k : k + 9], "little") >> (at & 7)
        got = greens[ahead & g_mask]
        k = got & 15
        s = got >> 4
        if s < 256:
            got = reds[ahead >> k & r_mask]
            k += got & 15
            p = s << 8 | got >> 4 << 16
            got = blues[ahead >> k & b_mask]
            k += got & 15
            p |= got >> 4
            got = alphas[ahead >> k & a_mask]
            at += k + (got & 15)
            out.append(p | got >> 4 << 24)
            n += 1
        elif s < 280:
            bits.at = at + k
            length = _extent(bits, s - 256)
            got = fars[bits.peek() & f_mask]
            bits.read(got & 15)
            d = _extent(bits, got >> 4)
            at = bits.at
            if d > len(NEAR):
                d -= len(NEAR)
            else:
                x, y = NEAR[d - 1]
                d = max(1, x + y * width)
            if d > n or n + length > total:
                raise ValueError("a back-reference outside the image")
            part = out[n - d : n - d + length]
            while len(part) < length:
                part += part[: length - len(part)]
            out += part
            n += length
        else:
            for p in out[put:]:
                cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> shift] = p
            put = n
            at += k
            out.append(cache[s - 280])
            n += 1
        if at > bits.size:
            raise ValueError("the image ends early")
    bits.at = at
    return out


def _average(a: int, b: int) -> int:
    return (a & b) + (((a ^ b) & 0xFEFEFEFE) >> 1)


def _bytes(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _number(parts: list[int]) -> int:
    return parts[0] << 24 | parts[1] << 16 | parts[2] << 8 | parts[3]


def _clip(x: int) -> int:
    return 0 if x < 0 else 255 if x > 255 else x


def _select(left: int, top: int, corner: int) -> int:
    to_left = to_top = 0
    for l, t, c in zip(_bytes(left), _bytes(top), _bytes(corner), strict=True):
        to_left += abs(t - c)
        to_top += abs(l - c)
    return left if to_left < to_top else top


def _half(a: int, b: int) -> int:
    # division toward zero, as in C
    d = a - b
    return _clip(a + (d // 2 if d >= 0 else -(-d // 2)))


def predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """What the predictor of a mode says for a pixel; right and corner: above it, to the right and to the left."""
    match mode:
        case 1:
            return left
        case 2:
            return top
        case 3:
            return right
        case 4:
            return corner
        case 5:
            return _average(_average(left, right), top)
        case 6:
            return _average(left, corner)
        case 7:
            return _average(left, top)
        case 8:
            return _average(corner, top)
        case 9:
            return _average(top, right)
        case 10:
            return _average(_average(left, corner), _average(top, right))
        case 11:
            return _select(left, top, corner)
        case 12:
            return _number([_clip(l + t - c) for l, t, c in zip(_bytes(left), _bytes(top), _bytes(corner), strict=True)])
        case 13:
            return _number([_half(a, c) for a, c in zip(_bytes(_average(left, top)), _bytes(corner), strict=True)])
    return 0xFF000000


def add(a: int, b: int) -> int:
    """Channel by channel, modulo 256."""
    return (a & 0xFF00FF00) + (b & 0xFF00FF00) & 0xFF00FF00 | (a & 0x00FF00FF) + (b & 0x00FF00FF) & 0x00FF00FF


def _channels(pixels: np.ndarray, width: int) -> np.ndarray:
    """Rows, columns and blue, green, red, alpha of ARGB numbers."""
    return pixels.astype("<u4").reshape(-1, width).view(np.uint8).reshape(-1, width, 4)


def undo_predictor(pixels: np.ndarray, width: int, bits: int, modes: list[int]) -> np.ndarray:
    """Bands of rows with one of the modes black, left or top go by running sums, others pixel by pixel."""
    x = _channels(pixels, width).copy()
    black, wide = np.array([0, 0, 0, 255], np.uint8), _up(width, bits)
    x[0, 0] += black
    x[0] = np.cumsum(x[0], axis=0, dtype=np.uint8)
    for y in range(1, len(x)):
        if y > 1 and y & (1 << bits) - 1:
            continue
        stop = min(len(x), (y >> bits) + 1 << bits)
        own = [p >> 8 & 15 for p in modes[(y >> bits) * wide : (y >> bits) * wide + wide]]
        band = x[y:stop]
        if len(set(own)) == 1 and own[0] < 3:
            first = np.cumsum(band[:, 0], axis=0, dtype=np.uint8) + x[y - 1, 0]
            if own[0] == 2:
                band[:] = np.cumsum(band, axis=0, dtype=np.uint8) + x[y - 1]
            elif own[0] == 1:
                band[:, 0] = first
                band[:] = np.cumsum(band, axis=1, dtype=np.uint8)
            else:
                band[:, 0] = first
                band[:, 1:] += black
            continue
        numbers = x.view("<u4").reshape(-1, width)
        for row in range(y, stop):
            above, now = numbers[row - 1].tolist(), numbers[row].tolist()
            above.append(0)
            for i in range(width):
                right = above[i + 1] if i + 1 < width else now[0]
                now[i] = add(now[i], predict(own[i >> bits], now[i - 1], above[i], right, above[i - 1]) if i else above[0])
            numbers[row] = now
    return x.view("<u4").reshape(-1)


def undo_cross_colour(pixels: np.ndarray, width: int, bits: int, factors: list[int]) -> np.ndarray:
    x = _channels(pixels, width).copy()
    f = _channels(np.array(factors, np.uint32), _up(width, bits)).view(np.int8).astype(np.int32)
    f = np.repeat(np.repeat(f, 1 << bits, axis=0)[: len(x)], 1 << bits, axis=1)[:, :width]
    green = x[:, :, 1].view(np.int8).astype(np.int32)
    x[:, :, 2] += (f[:, :, 0] * green >> 5).astype(np.uint8)
    red = np.ascontiguousarray(x[:, :, 2]).view(np.int8).astype(np.int32)
    x[:, :, 0] += ((f[:, :, 1] * green >> 5) + (f[:, :, 2] * red >> 5)).astype(np.uint8)
    return x.view("<u4").reshape(-1)


def undo_subtract_green(pixels: np.ndarray, width: int, *_: object) -> np.ndarray:
    x = _channels(pixels, width).copy()
    x[:, :, 0] += x[:, :, 1]
    x[:, :, 2] += x[:, :, 1]
    return x.view("<u4").reshape(-1)


def undo_palette(pixels: np.ndarray, width: int, bits: int, table: list[int]) -> np.ndarray:
    """width: of the image itself, whose rows hold 1 << bits indices in a pixel."""
    each = 8 >> bits
    index = pixels.reshape(-1, _up(width, bits)) >> 8 & 255
    index = (index[:, :, None] >> np.arange(1 << bits) * each & (1 << each) - 1).reshape(len(index), -1)[:, :width]
    colours = np.zeros(256, np.uint32)
    colours[: len(table)] = table
    return colours[index].reshape(-1)


def decode_bits(data: bytes) -> np.ndarray:
    """The VP8L stream as an array of rows, columns and the channels red, green, blue, alpha."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless image")
    full, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("an unknown version")
    width, undo = full, []
    while bits.read(1):
        kind = bits.read(2)
        if kind < 2:
            k = bits.read(3) + 2
            own = read_entropy_coded(bits, _up(width, k), _up(height, k), False)
            undo.append((undo_predictor if kind == 0 else undo_cross_colour, width, k, own))
        elif kind == 2:
            undo.append((undo_subtract_green, width, 0, []))
        else:
            n = bits.read(8) + 1
            table, last = [], 0
            for p in read_entropy_coded(bits, n, 1, False):
                table.append(last := add(last, p))
            k = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((undo_palette, width, k, table))
            width = _up(width, k)
    pixels = np.array(read_entropy_coded(bits, width, height, True), np.uint32)
    for step, wide, k, own in reversed(undo):
        pixels = step(pixels, wide, k, own)
    argb = pixels.reshape(height, full)
    return np.stack([argb >> s & 255 for s in (16, 8, 0, 24)], axis=-1).astype(np.uint8)


def chunks(media: bytes) -> dict[bytes, bytes]:
    """The chunks of a WebP file by name."""
    if media[:4] != b"RIFF" or media[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    out, k, stop = {}, 12, 8 + struct.unpack_from("<I", media, 4)[0]
    while k + 8 <= stop:
        name, n = media[k : k + 4], struct.unpack_from("<I", media, k + 4)[0]
        out[name] = media[k + 8 : k + 8 + n]
        k += 8 + n + (n & 1)
    return out


def decode_image(media: bytes) -> np.ndarray:
    """The image of a lossless WebP file: rows, columns, red green blue alpha."""
    return decode_bits(chunks(media)[b"VP8L"])


#: Our own chunk, which other readers pass over: the payload's length, where the last row is not full.
LENGTH_CHUNK = b"PLEN"


def wrap(stream: bytes, length: int | None = None) -> bytes:
    body = b"WEBPVP8L" + struct.pack("<I", len(stream)) + stream + b"\0" * (len(stream) & 1)
    if length is not None:
        body += LENGTH_CHUNK + struct.pack("<IQ", 8, length)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def text_code() -> list[int]:
    """Code lengths for a channel of text: 5 bits for the blank and 23 letters, 8 for 24 other common bytes, 10 or 11 for the rest."""
    short = b" etaoinshrdlcumwfgypbvk."[:24]
    middle = b"\0\n,xjqzETAOINSHRDL!$%&*#"[:24]
    rest = [b for b in range(256) if b not in short + middle]
    lengths = [0] * 256
    for group, n in ((short, 5), (middle, 8), (rest[:112], 10), (rest[112:], 11)):
        for b in group:
            lengths[b] = n
    return lengths


def steps(*runs: tuple[int, int]) -> list[int]:
    """Code lengths in runs of (how many, bits)."""
    return [n for count, n in runs for _ in range(count)]


def canonical(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes as they stand in the stream (first bit lowest) and their lengths."""
    code = Prefix(lengths)
    out = np.zeros(len(lengths), np.uint32)
    for (n, c), s in code.codes.items():
        out[s] = int(f"{c:0{n}b}"[::-1], 2)
    return out, np.array(lengths, np.int64)


class Writer:
    def __init__(self) -> None:
        self.bits: list[int] = []

    def put(self, value: int, n: int) -> None:
        self.bits += [value >> k & 1 for k in range(n)]


def _write_lengths(w: Writer, lengths: list[int]) -> None:
    """A normal code for these lengths; runs of zeros and repeats of the length before go by run symbols."""
    runs: list[tuple[int, int, int]] = []  # symbol, extra bits, their value
    at, last = 0, 8
    while at < len(lengths):
        n, value = 1, lengths[at]
        while at + n < len(lengths) and lengths[at + n] == value and n < 138:
            n += 1
        if value == 0 and n >= 11:
            runs.append((18, 7, n - 11))
        elif value and value == last and n >= 3:
            n = min(n, 6)
            runs.append((16, 2, n - 3))
        else:
            n = 1
            runs.append((value, 0, 0))
        last = value or last
        at += n
    used = sorted({s for s, _, _ in runs})
    depth = 1
    while 1 << depth < len(used):
        depth += 1
    short = (1 << depth) - len(used)  # so many symbols get a bit less
    own = [0] * 19
    for k, s in enumerate(used):
        own[s] = depth - (k < short)
    if len(used) == 1:
        own[used[0]] = 1
    w.put(0, 1)
    w.put(15, 4)
    for s in LENGTH_ORDER:
        w.put(own[s], 3)
    w.put(0, 1)
    codes, sizes = canonical(own) if len(used) > 1 else (np.zeros(19, int), np.zeros(19, int))
    for s, extra, value in runs:
        w.put(int(codes[s]), int(sizes[s]))
        w.put(value, extra)


def _write_only(w: Writer, symbol: int) -> None:
    w.put(1, 1)
    w.put(0, 1)
    w.put(symbol > 1, 1)
    w.put(symbol, 8 if symbol > 1 else 1)


PLAIN, PALETTE, PREDICTED = range(3)
#: Code lengths of back-reference distances, and of the green symbols from 256 on that are lengths.
FAR = steps((24, 5), (16, 6))


class Form:
    """The prefix codes of one of the three forms of image: what its header holds, and for each channel codes and sizes by symbol."""

    def __init__(self, kind: int):
        if kind == PLAIN:
            # half of the green code for literals, the rest for lengths and the cache
            green = [n + 1 for n in text_code()] + steps((8, 8), (16, 9)) + steps((768 >> 10 - CACHE_BITS, 11 - (10 - CACHE_BITS)), (256 >> 10 - CACHE_BITS, 12 - (10 - CACHE_BITS)))
            other = [text_code()] * 3
        elif kind == PALETTE:
            green, other = steps((8, 4), (16, 6), (32, 8), (120, 11), (80, 12), (24, 9)), [0, 0, 255]
        else:
            green, other = steps((1, 1), (161, 9), (94, 10), (24, 8)), [steps((1, 1), (1, 8), (254, 9))] * 3
        w = Writer()
        w.put(0, 1)  # no further transform
        w.put(kind == PLAIN, 1)
        if kind == PLAIN:
            w.put(CACHE_BITS, 4)
        w.put(0, 1)  # no groups
        _write_lengths(w, green)
        self.channels = [canonical(green)]
        for x in other:
            if isinstance(x, int):
                _write_only(w, x)
                self.channels.append((np.zeros(256, np.uint32), np.zeros(256, np.int64)))
            else:
                _write_lengths(w, x)
                self.channels.append(canonical(x))
        _write_lengths(w, FAR)
        self.far = canonical(FAR)
        self.head = np.array(w.bits, np.uint8)
        self.cache = kind == PLAIN


_forms: list[Form] = []


def _extent_fields(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol, extra bits and their value for lengths or distances from 1 on."""
    t = value - 1
    high = np.maximum(1, np.frexp(np.maximum(t, 1).astype(np.float64))[1] - 1)
    extra = np.where(t < 4, 0, high - 1)
    symbol = np.where(t < 4, t, 2 * high + (t >> np.maximum(0, high - 1) & 1))
    return symbol, extra, t & (1 << extra) - 1


def _copies(pixels: np.ndarray, doc: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, lengths and distances of back-references: runs of windows of LEAST_COPY pixels that occurred before in their image at one distance."""
    n = len(pixels) - LEAST_COPY + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none
    at = np.arange(n)
    start = at[at + LEAST_COPY <= stop[doc[:n]]]
    key = mix(span_hashes(pixels, start, start + LEAST_COPY) + doc[start].astype(U64))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    far = np.zeros(n, np.int64)
    to, back = start[order[1:][again]], start[order[:-1][again]]
    same = doc[to] == doc[back]
    for k in range(LEAST_COPY):
        same &= pixels[to + k] == pixels[back + k]
    far[to[same]] = (to - back)[same]
    far[far > FARTHEST] = 0
    edge = np.flatnonzero(np.concatenate(([True], far[1:] != far[:-1])))
    size = np.diff(np.append(edge, n))
    some = far[edge] > 0
    found, cursor = [], 0
    for a, m, d in zip(edge[some].tolist(), size[some].tolist(), far[edge[some]].tolist(), strict=True):
        a, b = max(a, cursor), a + m + LEAST_COPY - 1
        while b - a >= LEAST_COPY:
            m = min(b - a, MOST_COPY)
            found.append((a, m, d))
            a += m
            cursor = a
    if not found:
        return none, none, none
    return tuple(np.array(x, np.int64) for x in zip(*found, strict=True))


def _coded(form: Form, pixels: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values and sizes of all bit fields of some images' pixels, one image after the other, and how many fields each image has."""
    stop = np.cumsum(count)
    doc = np.repeat(np.arange(len(count)), count)
    place, length, far = _copies(pixels.astype(U64), doc, stop)
    covered = np.zeros(len(pixels) + 1, np.int64)
    covered[place] += 1
    np.add.at(covered, place + length, -1)
    emit = np.cumsum(covered[:-1]) == 0
    value, size = np.zeros((len(pixels), 4), np.uint32), np.zeros((len(pixels), 4), np.int64)
    literal = emit.copy()
    if form.cache:
        # a pixel is in the cache if the last one of its slot, copied or not, was the same
        slot = (pixels.astype(np.uint32) * np.uint32(0x1E35A7BD)) >> np.uint32(32 - CACHE_BITS)
        order = np.argsort((doc << CACHE_BITS) + slot, kind="stable")
        kept = np.zeros(len(pixels), bool)
        a, b = order[:-1], order[1:]
        kept[b] = (slot[a] == slot[b]) & (doc[a] == doc[b]) & (pixels[a] == pixels[b])
        hit = np.flatnonzero(emit & kept)
        literal[hit] = False
        value[hit, 0], size[hit, 0] = (x[280 + slot[hit]] for x in form.channels[0])
    some = np.flatnonzero(literal)
    for k, shift in enumerate((8, 16, 0, 24)):
        part = (pixels[some] >> shift & 255).astype(np.int64)
        value[some, k], size[some, k] = (x[part] for x in form.channels[k])
    symbol, extra, rest = _extent_fields(length)
    value[place, 0], size[place, 0] = (x[256 + symbol] for x in form.channels[0])
    value[place, 1], size[place, 1] = rest, extra
    symbol, extra, rest = _extent_fields(far + len(NEAR))
    value[place, 2], size[place, 2] = (x[symbol] for x in form.far)
    value[place, 3], size[place, 3] = rest, extra
    emit[place] = True
    fields = size > 0
    per = np.add.reduceat(fields.sum(axis=1), stop - count)
    return value[fields], size[fields], per


def _packed(heads: list[np.ndarray], value: np.ndarray, size: np.ndarray, per: np.ndarray) -> list[bytes]:
    """The streams of images: each a head of bits, then its fields."""
    first = np.cumsum(per) - per
    sums = np.concatenate(([0], np.cumsum(size)))
    body = sums[first + per] - sums[first]
    long = np.array([len(h) for h in heads])
    total = (long + body + 7) // 8 * 8
    at = np.cumsum(total) - total
    bits = np.zeros(int(total.sum()), np.uint8)
    for a, h in zip(at.tolist(), heads, strict=True):
        bits[a : a + len(h)] = h
    place = sums[:-1] + np.repeat(at + long - sums[first], per)
    bit = 0
    while len(value):
        bits[place] = value >> np.uint32(bit) & 1
        bit += 1
        live = size > bit
        if not live.all():
            place, value, size = place[live], value[live], size[live]
        place = place + 1
    packed = np.packbits(bits, bitorder="little").tobytes()
    return [packed[a : a + n] for a, n in zip((at // 8).tolist(), (total // 8).tolist(), strict=True)]


def _dims(width: int, height: int) -> list[int]:
    w = Writer()
    for x, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
        w.put(x, n)
    return w.bits


def _write_flat_image(w: Writer, pixels: list[int]) -> None:
    """A small entropy-coded image of literals: a channel with one value takes no bits, others eight."""
    w.put(0, 1)
    parts = [[p >> shift & 255 for p in pixels] for shift in (8, 16, 0, 24)]
    for k, part in enumerate(parts):
        if len(set(part)) == 1:
            _write_only(w, part[0])
        else:
            _write_lengths(w, steps((256, 8), (24, 0)) if k == 0 else steps((256, 8)))
    _write_only(w, 0)
    for row in zip(*parts, strict=True):
        for part, x in zip(parts, row, strict=True):
            if len(set(part)) > 1:
                w.put(int(f"{x:08b}"[::-1], 2), 8)


def _to_palette(pixels: np.ndarray, width: int) -> tuple[np.ndarray, int, list[int]]:
    """Index pixels, commonest colours first, their row length, and the bits of the transform."""
    colours, index, n = np.unique(pixels, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    table = colours[order].astype(np.uint32)
    k = 3 if len(n) <= 2 else 2 if len(n) <= 4 else 1 if len(n) <= 16 else 0
    rows = rank[index].reshape(-1, width)
    narrow = _up(width, k)
    rows = np.pad(rows, ((0, 0), (0, (narrow << k) - width))).reshape(len(rows), narrow, 1 << k)
    packed = (rows << np.arange(1 << k) * (8 >> k)).sum(axis=2)
    w = Writer()
    w.put(1, 1)
    w.put(3, 2)
    w.put(len(table) - 1, 8)
    before = np.concatenate((np.zeros(1, np.uint32), table[:-1]))
    delta = _channels(table, len(table))[0] - _channels(before, len(table))[0]
    _write_flat_image(w, delta.view("<u4").reshape(-1).tolist())
    return (packed.reshape(-1) << 8 | 0xFF000000).astype(np.uint32), narrow, w.bits


def _to_residuals(pixels: np.ndarray, width: int) -> tuple[np.ndarray, list[int]]:
    """What the best of the modes black, left and top leaves in each band, then what green leaves of red and blue; and the bits of both transforms."""
    x = _channels(pixels, width)
    left, top = x.copy(), x.copy()
    left[:, 1:] -= x[:, :-1]
    top[1:] -= x[:-1]
    black = x.copy()
    black[:, 1:] -= np.array([0, 0, 0, 255], np.uint8)
    black[1:, 0], left[1:, 0] = top[1:, 0], top[1:, 0]
    out, modes = top.copy(), []
    for y in range(0, len(x), 1 << TILE_BITS):
        band = slice(y, y + (1 << TILE_BITS))
        best = max((2, 1, 0), key=lambda m: int(((black, left, top)[m][band] == 0).sum()))
        out[band] = (black, left, top)[best][band]
        modes += [0xFF000000 | best << 8] * _up(width, TILE_BITS)
    out[0] = left[0]
    out[0, 0] = x[0, 0] - np.array([0, 0, 0, 255], np.uint8)
    w = Writer()
    w.put(1, 1)
    w.put(0, 2)
    w.put(TILE_BITS - 2, 3)
    _write_flat_image(w, modes)
    green = out[:, :, 1].view(np.int8).astype(np.int32)
    parts, chosen = [], []
    for channel in (2, 0):
        tried = {f: out[:, :, channel] - (f * green >> 5).astype(np.uint8) for f in (0, 16, 32, -16, -32)}
        best = max(tried, key=lambda f, t=tried: int((t[f] == 0).sum()))
        parts.append(tried[best])
        chosen.append(best & 255)
    out[:, :, 2], out[:, :, 0] = parts
    w.put(1, 1)
    w.put(1, 2)
    w.put(7, 3)
    wide, high = _up(width, 9), _up(len(x), 9)
    _write_flat_image(w, [0xFF000000 | chosen[1] << 8 | chosen[0]] * (wide * high))
    return out.view("<u4").reshape(-1), w.bits


def _forms_of(pixels: np.ndarray, doc: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """For each image the form with the fewest bits by estimate: literals, cached and repeated pixels, indices, residuals that are nothing."""
    n = len(count)
    order = np.argsort((doc.astype(U64) << U64(32)) + pixels, kind="stable")
    new = np.ones(len(pixels), bool)
    new[order[1:]] = (pixels[order[1:]] != pixels[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    kinds = np.bincount(doc, weights=new, minlength=n)
    plain = 24 * kinds + 11 * (count - kinds) + 1400
    few = np.where(kinds <= 256, 900 + 32 * kinds + np.where(kinds <= 16, 3, 8) * count, np.inf)
    same = np.zeros(len(pixels), bool)
    same[width:] = (pixels[width:] == pixels[:-width]) & (doc[width:] == doc[:-width])
    near = np.zeros(len(pixels), bool)
    near[1:] = (pixels[1:] == pixels[:-1]) & (doc[1:] == doc[:-1])
    follow = np.maximum(np.bincount(doc, weights=same, minlength=n), np.bincount(doc, weights=near, minlength=n))
    predicted = 900 + 4 * follow + 36 * (count - follow)
    return np.argmin(np.stack([plain, few, predicted]), axis=0)


def _encode_batch(payloads: list[bytes], width: int) -> list[bytes]:
    """Images of `width` pixels a row; payloads fill their rows."""
    if not _forms:
        _forms.extend(Form(k) for k in range(3))
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 4)
    pixels = np.ascontiguousarray(samples[:, [2, 1, 0, 3]]).view("<u4").reshape(-1)
    count = np.array([len(p) // 4 for p in payloads])
    start = np.cumsum(count) - count
    chosen = _forms_of(pixels, np.repeat(np.arange(len(count)), count), count, width)
    out: list[bytes] = [b""] * len(payloads)
    for kind, form in enumerate(_forms):
        which = np.flatnonzero(chosen == kind).tolist()
        if not which:
            continue
        heads, parts = [], []
        for i in which:
            own, bits = pixels[start[i] : start[i] + count[i]], []
            if kind == PALETTE:
                own, _, bits = _to_palette(own, width)
            elif kind == PREDICTED:
                own, bits = _to_residuals(own, width)
            parts.append(own)
            heads.append(np.concatenate((np.array(_dims(width, int(count[i]) // width) + bits, np.uint8), form.head)))
        coded = _coded(form, np.concatenate(parts), np.array([len(x) for x in parts]))
        for i, stream in zip(which, _packed(heads, *coded), strict=True):
            out[i] = stream
    return out


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """Each payload (a positive multiple of 64 bytes) as one WebP file."""
    row = 4 * WIDTH
    if max(map(len, payloads), default=0) > MOST_BYTES:
        raise ValueError(f"a payload of over {MOST_BYTES} bytes is more than one image holds")
    out: list[bytes] = []
    k = 0
    while k < len(payloads):
        if len(payloads[k]) > row * MAX_SIDE:
            # too high: as wide as need be, the last row filled up
            width = WIDTH * -(-len(payloads[k]) // (row * MAX_SIDE))
            whole = payloads[k] + bytes(-len(payloads[k]) % (4 * width))
            out.append(wrap(_encode_batch([whole], width)[0], len(payloads[k])))
            k += 1
            continue
        stop, size = k, 0
        while stop < len(payloads) and size < BATCH_BYTES and len(payloads[stop]) <= row * MAX_SIDE:
            size += len(payloads[stop])
            stop += 1
        out += map(wrap, _encode_batch(payloads[k:stop], WIDTH))
        k = stop
    return out


def decode_payloads(media: list[bytes]) -> list[bytes]:
    """What encode_payloads() stored, read back from the images."""
    out = []
    for m in media:
        found = chunks(m)
        samples = decode_bits(found[b"VP8L"]).tobytes()
        out.append(samples[: struct.unpack("<Q", found[LENGTH_CHUNK])[0]] if LENGTH_CHUNK in found else samples)
    return out


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and them with zeros up to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + b"\0" * (-len(data) % 64 or (0 if data else 64))


def feature(pixels: bytes) -> str:
    """Rows, distinct samples, mean, entropy in bits and the mean step between neighbours in a row."""
    x = np.frombuffer(pixels, np.uint8)
    n = np.bincount(x, minlength=256)
    p = n[n > 0] / len(x)
    step = np.abs(np.diff(x.reshape(-1, 4 * WIDTH).astype(np.int16), axis=1)).mean()
    return f"rows={len(x) // (4 * WIDTH)} distinct={len(p)} mean={x.mean():.4f} entropy={abs(-(p * np.log2(p)).sum()):.4f} step={step:.4f}"


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, media binary: the text's payload as lossless WebP. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            media = encode_payloads([payload_of(t)[1] for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(media, pa.binary())], names=[id_col, "media"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, media binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text's payload as media, read the stored bytes back, and describe both. Narrow."""
    fields = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for at in range(0, batch.num_rows, SLICE_ROWS):
                b = batch.slice(at, SLICE_ROWS)
                sized = [payload_of(t) for t in b.column(1).to_pylist()]
                media = encode_payloads([p for _, p in sized])
                back = decode_payloads(media)
                columns = [
                    pa.array([n for n, _ in sized], pa.int64()),
                    pa.array([len(p) for p in back], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in back]),
                    pa.array([zlib.crc32(p[-64:]) for p in back], pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                    pa.array([feature(p) for p in back]),
                ]
                yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=[id_col, *(f.split()[0] for f in fields.split(", "))])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {fields}")
