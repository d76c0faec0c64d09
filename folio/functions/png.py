"""PNG images as arrays: read, write, and made smaller by box averages. Plain numpy, for use in tasks."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Channels of a pixel by colour type.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def unfiltered(data: bytes, stride: int, pixel: int) -> np.ndarray:
    """Rows of `stride` bytes from rows with a filter byte before each; pixel: bytes of a pixel, one at least."""
    rows = len(data) // (stride + 1)
    given = np.frombuffer(data, np.uint8, rows * (stride + 1)).reshape(rows, stride + 1)
    out = np.zeros((rows + 1, stride), np.uint8)
    for y in range(rows):
        kind, row, above = given[y, 0], given[y, 1:], out[y]
        if kind == 0:
            out[y + 1] = row
        elif kind == 1:
            whole = np.zeros(-(-stride // pixel) * pixel, np.uint8)
            whole[:stride] = row
            out[y + 1] = np.cumsum(whole.reshape(-1, pixel), axis=0, dtype=np.uint8).ravel()[:stride]
        elif kind == 2:
            out[y + 1] = row + above
        else:
            out[y + 1] = _mixed(kind, row.tolist(), above.tolist(), pixel)
    return out[1:]


def _mixed(kind: int, row: list[int], above: list[int], pixel: int) -> list[int]:
    """A row whose bytes depend on those to the left and above together."""
    out = [0] * pixel
    corner = [0] * pixel + above
    for i, x in enumerate(row):
        left, up, diagonal = out[i], above[i], corner[i]
        if kind == 3:
            out.append((x + (left + up) // 2) & 255)
            continue
        near = left + up - diagonal
        a, b, c = abs(near - left), abs(near - up), abs(near - diagonal)
        out.append((x + (left if a <= b and a <= c else up if b <= c else diagonal)) & 255)
    return out[pixel:]


def samples(rows: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Rows of bytes as rows of `count` samples of 1, 2, 4, 8 or 16 bits; of 16 the upper eight."""
    if bits == 8:
        return rows[:, :count]
    if bits == 16:
        return rows[:, : 2 * count : 2]
    one = np.unpackbits(rows, axis=1).reshape(len(rows), -1, bits)
    return (one * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2).astype(np.uint8)[:, :count]


def write(pixels: np.ndarray) -> bytes:
    """An array (height, width, 1 to 4) of bytes as PNG; each row is filtered by whichever of three filters leaves the smallest numbers."""
    height, width, channels = pixels.shape
    flat = pixels.reshape(height, -1)
    left = np.zeros_like(flat)
    left[:, channels:] = flat[:, :-channels]
    above = np.zeros_like(flat)
    above[1:] = flat[:-1]
    ways = np.stack((flat, flat - left, flat - above))
    best = np.abs(ways.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    rows = np.concatenate((best[:, None].astype(np.uint8), ways[best, np.arange(height)]), axis=1)
    kind = {1: 0, 2: 4, 3: 2, 4: 6}[channels]

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def read(data: bytes) -> np.ndarray | None:
    """The pixels (height, width, channels) of a PNG without interlacing, palettes resolved; None for anything else."""
    if not data.startswith(SIGNATURE):
        return None
    at, body, palette = len(SIGNATURE), b"", None
    head = None
    while at + 8 <= len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        at += size + 12
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body += part
    if head is None or head[6] or head[3] not in CHANNELS:
        return None
    width, height, bits, kind = head[:4]
    channels = CHANNELS[kind]
    rows = unfiltered(zlib.decompress(body), -(-width * channels * bits // 8), max(1, channels * bits // 8))[:height]
    out = samples(rows, bits, width * channels).reshape(height, width, channels)
    if palette is not None and kind == 3:
        return palette[out[:, :, 0]]
    return out * np.uint8(255 // ((1 << bits) - 1)) if bits < 8 else out


def smaller(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Box averages: each new pixel is the mean of what it covers, pixels at its borders by their share."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        sums = np.concatenate((np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)))
        edge = np.linspace(0, len(x), n + 1)
        whole = np.minimum(edge.astype(int), len(x) - 1)
        at = sums[whole] + (edge - whole).reshape(-1, *[1] * (x.ndim - 1)) * x[whole]
        return np.diff(at, axis=0) * (n / len(x))

    rows = along(pixels.astype(np.float64), height)
    return np.clip(np.rint(along(rows.transpose(1, 0, 2), width).transpose(1, 0, 2)), 0, 255).astype(np.uint8)


def thumbnail(data: bytes, max_width: int) -> bytes | None:
    """A PNG no wider than max_width with its proportions kept; one that is narrow enough stays as it is, and what is no readable PNG is None."""
    pixels = read(data)
    if pixels is None:
        return None
    height, width = pixels.shape[:2]
    if width <= max_width:
        return data
    return write(smaller(pixels, max_width, max(1, round(height * max_width / width))))
