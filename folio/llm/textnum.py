"""Vectorised text primitives shared by the corpus operators (plain numpy, no Spark).

Texts are handled as one flat array per chunk of documents, so every step is a
handful of array passes instead of a Python loop over words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)

#: Characters of one chunk; bounds the temporary arrays of a Python worker.
CHUNK_CHARS = 1 << 20
#: Slices of more bytes are hashed one by one; shorter ones together, eight bytes at a time.
LANE_BYTES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two things after one another. Not linear in either, so sums and products of hashes have no say."""
    return mix(mix(a + _MULT) + b)


def byte_hashes(data: bytes, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the slices data[start:end] of a byte string; another seed gives independent ones."""
    size = (end - start).astype(np.int64)
    out = mix(size.astype(U64) + U64(seed * int(_MULT) % 2**64))
    lanes = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    live = np.flatnonzero(size > 0)
    long = live[size[live] > LANE_BYTES]
    if len(long):
        salt = seed.to_bytes(8, "little")
        out[long] = [int.from_bytes(hashlib.blake2b(data[a:b], digest_size=8, salt=salt).digest(), "little") for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
        live = live[size[live] <= LANE_BYTES]
    at, left, h = start[live], size[live], out[live]
    while len(live):
        lane = lanes[at]
        short = left < 8
        lane[short] &= (U64(1) << (left[short] * 8).astype(U64)) - U64(1)
        h = _join(h, lane)
        over = left <= 8
        out[live[over]] = h[over]
        more = ~over
        live, at, left, h = live[more], at[more] + 8, left[more] - 8, h[more]
    return out


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices values[start:end] of 64-bit numbers: halves joined pairwise, so steps grow with the logarithm of the longest slice."""
    size = (end - start).astype(np.int64)
    out = mix(size.astype(U64) + U64(0x2545F491))
    level, at, width = mix(values.astype(U64) ^ _MULT), start.astype(np.int64), 1
    longest = int(size.max(initial=0))
    while width <= longest:
        some = np.flatnonzero(size & width)
        out[some] = _join(out[some], level[at[some]])
        at[some] += width
        level, width = _join(level[:-width], level[width:]), width * 2
    return out


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The concatenation of start[i] .. start[i]+count[i]-1."""
    total = int(count.sum())
    out = np.arange(total, dtype=np.int64)
    shift = np.cumsum(count) - count
    return out + np.repeat(start - shift, count)


def unlike(x: np.ndarray, x0: np.ndarray, x1: np.ndarray, y: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Numbers of the slices x[x0:x1] that differ from y[y0:y1]."""
    size = x1 - x0
    differ = size != y1 - y0
    at = np.flatnonzero(~differ)
    found = x[expand(x0[at], size[at])] != y[expand(y0[at], size[at])]
    if found.any():
        differ[np.repeat(at, size[at])[found]] = True
    return np.flatnonzero(differ)


def numbered(hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct slices data[start:end]: sorted distinct hashes, the first slice of each, and for each slice its number among the first ones.

    Slices are compared with the first of their hash, not taken as equal; one that differs gets a number of its own after those of the hashes.
    """
    keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[which]
    at = np.flatnonzero(like != np.arange(len(like)))
    for i in at[unlike(data, start[at], end[at], data, start[like[at]], end[like[at]])].tolist():
        which[i] = len(first)
        first = np.append(first, i)
    return keys, first, which


def chunked(texts: Iterable[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) in runs of about `limit` characters; a longer text is a run of its own."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        if run and size + len(t) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


#: The seven bytes that separate words: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of a run of texts: byte offsets into one UTF-8 buffer, and 64-bit hashes.

    first[d] .. first[d + 1] are the words of text d.
    """

    def __init__(self, texts: list[str] | list[bytes], lower: bool = False):
        blobs = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b"\n".join(blobs) + b"\n"
        buf = np.frombuffer(self.raw, np.uint8)
        if lower:
            buf = _LOWER[buf]
            self.raw = buf.tobytes()
        gap = _SPACE[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.buf = buf
        stops = np.cumsum([len(b) + 1 for b in blobs])
        self.first = np.concatenate(([0], np.searchsorted(self.start, stops)))
        self.hash = byte_hashes(self.raw, self.start, self.end)

    @cached_property
    def other(self) -> np.ndarray:
        """A second hash of each word, for keys of 128 bits."""
        return byte_hashes(self.raw, self.start, self.end, 1)

    def text(self, i: int, j: int) -> bytes:
        """Words i .. j - 1 as they stand, with what separates them."""
        return self.raw[self.start[i] : self.end[j - 1]] if j > i else b""
