"""Byte-pair encoding and decoding in batched numpy merge rounds.

A chunk of documents is cut into pre-tokens by array rules (the usual byte-level
pattern: contractions, letters, numbers, other signs, white space). Distinct
pre-tokens that a worker has not met are encoded together: their symbols lie in one
flat array, each round looks up all neighbouring pairs by binary search over sorted
pair keys, takes every word's lowest rank and merges all its occurrences, until no
pair is left. A chunk's pre-tokens are told apart by hash, then compared with the first of
their hash code point by code point, and so are those that a bounded cache holds from earlier
chunks. So no hash decides an id.

Defined results: a null text is an empty one (no ids, empty decoded text). Every input
row gives one output row, repeated rows included. Extra columns are ignored. The
special token's string becomes its id, as the tokenizer file declares it.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm.batches import lean
from folio.llm.textnum import byte_hashes, chunked, expand, numbered, unlike

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The contractions of the byte-level pattern, after the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Unicode white space, as the pattern's \\s takes it.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Pre-tokens that a worker keeps; beyond it the cache starts afresh, which changes nothing but speed.
CACHE_WORDS = 400_000
_NO_RANK = np.int64(1 << 40)


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kinds[c] = LETTER
        elif k == "N":
            kinds[c] = NUMBER
    kinds[list(WHITE)] = SPACE
    return kinds


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable, else the next code point from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _extended(x: np.ndarray, filled: int, more: np.ndarray) -> tuple[np.ndarray, int]:
    """x with `more` from place `filled` on, in a longer array if need be."""
    if filled + len(more) > len(x):
        x = np.concatenate((x[:filled], np.zeros(max(len(x), len(more)), x.dtype)))
    x[filled : filled + len(more)] = more
    return x, filled + len(more)


class ByteBPE:
    """A byte-level BPE tokenizer read from a tokenizer file's vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        signs = byte_alphabet()
        size = max([*vocab.values(), *self.special.values()]) + 1
        table = [b""] * size
        for token, i in vocab.items():
            table[i] = bytes(signs[c] for c in token)
        for token, i in self.special.items():
            table[i] = token.encode()
        self.table = table
        self.token_len = np.array([len(t) for t in table], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)
        self.byte_id = np.zeros(256, np.int64)
        for token, i in vocab.items():
            if len(token) == 1:
                self.byte_id[signs[token]] = i
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.size, self.pair_keys, self.pair_rank = size, keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.kinds = _classes()
        self._reset()

    def _reset(self) -> None:
        # pre-tokens by hash; their ids and code points lie in flat arrays
        self.known: dict[int, int] = {}
        self.word_at, self.word_n, self.cp_at, self.cp_n = (np.zeros(0, np.int64) for _ in range(4))
        self.ids, self.filled, self.cps, self.cp_filled = np.zeros(1 << 16, np.int32), 0, np.zeros(1 << 16, np.uint32), 0

    def _ranks(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the places `at`; a pair across words has none."""
        out = np.full(len(at), _NO_RANK)
        k = np.flatnonzero(at + 1 < len(sym))
        k = k[word[at[k]] == word[at[k] + 1]]
        key = sym[at[k]] * self.size + sym[at[k] + 1]
        found = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        out[k] = np.where(self.pair_keys[found] == key, self.pair_rank[found], _NO_RANK)
        return out

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words, one after the other, and how many each has. Words are not empty."""
        sizes = np.array([len(w) for w in words], np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_sym, done_word = [], []
        rank = self._ranks(sym, word, np.arange(len(sym)))
        while len(sym):
            head = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, head)
            count = np.diff(np.append(head, len(sym)))
            least = np.repeat(best, count)
            idle = least == _NO_RANK
            if idle.any():
                done_sym.append(sym[idle])
                done_word.append(word[idle])
                live = ~idle
                sym, word, rank, least = sym[live], word[live], rank[live], least[live]
                if not len(sym):
                    break
            hit = rank == least
            # of overlapping hits (a a a) take every other one, from the left
            run = hit.copy()
            run[1:] &= ~hit[:-1]
            opens = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit &= (np.arange(len(hit)) - opens) % 2 == 0
            sym = np.where(hit, self.merged[np.where(hit, rank, 0)], sym)
            keep = np.ones(len(sym), bool)
            keep[1:] = ~hit[:-1]
            sym, word, rank, fresh = sym[keep], word[keep], rank[keep], hit[keep]
            # only pairs with a merged symbol are new
            fresh[:-1] |= fresh[1:]
            at = np.flatnonzero(fresh)
            rank[at] = self._ranks(sym, word, at)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def cut(self, cp: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in the code points of several texts; doc_start marks each text's first."""
        kind = self.kinds[cp]
        n = len(cp)
        begins = np.ones(n, bool)
        begins[1:] = (kind[1:] != kind[:-1]) | doc_start[1:]
        white = kind == SPACE
        after_blank = np.zeros(n, bool)
        after_blank[1:] = (cp[:-1] == 0x20) & ~doc_start[1:]
        out = begins & (white | ~after_blank)
        # the last of several spaces stands apart if text follows
        out[:-1] |= white[:-1] & ~white[1:] & ~doc_start[1:]
        quote = np.flatnonzero((cp == 0x27) & begins & ~after_blank)
        if len(quote):
            padded = np.concatenate((cp, np.zeros(3, cp.dtype)))
            stops = np.concatenate((doc_start, np.ones(3, bool)))
            for tail in CONTRACTIONS:
                at, k = quote, len(tail)
                for j, ch in enumerate(tail, 1):
                    at = at[(padded[at + j] == ord(ch)) & ~stops[at + j]]
                out[at + 1] = False
                after = at + k + 1
                out[after[after < n]] = True
        return np.flatnonzero(out)

    @staticmethod
    def distinct(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Numbers of the first of each distinct pre-token, for each pre-token the place of its own among them, and keys of the former."""
        width = 1 if (top := cp.max()) < 1 << 8 else 2 if top < 1 << 16 else 4
        hashes = byte_hashes(cp.astype(f"<u{width}").tobytes(), start * width, end * width, width)
        keys, first, which = numbered(hashes, cp, start, end)
        # one that differs from the first of its hash has a key that no hash has
        return first, which, keys.tolist() + [-1] * (len(first) - len(keys))

    def encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of the texts, one after the other, and how many each has; no special tokens inside."""
        sizes = np.array([len(t) for t in texts], np.int64)
        whole = "".join(texts)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        opens = np.cumsum(sizes) - sizes
        doc_start = np.zeros(len(cp), bool)
        doc_start[opens[sizes > 0]] = True
        start = self.cut(cp, doc_start)
        end = np.append(start[1:], len(cp))
        first, which, keys = self.distinct(cp, start, end)
        if len(self.word_n) + len(keys) > CACHE_WORDS:
            self._reset()
        slot = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        met = np.flatnonzero(slot >= 0)
        begin = self.cp_at[slot[met]]
        slot[met[unlike(cp, start[first[met]], end[first[met]], self.cps, begin, begin + self.cp_n[slot[met]])]] = -1
        new = np.flatnonzero(slot < 0)
        if len(new):
            a, b = start[first[new]], end[first[new]]
            ids, count = self.merge_words([whole[x:y].encode("utf-8", "surrogatepass") for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            base = len(self.word_n)
            self.word_at, self.word_n = np.append(self.word_at, self.filled + np.cumsum(count) - count), np.append(self.word_n, count)
            self.cp_at, self.cp_n = np.append(self.cp_at, self.cp_filled + np.cumsum(b - a) - (b - a)), np.append(self.cp_n, b - a)
            self.ids, self.filled = _extended(self.ids, self.filled, ids)
            self.cps, self.cp_filled = _extended(self.cps, self.cp_filled, cp[expand(a, b - a)])
            slot[new] = base + np.arange(len(new))
            self.known |= {keys[i]: base + j for j, i in enumerate(new.tolist()) if keys[i] >= 0}
        word = slot[which]
        count = self.word_n[word]
        ids = self.ids[expand(self.word_at[word], count)]
        sums = np.concatenate(([0], np.cumsum(count)))
        cuts = np.searchsorted(start, np.append(opens, len(cp)))
        return ids, np.diff(sums[cuts])

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for _, run in chunked(texts):
            parts, owner, marks = [], [], []
            for i, t in enumerate(run):
                pieces = [(t, None)]
                for token, number in self.special.items():
                    if token in t:
                        pieces = [(p, number if j < len(ps) - 1 else m) for s, m in pieces for ps in (s.split(token),) for j, p in enumerate(ps)]
                for p, m in pieces:
                    parts.append(p)
                    owner.append(i)
                    marks.append(m)
            ids, counts = self.encode_chunk(parts)
            stops = np.cumsum(counts)
            if len(parts) == len(run):
                yield from np.split(ids, stops[:-1])
                continue
            got: list[list[np.ndarray]] = [[] for _ in run]
            for piece, i, m in zip(np.split(ids, stops[:-1]), owner, marks, strict=True):
                got[i].append(piece)
                if m is not None:
                    got[i].append(np.array([m], np.int32))
            yield from (np.concatenate(g) for g in got)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        ids = ids.astype(np.int64)
        return self.token_bytes[expand(self.token_at[ids], self.token_len[ids])].tobytes().decode("utf-8", "replace")


_loaded: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """The tokenizer of a file, once for each worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text: id, ids array<int>, decoded string. Narrow: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in lean(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            at = 0
            for _, part in chunked(texts, 4 << 20):  # so that ids of long batches don't pile up
                ids = list(bpe.encode_batch(part))
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                stops = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(stops), pa.array(flat)), pa.array([bpe.decode(x) for x in ids], pa.string())],
                    names=[id_col, "ids", "decoded"],
                )
                at += len(part)

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode_decode() with the digests of its outputs in place of them, taken in the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in lean(batches):
            n, a, d = [], [], []
            for ids in bpe.encode_batch([t or "" for t in b.column(1).to_pylist()]):
                n.append(len(ids))
                a.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                d.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
