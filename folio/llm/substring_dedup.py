"""Substring dedup: words in passages of `window` words that recur anywhere are removed.

1. Every window has an anchor, the least of its phrases of PHRASE words (by hash, the
   first one if equal). Equal windows have equal anchors at equal places, so only windows
   whose anchor phrase recurs can recur. Anchors are counted over all documents.
2. Consecutive windows with one anchor make a block. Blocks whose anchor recurs are
   collapsed to distinct ones (by 128 bits) with a count.
3. Distinct blocks are dealt to shards by anchor, so windows that can be equal meet. A
   shard numbers its words exactly, compiles the windows that recur to an Aho-Corasick
   automaton with a character for each word, and streams its blocks through it. A window
   counts as often as the automaton finds its words: once is not enough.
4. Blocks of an anchor with over HEAVY_BLOCKS of them are dealt by window instead. Windows
   of one hash are compared with one of them, which goes to as many shards as these fill;
   what has other words than that one is grouped by its words.
5. Occurrences go back to each document that holds the block, and its covered words go.

Whole texts are read; nothing is capped.

Defined results: a null text has no words: n_words 0 and the digest of the empty text.
Rows that repeat an id and text are copies of each other, so their windows recur. Texts
shorter than a window stay whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.batches import lean, release
from folio.llm.shared import bit_filter, drop, passes, stored
from folio.llm.textnum import U64, Words, chunked, expand, mix, numbered, span_hashes

PHRASE = 8
#: Distinct blocks of a shard, about: bounds an automaton. Windows of a shard of windows.
SHARD_BLOCKS, SHARD_WINDOWS = 300, 5000
#: Blocks of an anchor that go to one shard, at most, and windows of one hash.
HEAVY_BLOCKS = 150


class Blocks:
    """The blocks of a run of texts: document, window starts first .. last (word numbers in the run), anchor hash, two block hashes."""

    def __init__(self, words: Words, window: int):
        self.words, self.window = words, window
        n = len(words.hash)
        phrase = min(PHRASE, window)
        doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        start = np.flatnonzero(np.arange(n) + window <= words.first[1:][doc]) if n >= window else np.zeros(0, np.int64)
        if not len(start):
            self.doc = self.first = self.last = np.zeros(0, np.int64)
            self.anchor = self.b1 = self.b2 = np.zeros(0, U64)
            return
        at = np.arange(n - phrase + 1)
        grams = span_hashes(words.hash, at, at + phrase)
        # least phrase of `reach` ones from each place, by doubling
        best, size, reach = at, 1, window - phrase + 1
        while size * 2 <= reach:
            a, b = best[:-size], best[size:]
            best, size = np.where(grams[a] <= grams[b], a, b), size * 2
        a, b = best[start], best[start + reach - size]
        least = np.where(grams[a] <= grams[b], a, b)
        opens = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (doc[start[1:]] != doc[start[:-1]]))))
        self.first = start[opens]
        self.last = start[np.append(opens[1:], len(start)) - 1]
        self.doc = doc[self.first]
        self.anchor = grams[least[opens]]
        # the anchor's place is part of the block
        place = mix(self.anchor + (least[opens] - self.first).astype(U64))
        self.b1, self.b2 = (mix(span_hashes(h, self.first, self.last + window) + place) for h in (words.hash, words.other))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and a 128-bit key of both."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select("*", F.xxhash64("id", "text").alias("r1"), F.xxhash64("text", F.lit(1), "id").alias("r2"))


def _scan(rows: DataFrame, window: int, schema: str, emit: Callable[[Blocks, np.ndarray, np.ndarray], pa.RecordBatch | None]) -> DataFrame:
    """emit()'s rows for the blocks of all texts; it gets the blocks and the keys of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            r1, r2 = b.column(1).to_numpy(), b.column(2).to_numpy()
            for at, texts in chunked(b.column(0).to_pylist()):
                found = Blocks(Words(texts), window)
                if len(found.doc):
                    out = emit(found, r1[at + found.doc], r2[at + found.doc])
                    if out is not None:
                        yield out

    return rows.select("text", "r1", "r2").mapInArrow(run, schema)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def spelled(segments: list[bytes]) -> tuple[Words, str]:
    """The words of the segments, and a string with a character for each word: equal words, and no others, have equal ones."""
    words = Words(segments)
    _, _, number = numbered(words.hash, words.buf, words.start, words.end)
    code = number.astype(np.uint32) + 1
    code[code >= 0xD800] += 0x800  # no surrogates
    return words, code.astype("<u4").tobytes().decode("utf-32-le")


def compiled(patterns: Iterable[str]) -> ahocorasick.Automaton:
    """An automaton that tells the number of each pattern that it finds."""
    automaton = ahocorasick.Automaton()
    for k, p in enumerate(patterns):
        automaton.add_word(p, k)
    automaton.make_automaton()
    return automaton


def locate(segments: list[bytes], times: np.ndarray, window: int) -> list[list[int]]:
    """For each segment the places where a run of `window` words starts that the segments hold more than once; segment i stands for times[i]."""
    words, text = spelled(segments)
    count = np.maximum(0, np.diff(words.first) - window + 1)
    start = expand(words.first[:-1], count)
    owner = np.repeat(np.arange(len(segments)), count)
    _, which = np.unique(span_hashes(words.hash, start, start + window), return_inverse=True)
    often = np.flatnonzero((np.bincount(which, weights=times[owner]) > 1)[which])
    out: list[list[int]] = [[] for _ in segments]
    if not len(often):
        return out
    # told apart by their words, whatever their hashes
    automaton = compiled(dict.fromkeys([text[s : s + window] for s in start[often].tolist()]))
    found = []
    for i in np.unique(owner[often]).tolist():
        base = int(words.first[i])
        found += [(i, end + 1 - window, k) for end, k in automaton.iter(text[base : int(words.first[i + 1])])]
    i, at, k = np.array(found, np.int64).T
    # what recurs by words, not by hash
    sure = np.bincount(k, weights=times[i])[k] > 1
    for x, y in zip(i[sure].tolist(), at[sure].tolist(), strict=True):
        out[x].append(y)
    return out


def _merge(starts: list[int], window: int) -> list[int]:
    """[from, to, from, to, ...] of the words that the windows cover."""
    out: list[int] = []
    for s in starts:
        if out and s <= out[-1]:
            out[-1] = max(out[-1], s + window)
        else:
            out += [s, s + window]
    return out


BLOCK_ID = ["b1", "b2"]


def recurring(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(r1, r2, spans): for each document key with recurring windows, its covered word ranges, flat [from, to, ...], in any order."""
    rows = _rows(docs, id_col, text_col)
    sc = docs.sparkSession.sparkContext

    anchors = _scan(rows, window, "a long", lambda x, *_: pa.RecordBatch.from_arrays([_long(x.anchor)], names=["a"]))
    hot = sc.broadcast(bit_filter(anchors.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "a"))

    def emit_places(x: Blocks, r1: np.ndarray, r2: np.ndarray) -> pa.RecordBatch | None:
        k = np.flatnonzero(passes(hot.value, x.anchor))
        if not len(k):
            return None
        # a row for each distinct block of a document
        k = k[np.lexsort((x.first[k], x.b2[k], x.b1[k], x.doc[k]))]
        new = np.ones(len(k), bool)
        new[1:] = (x.doc[k[1:]] != x.doc[k[:-1]]) | (x.b1[k[1:]] != x.b1[k[:-1]]) | (x.b2[k[1:]] != x.b2[k[:-1]])
        stops = np.append(np.flatnonzero(new), len(k)).astype(np.int32)
        s = pa.ListArray.from_arrays(pa.array(stops), pa.array((x.first - x.words.first[x.doc])[k], pa.int32()))
        k = k[new]
        return pa.RecordBatch.from_arrays([_long(x.anchor[k]), _long(x.b1[k]), _long(x.b2[k]), _long(r1[k]), _long(r2[k]), s], names=["a", *BLOCK_ID, "r1", "r2", "s"])

    places = stored(_scan(rows, window, "a long, b1 long, b2 long, r1 long, r2 long, s array<int>", emit_places), "places")
    distinct = stored(places.groupBy(*BLOCK_ID).agg(F.min("a").alias("a"), F.sum(F.size("s")).alias("n"), F.min("r1").alias("r1")), "distinct")
    wanted = sc.broadcast(bit_filter(distinct.select(F.col("r1").bitwiseXOR(F.col("b1")).alias("k")), "k"))

    def emit_blocks(x: Blocks, r1: np.ndarray, r2: np.ndarray) -> pa.RecordBatch | None:
        k = np.flatnonzero(passes(hot.value, x.anchor) & passes(wanted.value, r1 ^ x.b1.view(np.int64)))
        k = k[np.unique(np.stack([r1[k].view(U64), x.b1[k], x.b2[k]]), axis=1, return_index=True)[1]] if len(k) else k
        if not len(k):
            return None
        texts = [b" ".join(_split(x.words, i, j)) for i, j in zip(x.first[k].tolist(), (x.last[k] + window).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([_long(x.b1[k]), _long(x.b2[k]), _long(r1[k]), pa.array(texts, pa.binary())], names=[*BLOCK_ID, "r1", "seg"])

    cut = _scan(rows, window, "b1 long, b2 long, r1 long, seg binary", emit_blocks)
    # equal rows give equal blocks: any one will do
    full = stored(cut.join(distinct, [*BLOCK_ID, "r1"]).dropDuplicates([*BLOCK_ID, "r1"]).select("a", *BLOCK_ID, "n", "seg"), "blocks")
    drop(distinct)
    hot.destroy()
    wanted.destroy()

    many = stored(full.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > HEAVY_BLOCKS).select("a"), "many")
    shards = max(1, -(-full.count() // SHARD_BLOCKS))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        found = locate(pdf.seg.tolist(), pdf.n.to_numpy(), window)
        some = [i for i, x in enumerate(found) if x]
        return pdf[BLOCK_ID].iloc[some].assign(spans=pd.Series([_merge(found[i], window) for i in some], index=pdf.index[some], dtype=object))

    light = full.join(many, "a", "left_anti").withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards)))
    marks = light.groupBy("shard").applyInPandas(match, "b1 long, b2 long, spans array<int>")
    if not many.isEmpty():
        marks = marks.unionByName(_by_window(full.join(many, "a", "left_semi"), window))
    marks = stored(marks, "marks")
    drop(full, many)
    spans = places.join(marks, BLOCK_ID)
    shifted = F.flatten(F.transform("s", lambda s: F.transform("spans", lambda x: x + s)))
    # a set: rows that repeat an id and a text add nothing, and are combined before the shuffle
    return spans.groupBy("r1", "r2").agg(F.flatten(F.collect_set(shifted)).alias("spans"))


def _by_window(blocks: DataFrame, window: int) -> DataFrame:
    """(b1, b2, spans) of blocks (b1, b2, n, seg) whose anchors have very many: dealt by window, the windows of one hash to several tasks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                words = Words(part.column(3).to_pylist())
                count = np.diff(words.first) - window + 1
                start = expand(words.first[:-1], count)
                owner = np.repeat(np.arange(part.num_rows), count)
                # segments hold one blank between words
                texts = [words.raw[x:y] for x, y in zip(words.start[start].tolist(), words.end[start + window - 1].tolist(), strict=True)]
                of = pa.array(owner, pa.int64())
                pos = start - words.first[owner]
                yield pa.RecordBatch.from_arrays(
                    [_long(span_hashes(words.hash, start, start + window)), part.column(0).take(of), part.column(1).take(of), pa.array(pos, pa.int32()), part.column(2).take(of), pa.array(texts, pa.binary())],
                    names=["w", *BLOCK_ID, "pos", "n", "text"],
                )

    windows = blocks.select(*BLOCK_ID, "n", "seg").mapInArrow(cut, "w long, b1 long, b2 long, pos int, n long, text binary")
    windows = stored(windows, "windows")
    place = F.struct(*BLOCK_ID, "pos")
    often = windows.groupBy("w").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("m"), F.min(place).alias("one")).where("all > 1")
    often = stored(often.select("w", "one", F.ceil(F.col("m") / HEAVY_BLOCKS).alias("parts")), "often")
    both = windows.join(often, "w").withColumn("given", place == F.col("one"))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    both = both.withColumn("part", F.explode(F.when(F.col("given"), every).otherwise(F.array(F.pmod(F.xxhash64(*BLOCK_ID, "pos"), F.col("parts"))))))
    shards = max(1, -(-windows.count() // SHARD_WINDOWS))
    dealt = both.select(*BLOCK_ID, "pos", "n", "text", "given", F.pmod(F.xxhash64("w", "part"), F.lit(shards)).alias("shard"))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        """Windows that recur, without text; those with other words than the given one of their hash, with it."""
        pdf = pdf.reset_index(drop=True)
        _, text = spelled(pdf.text.tolist())
        runs = [text[i : i + window] for i in range(0, len(text), window)]
        given = np.flatnonzero(pdf.given)
        automaton = compiled([runs[i] for i in given.tolist()])
        sure = pdf.n.to_numpy() > 1
        other = np.zeros(len(pdf), bool)
        for i in np.flatnonzero(~pdf.given).tolist():
            k = next((k for _, k in automaton.iter(runs[i])), -1)
            if k < 0:
                other[i] = True
            else:
                sure[[i, given[k]]] = True
        keep = sure | other
        return pdf[keep].assign(text=pdf.text.where(other & ~sure, None)[keep])[[*BLOCK_ID, "pos", "n", "text"]]

    found = stored(dealt.groupBy("shard").applyInPandas(match, "b1 long, b2 long, pos int, n long, text binary"), "found")
    drop(windows, often)
    sure = found.where("text is null").select(*BLOCK_ID, "pos")
    rest = found.where("text is not null").groupBy("text").agg(F.collect_set(place).alias("at")).where(F.size("at") > 1).select(F.explode("at").alias("at")).select("at.*")
    ends = F.flatten(F.transform(F.sort_array(F.collect_set("pos")), lambda p: F.array(p, p + window)))
    return sure.unionByName(rest).groupBy(*BLOCK_ID).agg(ends.alias("spans"))


def _split(words: Words, i: int, j: int) -> list[bytes]:
    return [words.raw[a:b] for a, b in zip(words.start[i:j].tolist(), words.end[i:j].tolist(), strict=True)]


def remove_recurring(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """id, n_words, n_removed and the kept words joined by blanks: kept_text, or with digest its kept_sha256."""
    rows = _rows(docs, id_col, text_col)
    spans = recurring(docs, window, id_col, text_col)
    last = "kept_sha256" if digest else "kept_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            for at, texts in chunked(b.column(1).to_pylist()):
                part = b.slice(at, len(texts))
                n, removed, joined = _without(texts, part.column(2).to_pylist())
                out = [hashlib.sha256(x).hexdigest() for x in joined] if digest else [x.decode("utf-8", "surrogatepass") for x in joined]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())], names=[id_col, "n_words", "n_removed", last])

    kind = dict(docs.dtypes)[id_col]
    return rows.join(spans, ["r1", "r2"], "left").select("id", "text", "spans").mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_removed long, {last} string")


def _without(texts: list[str], spans: list[list[int] | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For each text: words, removed words, and the kept words joined by blanks."""
    words = Words(texts)
    covered = np.zeros(len(words.hash) + 1, np.int64)
    for i, s in enumerate(spans):
        if s:
            x = np.array(s, np.int64) + words.first[i]
            np.add.at(covered, x[0::2], 1)
            np.add.at(covered, x[1::2], -1)
    gone = np.cumsum(covered[:-1]) > 0
    n = np.diff(words.first)
    kept_to = np.concatenate(([0], np.cumsum(~gone)))[words.first]
    kept = np.flatnonzero(~gone)
    pieces = [words.raw[x:y] for x, y in zip(words.start[kept].tolist(), words.end[kept].tolist(), strict=True)]
    joined = [b" ".join(pieces[x:y]) for x, y in zip(kept_to[:-1].tolist(), kept_to[1:].tolist(), strict=True)]
    return n, n - np.diff(kept_to), joined


def rewrite(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """docs with recurring passages taken out of their texts, all columns kept; size_col, if there, is the new text's length.

    Texts without recurring passages stay as they are, white space included.
    """
    spans = recurring(docs, window, id_col, text_col).withColumnRenamed("spans", "_spans")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"_r1": F.xxhash64(F.col(id_col), text), "_r2": F.xxhash64(text, F.lit(1), F.col(id_col))})
    joined = keyed.join(spans, (keyed["_r1"] == spans["r1"]) & (keyed["_r2"] == spans["r2"]), "left").select(*docs.columns, "_spans")
    at_text, at_size = docs.columns.index(text_col), docs.columns.index(size_col) if size_col in docs.columns else -1
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            texts, found = b.column(at_text).to_pylist(), b.column(len(names)).to_pylist()
            some = [i for i, s in enumerate(found) if s]
            for at, part in chunked([texts[i] for i in some]):
                which = some[at : at + len(part)]
                for i, x in zip(which, _without(part, [found[i] for i in which])[2], strict=True):
                    texts[i] = x.decode("utf-8", "surrogatepass")
            columns = list(b.columns[: len(names)])
            columns[at_text] = pa.array(texts, pa.string())
            if at_size >= 0:
                columns[at_size] = pa.array([None if t is None else len(t) for t in texts], columns[at_size].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
