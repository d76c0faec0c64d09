"""Ranked lexical search over dual-sorted wavelet trees, one for each shard of documents.

A shard holds the postings of all terms of up to SHARD_DOCS documents. A term's postings stand by falling impact (what an
occurrence adds to a score, but for the term's weight); their document numbers are kept as a wavelet tree, level by level,
so that the same list can be walked in the order of documents: a level sends postings by one bit of the number to the left or
right half and keeps their order, hence in each node a term's postings are one run whose first has the
greatest impact. The lowest nodes are blocks of BLOCK_DOCS documents.

A search holds, for each item, the nodes that may still have results, each with the runs of the item's
terms and a bound: the sum of weight times first impact. The nodes with the greatest bounds are opened first, a few for
each item at a time, so that one array operation serves all items. Runs go to the node's halves by rank, a
block's postings are summed by document, and nodes whose bounds fall below an item's k-th score are dropped. Bounds
are exact integers and ties stay open, so the top k are exact. A task keeps its best from shard to shard.

Documents are not shuffled: shards are cut where they are read. Items are taken in blocks of bounded size, each sent to
all shards; a task gives at most k rows for each item, which are ranked within random parts of an item first and
then for the item.

Terms are the runs of letters, digits and all that is not ASCII, A to Z lower-cased. Their bytes are compared, not only hashes.

Defined results: documents without terms are no documents here; an item without terms, or none of whose terms occurs, has no rows.
Rows that repeat an id are documents like others, and so are items. Equal scores go by document id, null last. Extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.batches import lean, release
from folio.llm.shared import drop, stored, tidy
from folio.llm.textnum import byte_hashes, expand, numbered

#: A shard's documents, and bytes of text of which it holds about so many (one document at least).
SHARD_DOCS, SHARD_BYTES = 1 << 14, 6 << 20
BLOCK_BITS = 5
BLOCK_DOCS = 1 << BLOCK_BITS
#: Bytes of terms of a block of items, and terms of the items that a shard serves at once.
ITEM_BYTES, ITEM_TERMS = 4 << 20, 1 << 13
#: Nodes that are opened for an item at a time.
OPENED = 8
#: Parts of an item's candidates that are ranked by themselves first.
SALT = 64

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_spans(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, text number) of the terms of all texts."""
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = _LOWER[np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)]
    inside = np.concatenate(([False], _TERM[buf]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    stops = np.cumsum([len(b) + 1 for b in blobs])
    return buf.tobytes(), start, end, np.searchsorted(stops, start, "right")


def collection(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents): one scan, one row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = terms = 0
        for b in lean(batches):
            _, start, _, owner = term_spans(b.column(0).to_pylist())
            n += int((np.diff(owner) > 0).sum()) + bool(len(owner))
            terms += len(start)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([terms])], names=["n", "terms"])

    with tidy(docs.sparkSession):
        got = docs.select(text_col).mapInArrow(run, "n long, terms long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    return got[0], got[1]


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What tf occurrences add, of 1,000,000 at most, in a document of n terms."""
    m = 100 - 90 + (90 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def tree_of(ids: list[int | None], texts: list[str | None], documents: int, terms: int) -> dict[str, bytes | int] | None:
    """A shard's index: the columns of SHARD; None if no text has a term."""
    data, start, end, owner = term_spans(texts)
    if not len(start):
        return None
    _, first, which = numbered(byte_hashes(data, start, end), np.frombuffer(data, np.uint8), start, end)
    held, doc = np.unique(owner, return_inverse=True)
    n = np.bincount(doc)
    pair, tf = np.unique(which * len(held) + doc, return_counts=True)
    term, at = pair // len(held), pair % len(held)
    value = impacts(tf, n[at], documents, terms)
    order = np.argsort((term << 20) - value, kind="stable")  # by term, then falling impact, then document
    term, number, value = term[order], at[order], value[order].astype(np.int32)
    depth = max(0, int(len(held) - 1).bit_length() - BLOCK_BITS)
    bits, seq = [], number
    for level in range(depth):
        one = (seq >> (BLOCK_BITS + depth - 1 - level)) & 1 == 1
        bits.append(np.packbits(one))
        seq = np.concatenate((seq[~one], seq[one]))
    word = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    by_word = sorted(range(len(word)), key=word.__getitem__)
    begin = np.searchsorted(term, np.arange(len(word) + 1))
    return {
        "words": b"\n".join(word[i] for i in by_word),
        "df": np.diff(begin)[by_word].astype("<i4").tobytes(),
        "begin": begin[:-1][by_word].astype("<i8").tobytes(),
        "impact": value.astype("<i4").tobytes(),
        "bits": b"".join(b.tobytes() for b in bits),
        "low": (seq & (BLOCK_DOCS - 1)).astype(np.uint8).tobytes(),
        "depth": depth,
        "ids": pickle.dumps([ids[i] for i in held.tolist()]),
    }


SHARD = "words binary, df binary, begin binary, impact binary, bits binary, low binary, depth int, ids binary"


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(stored shards, documents with a term). Two scans, no shuffle; every document is in a shard."""
    documents, terms = collection(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give() -> Iterator[pa.RecordBatch]:
            shard = tree_of(ids, texts, documents, terms)
            if shard:
                yield pa.RecordBatch.from_pylist([shard], pa.schema([(k, pa.int32() if k == "depth" else pa.binary()) for k in shard]))

        ids, texts, size = [], [], 0
        for b in lean(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if texts and (size + len(t or "") > SHARD_BYTES or len(texts) == SHARD_DOCS):
                    yield from give()
                    ids, texts, size = [], [], 0
                    release()
                ids.append(i)
                texts.append(t)
                size += len(t or "")
        if texts:
            yield from give()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, SHARD), "wavelet_trees"), documents


class Tree:
    """A shard's index as it is searched."""

    def __init__(self, row: dict):
        self.words = row["words"].split(b"\n")
        self.df, self.begin = np.frombuffer(row["df"], "<i4"), np.frombuffer(row["begin"], "<i8")
        self.depth, self.low = row["depth"], np.frombuffer(row["low"], np.uint8)
        self.ids = pickle.loads(row["ids"])
        size = len(self.low)
        impact = np.frombuffer(row["impact"], "<i4")
        packed = np.frombuffer(row["bits"] or b"", np.uint8).reshape(self.depth, (size + 7) // 8)
        # ones[level, p]: ones before place p; impact[level, p]: the impacts in the level's order
        self.ones = np.zeros((self.depth, size + 1), np.int32)
        self.impact = np.empty((self.depth + 1, size), np.int32)
        self.impact[0] = impact
        for level in range(self.depth):
            one = np.unpackbits(packed[level], count=size).astype(bool)
            np.cumsum(one, out=self.ones[level, 1:])
            self.impact[level + 1] = np.concatenate((self.impact[level][~one], self.impact[level][one]))
        self.at = {w: i for i, w in enumerate(self.words)}

    def halves(self, level: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a border between postings of a level lies in the next level, in the left and in the right half."""
        ones = self.ones[level, place]
        zeros = self.ones.shape[1] - 1 - self.ones[level, -1]
        return place - ones, zeros + ones


class Best:
    """The best k of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = np.ones(items, np.int64)  # scores that can still count

    def take(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score, doc, null = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.k]
        last = rank == self.k - 1
        self.least[item[last]] = np.maximum(self.least[item[last]], score[order][last])
        self.item, self.score, self.doc, self.null = item[rank < self.k], score[kept], doc[kept], null[kept]


def search_tree(tree: Tree, item: np.ndarray, weight: np.ndarray, word: np.ndarray, best: Best) -> None:
    """Open the nodes of all items, best first. item, weight, word (number in the tree): a row for each term of an item, by item."""
    doc_id = np.array([-1 if i is None else i for i in tree.ids], np.int64)
    doc_null = np.array([i is None for i in tree.ids], bool)
    node_item, owner = np.unique(item, return_inverse=True)
    level, prefix = np.zeros(len(node_item), np.int64), np.zeros(len(node_item), np.int64)
    s, w = tree.begin[word], weight
    e = s + tree.df[word]
    bound = np.zeros(len(node_item), np.int64)
    np.add.at(bound, owner, w * tree.impact[0, s])
    while len(node_item):
        # the nodes to open: the first few of each item by bound
        order = np.lexsort((-bound, node_item))
        of = node_item[order]
        opened = np.zeros(len(order), bool)
        opened[order[np.arange(len(order)) - np.searchsorted(of, of) < OPENED]] = True
        runs = opened[owner]
        number = np.cumsum(opened) - 1
        n_item, n_level, n_prefix = node_item[opened], level[opened], prefix[opened]
        o, a, z, v = number[owner[runs]], s[runs], e[runs], w[runs]
        stay = ~opened
        number = np.cumsum(stay) - 1
        rest = (node_item[stay], level[stay], prefix[stay], bound[stay], number[owner[~runs]], s[~runs], e[~runs], w[~runs])
        # blocks: sum postings by document
        block = n_level == tree.depth
        at = block[o]
        if at.any():
            size = z[at] - a[at]
            place = expand(a[at], size)
            key = np.repeat(o[at], size) * BLOCK_DOCS + tree.low[place]
            sums = np.zeros(len(n_item) * BLOCK_DOCS, np.int64)
            np.add.at(sums, key, np.repeat(v[at], size) * tree.impact[tree.depth, place])
            found = np.flatnonzero(sums >= np.repeat(best.least[n_item], BLOCK_DOCS))
            doc = n_prefix[found // BLOCK_DOCS] * BLOCK_DOCS + found % BLOCK_DOCS
            best.take(n_item[found // BLOCK_DOCS], sums[found], doc_id[doc], doc_null[doc])
        # inner nodes: runs go to the halves
        o, a, z, v = o[~at], a[~at], z[~at], v[~at]
        deep = n_level[o]
        if len(o):
            (a0, a1), (z0, z1) = tree.halves(deep, a), tree.halves(deep, z)
            o, a, z, v, deep = np.concatenate((2 * o, 2 * o + 1)), np.concatenate((a0, a1)), np.concatenate((z0, z1)), np.concatenate((v, v)), np.concatenate((deep, deep)) + 1
            full = z > a
            o, a, z, v, deep = o[full], a[full], z[full], v[full], deep[full]
        child, o = np.unique(o, return_inverse=True)
        c_bound = np.zeros(len(child), np.int64)
        np.add.at(c_bound, o, v * tree.impact[deep, a])
        node_item = np.concatenate((rest[0], n_item[child // 2]))
        level = np.concatenate((rest[1], n_level[child // 2] + 1))
        prefix = np.concatenate((rest[2], n_prefix[child // 2] * 2 + child % 2))
        bound = np.concatenate((rest[3], c_bound))
        owner = np.concatenate((rest[4], o + len(rest[0])))
        s, e, w = np.concatenate((rest[5], a)), np.concatenate((rest[6], z)), np.concatenate((rest[7], v))
        keep = bound >= best.least[node_item]
        runs = keep[owner]
        owner = (np.cumsum(keep) - 1)[owner[runs]]
        s, e, w = s[runs], e[runs], w[runs]
        node_item, level, prefix, bound = node_item[keep], level[keep], prefix[keep], bound[keep]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items as (id, distinct terms) in blocks of bounded size; an item of more bytes is a block of its own."""
    block, size = [], 0
    for r in items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        data, start, end, _ = term_spans([r.text])
        terms = sorted({data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)})
        own = sum(map(len, terms)) + 64
        if block and size + own > ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((r.id, terms))
        size += own
    if block:
        yield block


def document_counts(shards: DataFrame, terms: list[bytes]) -> np.ndarray:
    """Documents that hold each of a block's terms: one scan of the shards' term lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {t: i for i, t in enumerate(terms)}
        total = np.zeros(len(terms), np.int64)
        for b in lean(batches):
            for words, df in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(df, "<i4")
                for i, word in enumerate(words.split(b"\n")):
                    if word in asked:
                        total[asked[word]] += counts[i]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(len(terms), np.int64)
    with tidy(shards.sparkSession):
        got = shards.select("words", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out


def _searched(shards: DataFrame, documents: int, block: list[tuple[int | None, list[bytes]]], first: int, k: int) -> DataFrame:
    """(row, item, doc, score) of the best k of each item of a block in each task; row numbers items."""
    terms = sorted({t for _, ts in block for t in ts})
    df = document_counts(shards, terms)
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in zip(terms, df.tolist(), strict=True) if n}
    ids = [i for i, _ in block]
    asked = [[t for t in ts if t in weight] for _, ts in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        for b in batches:
            for i in range(b.num_rows):
                tree = Tree(b.slice(i, 1).to_pylist()[0])
                rows = []
                for number, ts in enumerate(asked):
                    rows += [(number, weight[t], tree.at[t]) for t in ts if t in tree.at]
                    if len(rows) > ITEM_TERMS:
                        search_tree(tree, *np.array(rows, np.int64).T, best)
                        rows = []
                if rows:
                    search_tree(tree, *np.array(rows, np.int64).T, best)
                del tree
                release()
        item = best.item.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([first + i for i in item], pa.int64()), pa.array([ids[i] for i in item], pa.int64()), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score, pa.int64())],
            names=["row", "item", "doc", "score"],
        )

    return shards.mapInArrow(run, "row long, item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item id, rank, document id, score): the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    shards, documents = index(docs, id_col, text_col)
    out, first = spark.createDataFrame([], "row long, item long, doc long, score long"), 0
    for block in item_blocks(items, item_col, item_text_col):
        out = out.unionByName(stored(_searched(shards, documents, block, first, k), "found"))
        first += len(block)
    drop(shards)
    best = [F.desc("score"), F.asc_nulls_last("doc")]
    salted = out.withColumn("salt", F.pmod(F.xxhash64("row", "doc", F.spark_partition_id()), F.lit(SALT)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*best))).where(F.col("rank") <= k).drop("rank")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
