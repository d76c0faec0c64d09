"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts are tokenised once and cut; only (id, piece, length, checksum) rows go on. Pieces
that fill a sequence stand alone. The rest is dealt by row number to groups of about
GROUP_ITEMS pieces, so copies of one row are spread too. For each group several islands evolve a
population of packings: a child takes whole well-filled bins of one parent, drops the other
parent's bins that hold any of these pieces and its own least filled ones, puts displaced pieces into bins in
place of smaller ones where they fill them better, and best-fits what is left. After every EPOCH
generations each island's elite migrates to the next island; at last the elites meet in one
population for the group, which evolves on. Pieces in bins that
stay poorly filled are pooled across groups, dealt as whole bins, and packed again the
same way; each population has these bins as they stand, so that none is lost to the search.

Defined results: a null text is an empty one and gives one piece, its end token. Every
row is packed, repeated rows and repeated ids too; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.batches import lean, release
from folio.llm.bpe import load
from folio.llm.shared import stored

GROUP_ITEMS = 40_000
ISLANDS, POPULATION, GENERATIONS = 2, 3, 2
#: Times that islands evolve and send their elites on, and the share of least filled bins that a child gives up.
EPOCHS, GIVEN_UP = 2, 0.03
#: Bins with more free places than this share go to the pool.
POOR = 0.004


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every text: all but a document's first have `capacity` tokens. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in lean(batches):
            row, no, start, size, crc = [], [], [], [], []
            for i, ids in enumerate(bpe.encode_batch([t or "" for t in b.column(1).to_pylist()])):
                data = np.append(ids, end_id).astype("<u4")
                cuts = [0, *range(len(data) % capacity or capacity, len(data) + 1, capacity)]
                for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    row.append(i)
                    no.append(k)
                    start.append(x)
                    size.append(y - x)
                    crc.append(zlib.crc32(data[x:y].tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A packing: bins of item numbers, with the open bins kept by free places for best fit."""

    def __init__(self, size: list[int], capacity: int):
        self.size, self.capacity = size, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0  # bit r is set if some bin has r free places

    def add(self, items: list[int]) -> None:
        free = self.capacity - sum(map(self.size.__getitem__, items))
        self.by_free[free].append(len(self.bins))
        self.mask |= 1 << free
        self.bins.append(list(items))
        self.free.append(free)

    def best_fit(self, items: list[int]) -> None:
        """Each item to the fullest bin that has room, else to a new one."""
        size, by_free, bins, free, mask, capacity = self.size, self.by_free, self.bins, self.free, self.mask, self.capacity
        for i in items:
            n = size[i]
            above = mask >> n
            if above:
                r = n + (above & -above).bit_length() - 1
                k = by_free[r].pop()
                if not by_free[r]:
                    mask ^= 1 << r
                bins[k].append(i)
            else:
                r, k = capacity, len(bins)
                bins.append([i])
                free.append(capacity)
            r -= n
            free[k] = r
            by_free[r].append(k)
            mask |= 1 << r
        self.mask = mask

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then the more uneven fill."""
        return len(self.bins), -sum((self.capacity - f) ** 2 for f in self.free)

    def labels(self) -> np.ndarray:
        out = np.zeros(len(self.size), np.int64)
        for k, b in enumerate(self.bins):
            out[b] = k
        return out


def refill(bins: list[list[int]], loose: list[int], size: list[int], capacity: int) -> tuple[list[list[int]], list[int]]:
    """Bins in which loose items stand in place of smaller ones wherever that fills a bin better, and the items that are loose then.

    What is left loose is smaller, so it fits more easily.
    """
    stock = sorted((size[i], i) for i in loose)
    out = []
    for items in bins:
        items = list(items)
        free = capacity - sum(map(size.__getitem__, items))
        for k, i in enumerate(items):
            if not free or not stock:
                break
            # the largest loose item that still fits in place of this one
            at = bisect_right(stock, (size[i] + free, len(size))) - 1
            if at >= 0 and stock[at][0] > size[i]:
                n, items[k] = stock.pop(at)
                insort(stock, (size[i], i))
                free -= n - size[i]
        out.append(items)
    return out, [i for _, i in stock]


def crossover(a: Bins, b: Bins, rnd: random.Random) -> Bins:
    """Whole well-filled bins of b go into a; a's bins that hold their items dissolve, and some of its least filled; the displaced are refilled and best-fitted."""
    order = sorted(range(len(b.bins)), key=b.free.__getitem__)
    top = order[: max(1, len(order) // 2)]
    taken = [b.bins[k] for k in top if rnd.random() < 0.5] or [b.bins[order[0]]]
    inside = bytearray(len(a.size))
    for items in taken:
        for i in items:
            inside[i] = 1
    worst = set(sorted(range(len(a.bins)), key=a.free.__getitem__, reverse=True)[: max(2, int(len(a.bins) * GIVEN_UP))])
    kept, displaced = [], []
    for k, items in enumerate(a.bins):
        hit = sum(map(inside.__getitem__, items))
        if not hit and k not in worst:
            kept.append(items)
        elif hit < len(items):
            displaced += [i for i in items if not inside[i]]
    kept, displaced = refill(kept, displaced, a.size, a.capacity)
    child = Bins(a.size, a.capacity)
    for items in (*taken, *kept):
        child.add(items)
    displaced.sort(key=a.size.__getitem__, reverse=True)
    child.best_fit(displaced)
    return child


def seed_packing(size: list[int], capacity: int, rnd: random.Random, noise: float) -> Bins:
    """Best fit of items by falling size, blurred by noise."""
    out = Bins(size, capacity)
    out.best_fit(sorted(range(len(size)), key=lambda i: -size[i] * (1 + noise * rnd.random())))
    return out


def evolve(population: list[Bins], rnd: random.Random, generations: int = GENERATIONS) -> Bins:
    """The best packing after so many generations; the best is never lost. Ends once the lower bound is met."""
    population.sort(key=Bins.fitness)
    if not population[0].size:
        return population[0]
    least = -(-sum(population[0].size) // population[0].capacity)
    for _ in range(generations):
        if len(population[0].bins) <= least:
            break
        children = [crossover(*rnd.sample(population, 2), rnd) for _ in range(len(population) - 1)] if len(population) > 1 else []
        population = sorted(population + children, key=Bins.fitness)[: len(population)]
    return population[0]


def from_labels(size: list[int], capacity: int, labels: np.ndarray) -> Bins:
    out, order = Bins(size, capacity), np.argsort(labels, kind="stable")
    for items in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
        out.add(items.tolist())
    return out


COLUMNS = ["row", "length"]


def _evolve_groups(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """(row, group, bin, free) of items (row, length): their bins, and the bins' free places. Items that have a group and bin are dealt by these, and their packing is in each population."""
    packed = {"group", "bin", "free"} <= set(items.columns)
    key = ["group", "bin"] if packed else ["row"]
    stand = (F.col("group") * (1 << 24) + F.col("bin")) if packed else F.lit(-1).cast("long")
    dealt = items.select(*COLUMNS, F.pmod(F.xxhash64(*key), F.lit(groups)).alias("group"), stand.alias("stand"))
    # an island's row has its item's bins in the packings that came by sea
    sent = F.array(F.when(F.col("stand") >= 0, F.col("stand")).otherwise(F.lit(-1).cast("long")))
    islands = dealt.select(*COLUMNS, "group", sent.alias("sent"), F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])).alias("island"))

    def settlers(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[int], list[Bins]]:
        release()
        pdf = pdf.sort_values(["length", "row"], kind="stable").reset_index(drop=True)
        size = pdf.length.tolist()
        came = np.stack(pdf.sent.to_numpy())
        return pdf, size, [from_labels(size, capacity, came[:, k]) for k in range(came.shape[1]) if came[0, k] >= 0]

    def epoch(first: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            group, no = map(int, key)
            pdf, size, population = settlers(pdf)
            rnd = random.Random(group * 1000 + no * 10 + first)
            wanted = POPULATION if first else POPULATION - 1
            population += [seed_packing(size, capacity, rnd, 0.0 if first and not (no or k) else 0.02 * k + 0.01 * no) for k in range(wanted)]
            return pdf[[*COLUMNS, "group", "island"]].assign(bin=evolve(population, rnd).labels())

        return run

    def landing(pdf: pd.DataFrame) -> pd.DataFrame:
        rnd = random.Random(int(pdf.group.iat[0]))
        pdf, size, population = settlers(pdf)
        best = evolve(population, rnd)
        labels = best.labels()
        return pdf[["row", "group"]].assign(bin=labels, free=np.array(best.free, np.int64)[labels])

    fields = "row long, length long, group long, island int, bin long"
    for k in range(EPOCHS):
        evolved = islands.groupBy("group", "island").applyInPandas(epoch(k == 0), fields)
        if k < EPOCHS - 1:
            # an island keeps its elite and gets that of the one before
            to = F.explode(F.array(F.col("island"), (F.col("island") + 1) % ISLANDS))
            both = evolved.select(*COLUMNS, "group", F.col("island").alias("from"), "bin", to.alias("island"))
            islands = both.groupBy("group", "island", *COLUMNS).agg(F.array_sort(F.collect_list(F.struct("from", "bin")))["bin"].alias("sent"))
    met = evolved.groupBy("group", *COLUMNS).agg(F.array_sort(F.collect_list(F.struct("island", "bin")))["bin"].alias("sent"))
    return met.groupBy("group").applyInPandas(landing, "row long, group long, bin long, free long")


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces with sequence_id and offset (gapless from 0); no sequence has over `capacity` tokens."""
    cut = stored(pieces(docs, path, capacity, end_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    rest = cut.where(F.col("length") < capacity).select(*COLUMNS)
    first = stored(_evolve_groups(rest, max(1, ceil(rest.count() / GROUP_ITEMS)), capacity), "packed")
    poor = F.col("free") > F.lit(int(capacity * POOR))
    pool = rest.join(first.where(poor), "row")
    again = _evolve_groups(pool, max(1, ceil(first.where(poor).count() / GROUP_ITEMS)), capacity)
    bins = first.where(~poor).select("*", F.lit(0).alias("_round")).unionByName(again.select("*", F.lit(1).alias("_round")))
    bins = bins.select("row", ((F.col("group") * 2 + F.col("_round")) * (1 << 24) + F.col("bin")).alias("sequence_id"))
    out = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(bins, "row").withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0).cast("long")))
    return placed.select(*out).unionByName(full.select(*out))
