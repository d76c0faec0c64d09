"""Near-duplicate documents by one-permutation MinHash.

A document's set holds its distinct shingles as 64-bit hashes. One hash of each element
gives its bin and its value, so one pass makes the whole signature; an empty bin borrows
from the bin that a universal hash of (bin, attempt) names first (optimal densification).
Equal sets become one node, so copies count once. Bands of bins give bucket keys.

Nodes with too many shingles that no other candidate has can't be linked and go by an
exact count. Then each bucket is a star: its members are compared with one of them, the
one whose shingles are common most, on full sets; the outcome is kept as what the member
lacks of the centre and what it adds. That confirms the links to centres, and these give
nearly all components. Linked nodes share a bucket, hence a centre, so a link that the
stars missed is among the members of one centre: where these lie in several components,
the strays (outside the centre's component) are compared with the other members and each
other, in blocks, exactly, by what they lack and add. A task emits one link for two
components at most. No cap is set on buckets or partners; nothing emits all pairs.
Shingles are 64-bit hashes that no sums or products of letters can make equal; two
shingles share one by chance alone, which moves an intersection by one.

Defined results: a null, empty or blank text has no set, n_shingles 0 and links with
nothing. Equal sets share a component; rows that repeat an id share its component by
their own texts. component_id is the least id (nulls aside) that can be reached. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.batches import lean
from folio.llm.components import components
from folio.llm.shared import bit_filter, drop, passes, stored
from folio.llm.textnum import U64, Words, chunked, mix, span_hashes

BANDS, ROWS = 36, 5
BINS = BANDS * ROWS
#: Members of a centre that meet in one task, from either side.
BLOCK = 256
ELEMENTS = 4096


def _donors() -> Iterator[np.ndarray]:
    """For each attempt the bin that every bin looks at."""
    attempt = 0
    while True:
        x = mix(np.arange(BINS, dtype=U64) * U64(0x9E3779B1) + U64(attempt * 0xC2B2AE3D27D4EB4F + 7 & 0xFFFFFFFFFFFFFFFF))
        yield ((x >> U64(32)) * U64(BINS) >> U64(32)).astype(np.int64)
        attempt += 1


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; words are lower-cased in A-Z."""
    out = []
    for _, run in chunked(texts):
        words = Words(run, lower=True)
        ends = words.first
        n = np.diff(ends)
        size = np.minimum(n, width)
        count = np.where(n > 0, n - size + 1, 0)
        total = np.cumsum(count)
        start = np.arange(int(total[-1])) + np.repeat(ends[:-1] - (total - count), count)
        hashes = span_hashes(words.hash, start, start + np.repeat(size, count))
        out += [np.unique(x) for x in np.split(hashes, total[:-1])]
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BINS values for each (not empty) set."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = owner * BINS + ((flat >> U64(32)) * U64(BINS) >> U64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    sig = np.zeros(len(sets) * BINS, U64)
    full = np.zeros(len(sig), bool)
    sig[place[first]] = mix(flat[first])
    full[place[first]] = True
    empty = np.flatnonzero(~full)
    row, bin_ = empty // BINS * BINS, empty % BINS
    for donor in _donors():
        if not len(empty):
            break
        source = row + donor[bin_]
        hit = full[source]
        sig[empty[hit]] = sig[source[hit]]
        empty, row, bin_ = empty[~hit], row[~hit], bin_[~hit]
    return sig.reshape(len(sets), BINS)


def node_of(found: np.ndarray) -> bytes:
    """The 128-bit key of a set: equal sets make one node."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A bucket key for each band of each signature."""
    parts = sig.reshape(len(sig), BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=U64), (len(sig), 1))
    for k in range(ROWS):
        keys = mix(mix(keys) + parts[:, :, k])
    return keys.view(np.int64)


def sketch(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, node (128-bit hash of the set, null if empty), bands (bucket keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                sets = shingle_sets([t or "" for t in part.column(1).to_pylist()], width)
                some = [i for i, s in enumerate(sets) if len(s)]
                nodes, bands = ([None] * len(sets) for _ in range(2))
                if some:
                    keys = band_keys(signatures([sets[i] for i in some]))
                    for k, i in enumerate(some):
                        nodes[i], bands[i] = node_of(sets[i]), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=[id_col, "n_shingles", "node", "bands"],
                )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_shingles long, node binary, bands array<long>")


def _sets_of(docs: DataFrame, width: int, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(n, set), stored, of the nodes in wanted (n, node, low): a bounded filter in Python, then an exact join."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted.select(F.xxhash64("low").alias("h")), "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in lean(batches):
            b = b.filter(pa.array(passes(bits.value, b.column(1).to_numpy())))
            for at in range(0, b.num_rows, 1000):
                sets = {node_of(s): s for s in shingle_sets([t or "" for t in b.column(0).slice(at, 1000).to_pylist()], width) if len(s)}
                # of a task's rows with one set the first will do
                new = [k for k in sets if k not in seen]
                seen.update(new)
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), pa.array([sets[k].view(np.int64) for k in new], pa.list_(pa.int64()))], names=["node", "set"])

    made = docs.select(text_col, F.xxhash64(F.col(id_col)).alias("h")).mapInArrow(run, "node binary, set array<long>")
    out = stored(made.join(wanted.select("node", "n"), "node").dropDuplicates(["n"]).select("n", "set"), "sets")
    bits.destroy()
    return out


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(n, centre, of, lacks, adds, linked) of pairs (n, centre): the centre's size and the differences of the full sets."""
    own = sets.select("n", F.col("set").alias("sn"))
    mid = sets.select(F.col("n").alias("centre"), F.col("set").alias("sc"))
    both = pairs.join(own, "n").join(mid, "centre")
    both = both.select("n", "centre", F.size("sn").alias("size"), F.size("sc").alias("of"), F.array_except("sc", "sn").alias("lacks"), F.array_except("sn", "sc").alias("adds"))
    return both.select("n", "centre", "of", "lacks", "adds", ((F.col("size") - F.size("adds")) * 100 >= (F.col("of") + F.size("adds")) * percent).alias("linked"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept: one row for each row of docs."""
    sig = stored(sketch(docs, width, id_col, text_col), "sketch")
    # from here on a node is a number
    classes = sig.where("node is not null").groupBy("node").agg(F.min(id_col).alias("low"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("n", F.monotonically_increasing_id()), "classes")

    members = classes.select("n", F.explode("bands").alias("key"))
    crowd = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    inside = stored(members.join(crowd, "key").select("n", "key"), "members")
    sets = _sets_of(docs, width, inside.select("n").distinct().join(classes.select("n", "node", "low"), "n"), id_col, text_col)
    # only nodes whose sets can overlap enough with any one other go on
    able = stored(_shared(sets).where(F.col("shared") * 100 >= F.col("size") * percent), "able")
    going = stored(inside.join(able, "n"), "going")
    drop(crowd, inside, able)
    stars = going.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max_by("n", F.struct(F.col("shared") / F.col("size"), "size", "n")).alias("centre")).where("size > 1")
    stars = stored(stars, "stars")
    pairs = stored(going.join(stars.select("key", "centre"), "key").where("n != centre").select("n", "centre").distinct(), "pairs")
    compared = stored(_compared(pairs, sets, percent), "compared")
    drop(going, stars, pairs, sets)
    first = stored(components(compared.where("linked").select(F.col("n").alias("a"), F.col("centre").alias("b"))), "components")
    more = _across(compared, first, percent)
    roots = first
    if not more.isEmpty():
        roots = stored(components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "components")
    drop(compared, more)

    named = classes.select("n", "node", "low").join(roots.withColumnRenamed("node", "n"), "n", "left").withColumn("root", F.coalesce("root", "n"))
    least = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    named = stored(named.join(least, "root").select("node", "component_id"), "named")
    drop(classes, least, *({id(first): first, id(roots): roots}.values()))
    linked = sig.where("node is not null").select(id_col, "n_shingles", "node").join(named, "node").select(id_col, "n_shingles", "component_id")
    alone = sig.where("node is null").select(id_col, "n_shingles", F.col(id_col).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _shared(sets: DataFrame) -> DataFrame:
    """(n, size, shared): set size, and how many of a node's shingles any other candidate's set holds too.

    No other set has the rest, so an intersection is at most the smaller `shared` of two nodes. Near-copies whose edits
    are their own thus fall out by counts, before any pairs are made.
    """
    own = sets.select("n", F.explode("set").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("of"), F.min("n").alias("n")).where("of = 1")
    own = own.groupBy("n").agg(F.count(F.lit(1)).alias("own"))
    return sets.select("n", F.size("set").alias("size")).join(own, "n", "left").select("n", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"))


def _across(compared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), stored, between members of one centre that lie in different components.

    Strays, members outside the centre's component, meet all other members: block i of strays meets block j of
    strays for i <= j, and each block of the rest, home. Members at home are in one component already. The rows dealt grow
    with the blocks of strays, so they are few where the stars did well. Centres are found open or not by narrow rows;
    the differences are fetched for members of open ones only, by (member, centre), which is no hot key.
    """
    of_node, of_centre = roots.select(F.col("node").alias("n"), F.col("root").alias("r1")), roots.select(F.col("node").alias("centre"), F.col("root").alias("r2"))
    placed = compared.select("n", "centre").join(of_node, "n", "left").join(of_centre, "centre", "left")
    placed = placed.select("n", "centre", F.coalesce("r1", "n").alias("root"), (F.coalesce("r1", "n") != F.coalesce("r2", "centre")).alias("stray"))
    placed = stored(placed, "placed")
    counts = stored(placed.groupBy("centre").agg(F.count_if("stray").alias("strays"), F.count_if(~F.col("stray")).alias("homes")).where("strays > 1 or strays > 0 and homes > 0"), "open")
    rows = compared.drop("linked").join(placed.join(counts, "centre"), ["n", "centre"])
    s, h = F.ceil(F.col("strays") / BLOCK), F.ceil(F.col("homes") / BLOCK)
    block = F.pmod(F.xxhash64("n"), F.when(F.col("stray"), s).otherwise(h))
    rows = rows.withColumns({"s": s, "h": h, "block": block})
    first = F.lit(0).cast("long")
    upto = lambda n: F.when(n > 0, F.sequence(first, n - 1)).otherwise(F.array().cast("array<bigint>"))
    with_strays = F.transform(upto(F.col("s")), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    with_homes = F.transform(upto(F.col("h")), lambda j: F.struct(F.col("block").alias("i"), (F.col("s") + j).alias("j")))
    at_home = F.transform(upto(F.col("s")), lambda i: F.struct(i.alias("i"), (F.col("s") + F.col("block")).alias("j")))
    meets = F.when(F.col("stray"), F.concat(with_strays, with_homes)).otherwise(at_home)
    dealt = rows.select("centre", "of", "n", "root", "stray", "lacks", "adds", "block", "s", F.explode(meets).alias("m")).select("*", "m.i", "m.j").drop("m")

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        stray, own, s = g.stray.to_numpy(), g.block.to_numpy(), int(g.s.iat[0])
        x = np.flatnonzero(stray & (own == i))
        y = np.flatnonzero(stray & (own == j)) if j < s else np.flatnonzero(~stray)
        of = int(g.of.iat[0])
        r, a = (np.array([len(v) for v in c]) for c in (g.lacks, g.adds))
        no_r, both_a = _common(g.lacks, x, y), _common(g.adds, x, y)
        size = of - r + a
        common = of - (r[x][:, None] + r[y][None, :] - no_r) + both_a
        near = common * 100 >= (size[x][:, None] + size[y][None, :] - common) * percent
        root, _ = pd.factorize(g.root)
        near &= root[x][:, None] != root[y][None, :]
        p, q = np.nonzero(near)
        # one link for two components
        _, one = np.unique(np.sort(np.stack([root[x[p]], root[y[q]]]), axis=0), axis=1, return_index=True)
        return pd.DataFrame({"a": g.n.to_numpy()[x[p[one]]], "b": g.n.to_numpy()[y[q[one]]]})

    out = stored(dealt.groupBy("centre", "i", "j").applyInPandas(run, "a long, b long").distinct(), "links")
    drop(placed, counts)
    return out


def _common(sets: pd.Series, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x with sets y. Elements are taken some thousand at a time, and only those that two sets have."""
    sizes = np.array([len(v) for v in sets])
    flat = np.concatenate([np.asarray(v, np.int64) for v in sets])
    _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[at]
    row = np.repeat(np.arange(len(sizes)), sizes)[number >= 0]
    number = number[number >= 0]
    out = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, int(number.max(initial=-1)) + 1, ELEMENTS):
        some = (number >= start) & (number < start + ELEMENTS)
        has = np.zeros((len(sizes), ELEMENTS), np.float32)
        has[row[some], number[some] - start] = 1
        out += has[x] @ has[y].T
    return out.astype(np.int64)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates: of each component the document with the least id (null first), then text hash, stays.

    Of rows that repeat id and text one stays; documents without words all stay.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    found = near_duplicates(docs.select(key.alias("key"), F.col(text_col).alias("text")), width, percent, "key", "text")
    # keys without nulls, the same for the join and for repeated rows, so that texts are shuffled once
    parts = lambda i, h: [F.coalesce(i.cast("string"), F.lit("")).alias("_near_id"), i.isNull().alias("_near_null"), h.alias("_near_h")]
    names = ["_near_id", "_near_null", "_near_h"]
    kept = found.where("kept").select(*parts(F.col("key.id"), F.col("key.h"))).distinct()
    keyed = docs.select("*", *parts(F.col(id_col), F.xxhash64(text_col)))
    return keyed.dropDuplicates(names).join(kept, names, "left_semi").select(*docs.columns)
