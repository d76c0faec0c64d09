"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

A source's target is its share, by weight, of `share` times all words; targets stop at `most` times the source's own words and
what they leave is shared anew among the others, until none is above. Each document of a source is expected target / source size
times. Documents stand by size, then id, within their source; expected copies are summed up along this order, one random
offset is added for each source, and a document is taken once for each whole number that the sum crosses in it. As sizes
rise along the order, what a source's sum leaves over or takes early is made good by documents of nearly its
size: the words taken differ from the target by no more than about its largest document. Sums are whole numbers of 2^-24 copies, so nothing is
lost to rounding along billions of documents, and no document is taken more than `most` times.

Rows (id, source, size) are dealt by ranges of the order, so a source that holds most documents is spread
over many ranges; a window runs within a range, and the counts of ranges, one row for each range and source, give what
stands before it. Sources are numbered the same way, however many there are.

Defined results: a null or empty text has size 0 and is dealt with like others (what it takes is 0 words). A null source is
a source, the last one. Rows that repeat an id are documents like others; which of two rows that are alike in id, source and size is
taken more often is not told. Sources without words have target 0. No documents, no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import drop, stored, tidy

WORD = r"[^\x20\x09-\x0D]++"
#: Copies are counted in units of 2^-UNIT_BITS: room for 2^38 documents of a source.
UNIT_BITS = 24
#: Rows of a range of the order.
RANGE_ROWS = 1 << 18
SOURCE = ("unnamed", "source")


def words(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, n: int, order: Sequence[str], groups: Sequence[str] = (), name: str = "place", known: DataFrame | None = None) -> DataFrame:
    """The n rows with `name`, their number (from 1) within their group in the order, which begins with the groups' columns; and with the columns of `known`, a row for each group.

    Rows are dealt by ranges and stored; no window or join key holds more rows than a range has, as what is known
    of a group goes to its ranges first.
    """
    dealt = stored(rows.repartitionByRange(max(1, -(-n // RANGE_ROWS), min(n, _parts(rows))), *order).withColumn("m_part", F.spark_partition_id()), name)
    own = ["m_part", *groups]
    inside = F.row_number().over(Window.partitionBy(*own).orderBy(*order))
    before = Window.partitionBy(*groups).orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*own).agg(F.count(F.lit(1)).alias("m_n")).withColumn("m_before", F.coalesce(F.sum("m_n").over(before), F.lit(0))).drop("m_n")
    if known is not None:
        counts = counts.join(known, list(groups))
    return dealt.withColumn("m_in", inside.cast("long")).join(counts, own).withColumn(name, F.col("m_in") + F.col("m_before")).drop("m_part", "m_in", "m_before")


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def weighted(sources: DataFrame, n: int, weights: Sequence[int]) -> DataFrame:
    """The n sources with `weight`: the weights in turn, by code point, null last."""
    given = F.array(*(F.lit(w).cast("long") for w in weights))
    ranked = numbered(sources, n, SOURCE, name="nth")
    return ranked.withColumn("weight", F.get(given, ((F.col("nth") - 1) % len(weights)).cast("int"))).drop("nth")


def targets(sources: DataFrame, share: tuple[int, int], most: int) -> DataFrame:
    """Stored sources (size, weight) with `target`. share: numerator and denominator of the words asked for, of all words.

    The words for a unit of weight rise from round to round as sources reach their limit; a round is one aggregate of the
    sources to one row.
    """
    up, down = share
    asked = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words")).first().words * up
    level, capped = F.lit(0.0), F.lit(False)
    held = -1
    while True:
        one = sources.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count_if(capped).alias("n"),
        ).first()
        if one.n == held or not one.weight:
            break
        held = one.n
        level = F.lit(float(asked - down * most * one.words)) / F.lit(float(down * one.weight))
        capped = F.col("weight") * level > F.col("source_size") * most
    limit = (F.col("source_size") * most).cast("double")
    return sources.withColumn("target", F.when(capped, limit).otherwise(F.least(limit, F.col("weight") * level)) if one.weight else limit)


def offset(seed: int) -> Column:
    """A random number of units below one copy for each source, the same in each run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.when(F.col("unnamed"), F.lit("")).otherwise(F.concat(F.lit("="), "source")))), 1, UNIT_BITS // 4), 16, 10).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).isNull().alias("unnamed"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), words(F.col(text_col)).alias("size"))
    sized = stored(rows, "sized")
    sources = stored(sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    with tidy(docs.sparkSession):
        n, n_sources = sources.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known = stored(weighted(sources.drop("n"), n_sources, weights), "weighted")
    # whole numbers of units; a quotient of doubles can't pass the limit by more than its last bit
    units = F.when(F.col("source_size") > 0, F.floor(F.least(F.col("target") / F.col("source_size"), F.lit(float(most))) * (1 << UNIT_BITS))).otherwise(0).cast("long")
    plan = stored(targets(known, share, most).withColumns({"units": units, "offset": offset(seed)}), "targets")
    placed = numbered(sized, n, [*SOURCE, "size", "id"], SOURCE, known=plan)
    until = lambda k: F.shiftright((F.col("place") - k) * F.col("units") + F.col("offset"), UNIT_BITS)
    out = placed.withColumn("copies", until(0) - until(1))
    drop(sources, known)
    source = F.when(~F.col("unnamed"), F.col("source"))
    return out.select(F.col("id").alias(id_col), source.alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
