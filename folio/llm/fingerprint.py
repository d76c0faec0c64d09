"""Document fingerprints: a Merkle tree over word runs, paragraphs and sections, in DataFrame functions only.

Leaves are runs of up to LEAF_WORDS words of a paragraph (a line), with the digest of their text;
a paragraph's digest is over its leaves' digests, a section's over its paragraphs', the root over the
sections'. A section begins where a paragraph's digest begins with one of OPENS (one in eight), so
a paragraph that is put in or taken out changes its own section and no other's borders.
The fingerprint is the root in hex, then for each section "/" and eight digits of its
digest, for each paragraph ";" and eight digits, and "." and eight digits for each leaf. Equal roots mean equal
texts; where roots differ, the sections, then paragraphs, then leaves that differ locate
the edit. Likeness is the share of common leaves (2 * common / all, distinct ones).

Defined results: a null text is an empty one. Ids are integers. In `with_next` documents stand by falling
id, nulls last, then by a hash of the text; rows with equal id and text count once in this
order and get equal results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import stored

LEAF_WORDS = 6
#: First hex digits of the digests of paragraphs that begin a section.
OPENS = ("0", "8")
#: Hex digits that are printed of the digests below the root.
SHORT = 8


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text column (not null)."""
    leaf = rf"[^ ]*+(?: ++[^ ]++){{0,{LEAF_WORDS - 1}}}+ *+"

    # each array is named once, as the argument of a lambda, so that nothing is worked out twice
    def node(parts: Column, body: Column) -> Column:
        """digest over the digests of parts, and what is printed: eight digits of it, and body."""
        return F.struct(F.sha2(F.array_join(parts, ""), 256).alias("d"), body.alias("p"))

    def paragraph(leaves_: Column) -> Column:
        return node(leaves_, F.array_join(F.transform(leaves_, lambda d: F.concat(F.lit("."), F.substring(d, 1, SHORT))), ""))

    def paragraphs(line: Column) -> Column:
        found = F.filter(F.regexp_extract_all(line, F.lit(leaf), F.lit(0)), lambda x: x != "")
        return F.element_at(F.transform(F.array(F.transform(found, lambda x: F.sha2(x, 256))), paragraph), 1)

    def printed(sign: str) -> Callable[[Column], Column]:
        return lambda s: F.concat(F.lit(sign), F.substring(s["d"], 1, SHORT), s["p"])

    def section(part: Column) -> Column:
        return node(part["d"], F.array_join(F.transform(part, printed(";")), ""))

    def sections(found: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: (i == 1) | F.substring(F.element_at(found, i)["d"], 1, 1).isin(*OPENS))
        return F.element_at(F.transform(F.array(F.struct(found.alias("ls"), first.alias("first"))), cut), 1)

    def cut(s: Column) -> Column:
        stop = lambda k: F.coalesce(F.get(s["first"], k + 1), F.size(s["ls"]) + 1)
        return F.transform(s["first"], lambda i, k: F.element_at(F.transform(F.array(F.slice(s["ls"], i, stop(k) - i)), section), 1))

    def whole(found: Column) -> Column:
        return F.concat(F.sha2(F.array_join(found["d"], ""), 256), F.array_join(F.transform(found, printed("/")), ""))

    lines = F.transform(F.split(text, "\n"), paragraphs)
    return F.element_at(F.transform(F.transform(F.array(lines), sections), whole), 1)


def root(print_: Column) -> Column:
    return F.substring(print_, 1, 64)


def leaves(print_: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(print_, F.lit(r"\.([0-9a-f]{8})"), F.lit(1)))


def likeness(one: Column, two: Column) -> Column:
    """0 to 1; 1 for equal fingerprints. `one` and `two` are arrays of leaves."""
    total = F.size(one) + F.size(two)
    return F.when(total == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(one, two)) / total)


def differing(one: Column, two: Column) -> Column:
    """Numbers (from 0) of the sections of fingerprint one that two does not hold anywhere: where edits lie."""
    a = F.regexp_extract_all(one, F.lit(r"/([0-9a-f]{8})"), F.lit(1))
    b = F.regexp_extract_all(two, F.lit(r"/([0-9a-f]{8})"), F.lit(1))
    places = F.transform(a, lambda x, i: F.when(F.array_contains(b, x), F.lit(-1)).otherwise(i))
    return F.when(root(one) == root(two), F.array().cast("array<int>")).otherwise(F.filter(places, lambda i: i >= 0))


KEY = ("k_id", "k_null", "k_text")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("k_own"),
        F.coalesce(F.col(id_col), F.lit(0).cast("long")).alias("k_id"),
        F.col(id_col).isNull().alias("k_null"),
        F.xxhash64(text).alias("k_text"),
        text.alias("text"),
        F.length(text).cast("long").alias("n_chars"),
    )


def next_of(rows: DataFrame) -> DataFrame:
    """(key, n_chars, next key) for each distinct key, by falling id; the last one's next is the first.

    Keys are dealt by range and stored with their range's number; a window runs within a range, and
    the ranges' first keys, one row a range, close the gaps.
    """
    spark = rows.sparkSession
    ids = stored(rows.select(*KEY, "n_chars").distinct(), "ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc("k_null"), F.desc("k_id"), F.asc("k_text")]
    dealt = stored(ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    key = F.struct(*KEY)
    within = Window.partitionBy("part").orderBy(*order)
    listed = dealt.withColumn("after", F.lead(key).over(within))
    place = F.struct(F.col("k_null"), F.bitwise_not("k_id").alias("down"), F.col("k_text"))
    heads = dealt.groupBy("part").agg(F.min_by(key, place).alias("head"))
    # one row for each range
    w = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(w), F.first("head").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    return listed.join(F.broadcast(heads), "part").select(*KEY, "n_chars", F.coalesce("after", "head").alias("after"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form (last third replaced by the next document's start), and likenesses."""
    rows = _keyed(docs, id_col, text_col)
    pairs = next_of(rows).select(F.col("after.k_id").alias("k_id"), F.col("after.k_null").alias("k_null"), F.col("after.k_text").alias("k_text"), F.struct(*KEY).alias("of"), F.floor(F.col("n_chars") / 3).cast("int").alias("third"))
    # both joins need the same columns of rows by the same key, so the texts are shuffled once and read twice;
    # of the next document only its start and its leaves go on, four bytes a leaf
    given = rows.join(pairs, list(KEY)).withColumn("fp", fingerprint(F.col("text")))
    given = given.select(
        "of.*",
        F.col("k_own").alias("next_id"),
        F.col("n_chars").alias("next_n_chars"),
        F.expr("substring(text, 1, third)").alias("start"),
        F.unhex(root(F.col("fp"))).alias("next_root"),
        F.unhex(F.array_join(leaves(F.col("fp")), "")).alias("next_leaves"),
    ).dropDuplicates(list(KEY))
    both = rows.join(given, list(KEY))
    both = both.withColumns({"edited": F.expr("concat(substring(text, 1, cast(n_chars - floor(n_chars / 3) as int)), start)"), "fingerprint": fingerprint(F.col("text"))})
    both = both.select(F.col("k_own").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_root", "next_leaves", "next_id", "next_n_chars")
    three = F.regexp_extract_all(F.lower(F.hex("next_leaves")), F.lit(f".{{{SHORT}}}"), F.lit(0))
    both = both.withColumns({"one": leaves(F.col("fingerprint")), "two": leaves(F.col("edited_fingerprint")), "three": three})

    def near(same: Column, bag: str) -> Column:
        return F.when(same, F.lit(1.0)).otherwise(likeness(F.col("one"), F.col(bag)))

    own = root(F.col("fingerprint"))
    return both.select(
        id_col,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near(own == root(F.col("edited_fingerprint")), "two").alias("near_edited"),
        near(F.unhex(own) == F.col("next_root"), "three").alias("near_next"),
        F.col("next_id").alias("next_doc_id"),
        "next_n_chars",
    )
