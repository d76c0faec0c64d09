"""A table of contents and documents: the rule, entry by entry, and a title that most documents share."""

import random
import re

from pyspark.sql import functions as F

from folio.operators import contents
from folio.plans import jobs

FOLDERS = {"1": "docs", "2": "docs/a", "3": "docs/a/b"}


def key(title):
    return re.sub(r"[\s.]+", "", title.strip().lower())


def by_entry(toc, docs):
    """Each entry looks at every document."""
    out = []
    for idx, level, title, page in toc:
        number = re.match(r"\s*(\d+(?:\.\d+)*)\.?\s+(.+?)\s*$", title)
        asked = [key(number[2] if number else title), key(title)]
        found = []
        for k in asked:
            found = found or [p for p, t in docs if k and k in (key(t), key(p.rsplit("/", 1)[-1].removesuffix(".md")))]
        root = FOLDERS.get(number[1].split(".")[0]) if number else None
        inside = [p for p in found if root and p.startswith(root + "/")]
        best = sorted(inside or found, key=lambda p: (len(p), p))[:3]
        out += [(idx, level, title, page, r, p) for r, p in enumerate(best, 1)] or [(idx, level, title, page, 1, None)]
    return sorted(out, key=repr)


def test_entry_by_entry(spark):
    rnd = random.Random(6)
    names = ["Core", "1 Core", "Rules", "2.1 Rules", "Space Ship", "spaceship", "x", "...", "7 up"]
    docs = [(f"{rnd.choice(['docs', 'docs/a', 'docs/a/b', 'docs/ab', 'other'])}/{rnd.choice(names)}{i if i % 3 else ''}/{rnd.choice(names)}.md", rnd.choice(names)) for i in range(300)]
    docs = list(dict(docs).items())
    toc = [(i, 1 + i % 3, f"{rnd.choice(['', '1 ', '2. ', '2.4 ', '3.1.2 ', '9 '])}{rnd.choice([*names, 'Nowhere'])}", i) for i in range(120)]
    got = contents.match(spark.createDataFrame(toc, "toc_idx int, level int, title string, page int"), spark.createDataFrame(docs, "path string, title string").repartition(4), FOLDERS)
    assert sorted(map(tuple, got.collect()), key=repr) == by_entry(toc, docs)


def test_a_title_of_most_documents(spark):
    """A task sends on three rows of a key and folder, whatever it reads."""
    docs = spark.range(200_000).repartition(8).select(F.concat(F.when(F.col("id") % 2 == 0, "docs/").otherwise("x/"), F.col("id").cast("string"), F.lit(".md")).alias("path"), F.lit("Same").alias("title"))
    toc = spark.range(50).select(F.col("id").cast("int").alias("toc_idx"), F.lit(1).alias("level"), F.lit("1 Same").alias("title"), F.lit(1).alias("page"))
    out = contents.match(toc, docs.where("title is not null"), FOLDERS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    got = out.collect()
    assert len(got) == 150 and {(r.rank, r.path) for r in got} == {(1, "docs/0.md"), (2, "docs/2.md"), (3, "docs/4.md")}


def test_counts_of_nothing(spark):
    docs = spark.createDataFrame([("x/a.md", "# T\n"), ("y/a.md", "# T\nbody\n")], "path string, text string")
    toc = spark.createDataFrame([(0, 1, "T", 3), (1, 2, "no", 4)], "toc_idx int, level int, title string, page int")
    for t, n in ((toc, 2), (toc.limit(0), 0), (toc.where("toc_idx > 5"), 0)):
        for d, m in ((docs, 2), (docs.limit(0), 0), (docs.where("path = 'q'"), 0)):
            found, counts = jobs.matched(t, d)
            assert counts == {"toc_items": n, "md_files": m, "unmatched": min(n, 1) if m else n}
            assert jobs.duplicate_report(d)[1] == {"A": m // 2, "B": m // 2}
