import hashlib
import re

import pytest
from pyspark.sql import functions as F

from folio.llm import fingerprint
from tests.llm.cases import empty, rows, table


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(text):
    """The same tree in plain Python."""
    sections = []
    for line in text.split("\n"):
        leaves = [sha(x) for x in re.findall(r"[^ ]*(?: +[^ ]+){0,5} *", line) if x]
        digest = sha("".join(leaves))
        if not sections or digest[0] in "08":
            sections.append([])
        sections[-1].append((digest, ";" + digest[:8] + "".join(f".{x[:8]}" for x in leaves)))
    found = [(sha("".join(d for d, _ in part)), "".join(p for _, p in part)) for part in sections]
    return sha("".join(d for d, _ in found)) + "".join(f"/{d[:8]}{p}" for d, p in found)


def likeness(a, b):
    if a[:64] == b[:64]:
        return 1.0
    x, y = (set(re.findall(r"\.([0-9a-f]{8})", s)) for s in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def expected(docs):
    def h(t):
        return t

    order = sorted({(r[0], r[1] or "") for r in docs}, key=lambda p: (p[0] is None, -(p[0] or 0)))
    after = {p: order[(i + 1) % len(order)] for i, p in enumerate(order)}
    out = []
    for r in docs:
        t = h(r[1] or "")
        n = after[r[0], t][1]
        k = len(t) // 3
        e = t[: len(t) - k] + n[:k]
        a, b, c = plain(t), plain(e), plain(n)
        out.append((r[0], len(t), sha(e), a, b, likeness(a, b), likeness(a, c), after[r[0], t][0], len(n)))
    return out


def test_with_next(spark):
    # ids that repeat with other texts have an order by hash, which is left out here
    docs = [r for r in rows() if r[0] is not None] + [rows()[-1]]
    df = spark.createDataFrame(docs, table(spark).schema).repartition(3)
    got = sorted((tuple(r) for r in fingerprint.with_next(df).collect()), key=repr)
    want = sorted(expected(docs), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:7] == pytest.approx(w[5:7]) and g[7:] == w[7:]


def test_cases(spark):
    assert fingerprint.with_next(table(spark)).count() == len(rows())
    assert fingerprint.with_next(empty(spark)).count() == 0
    one = fingerprint.with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == sha("abcdab") and one.near_next == 1.0


def test_no_python_in_the_plan(spark):
    plan = fingerprint.with_next(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_differing_sections(spark):
    lines = [f"line {i} of the text" for i in range(60)]
    a = "\n".join(lines)
    edits = [a.replace("line 17", "LINE 17"), "\n".join([*lines[:30], "a new line", *lines[30:]]), "\n".join(lines[:40] + lines[41:]), a, ""]
    df = spark.createDataFrame([(a, b) for b in edits], "a string, b string").select(fingerprint.fingerprint(F.col("a")).alias("x"), fingerprint.fingerprint(F.col("b")).alias("y"))
    got = [r[0] for r in df.select(fingerprint.differing(F.col("x"), F.col("y"))).collect()]
    n = plain(a).count("/")
    assert n > 3 and got[3] == [] and got[4] == list(range(n))
    # an edit is found in its section, or where it moves a border in the two beside it
    assert all(1 <= len(g) <= 2 for g in got[:3])


def test_paragraphs_are_over_leaves(spark):
    text = "one two three four five six seven eight\n\nlast  line "
    got = spark.createDataFrame([(text,)], "t string").select(fingerprint.fingerprint(F.col("t"))).first()[0]
    leaves = ["one two three four five six ", "seven eight", "last  line "]
    assert got == plain(text) and re.findall(r"\.([0-9a-f]{8})", got) == [sha(x)[:8] for x in leaves]
