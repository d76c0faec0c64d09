import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction
from math import floor

from folio.llm import mixing
from tests.llm.cases import empty, rows, table


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shared_out(totals, weights=(3, 1, 2)):
    """Targets by the rule as it is told: share, stop at the limit, share the excess anew."""
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got = {s: Fraction(0) for s in order}
    left, open_ = Fraction(3 * sum(totals.values()), 2), set(order)
    while left > 0 and open_:
        unit = left / sum(weight[s] for s in open_)
        for s in open_:
            got[s] += unit * weight[s]
        left = Fraction(0)
        for s in list(open_):
            if got[s] >= 2 * totals[s]:
                left += got[s] - 2 * totals[s]
                got[s] = Fraction(2 * totals[s])
                open_.remove(s)
    return got


def brute(docs):
    """(id, source, size, source size, target, taken) by sorting and summing copies in plain Python."""
    parts = defaultdict(list)
    for i, t, s in docs:
        parts[s].append((i, size(t)))
    totals = {s: sum(n for _, n in p) for s, p in parts.items()}
    goal = shared_out(totals)
    out = []
    for s, p in parts.items():
        units = floor(min(float(goal[s]) / totals[s], 2.0) * 2**24) if totals[s] else 0
        at = int(hashlib.md5(f"11:{'' if s is None else '=' + s}".encode()).hexdigest()[:6], 16)
        for i, n in sorted(p, key=lambda x: (x[1], x[0] is not None, x[0] or 0)):
            copies = ((at + units) >> 24) - (at >> 24)
            at += units
            out.append((i, s, n, totals[s], round(float(goal[s]), 6), copies * n))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(df).collect()), key=repr)


def test_awkward_rows(spark):
    given = [(r[0], r[1], r[3]) for r in rows()]
    assert result(table(spark)) == brute(given)
    assert mixing.mix(empty(spark)).collect() == []


def test_many_sources_and_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 64)
    rnd = random.Random(3)
    docs = [(i, " ".join("w" * rnd.randint(0, int(rnd.paretovariate(1)) % 400)), rnd.choice(["hot", "hot", *"abcdefgh", "ü", "Z", "\U0001f600", None])) for i in range(900)]
    docs += [(1, "a b c", "hot")] * 200 + [(None, None, "only nulls"), (5, "", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = result(df.repartition(5))
    assert got == brute(docs)
    assert got == result(df.repartition(2))
    taken, goal, most = defaultdict(int), {}, defaultdict(int)
    for i, s, n, total, target, t in got:
        taken[s] += t
        goal[s] = target
        most[s] = max(most[s], n)
        assert t <= 2 * n
    for s in taken:
        assert abs(taken[s] - goal[s]) <= 2 * most[s] + 1


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_numbers_within_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    df = spark.createDataFrame([(g, x) for g in "ab" for x in range(50)], "g string, x int").repartition(4)
    got = mixing.numbered(df, 100, ["g", "x"], ["g"]).collect()
    assert sorted((r.g, r.x, r.place) for r in got) == [(g, x, x + 1) for g in "ab" for x in range(50)]
