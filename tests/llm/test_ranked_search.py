import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from folio.llm import ranked_search as rs
from tests.llm.cases import empty, rows, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every score of every document, sorted."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if score > 0:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, rank, i, s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10):
    return sorted(map(tuple, rs.search(docs, items, k).collect()), key=repr)


def made(rnd, n, words=40):
    vocabulary = [f"{'Aé9Ω'[i % 4]}{i}" for i in range(words)]
    return [(i * 2, " ".join(rnd.choices(vocabulary, [1 / (j + 1) for j in range(words)], k=rnd.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_the_best(seed):
    """One shard, without Spark: the tree's top k against every score."""
    rnd = random.Random(seed)
    docs = made(rnd, [1, 33, 200, 700][seed])
    texts = [t for _, t in docs]
    bags = [Counter(terms(t)) for t in texts]
    n, total = sum(map(bool, bags)), sum(sum(b.values()) for b in bags)
    tree = rs.Tree(rs.tree_of([i for i, _ in docs], texts, n, total))
    items = [(q, t) for q, t in made(rnd, 12)]
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in b for b in bags) + 1))) for b in bags for t in b}
    asked = [(q, weight[t], tree.at[t.encode()]) for q, (_, text) in enumerate(items) for t in sorted(set(terms(text))) if t in weight]
    best = rs.Best(len(items), 5)
    if asked:
        rs.search_tree(tree, *np.array(asked, np.int64).T, best)
    got = sorted(zip(best.item.tolist(), best.score.tolist(), best.doc.tolist(), strict=True))
    want = sorted((q, s, i) for q, _, i, s in brute(docs, [(q, t) for q, (_, t) in enumerate(items)], 5))
    assert got == want


def test_postings_stand_by_impact_and_by_document():
    rnd = random.Random(9)
    docs = made(rnd, 300)
    tree = rs.Tree(rs.tree_of([i for i, _ in docs], [t for _, t in docs], 300, 4000))
    for word, at in list(tree.at.items())[:20]:
        begin, df = int(tree.begin[at]), int(tree.df[at])
        run = tree.impact[0, begin : begin + df]
        assert (np.diff(run) <= 0).all()
        assert df == sum(word.decode() in terms(t) for _, t in docs)


def test_search_in_small_shards(spark, monkeypatch):
    monkeypatch.setattr(rs, "SHARD_DOCS", 50)
    monkeypatch.setattr(rs, "ITEM_BYTES", 300)
    rnd = random.Random(5)
    docs, items = made(rnd, 600), [(None if i == 3 else i % 15, t) for i, t in enumerate(t for _, t in made(rnd, 20))]
    docs += [docs[7]] * 40 + [(None, docs[7][1]), (None, docs[9][1])]
    got = found(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string").repartition(3))
    assert got == brute(docs, items)


def test_awkward_rows(spark):
    given = [(r[0], r[1]) for r in rows()]
    items = [(1, "the CAT sat, ünïcode"), (2, None), (3, "!?"), (4, "unheard of"), (5, given[6][1]), (6, "same same same"), (6, "apache LICENSE")]
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, score string, rank int")
    assert found(spark, table(spark), asked) == brute(given, items)
    assert found(spark, table(spark), asked, 1) == brute(given, items, 1)
    assert found(spark, empty(spark), asked) == []
    assert found(spark, table(spark), asked.limit(0)) == []
