import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from folio.llm import near_dedup, substring_dedup
from folio.llm.components import components
from tests.llm.cases import SCHEMA, empty, rows, table

WORD = r"[^\x20\x09-\x0D]+"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(t):
    return re.findall(WORD, t or "")


def removed(texts, window):
    n = Counter(tuple(w[i : i + window]) for w in map(words, texts) for i in range(len(w) - window + 1))
    out = []
    for w in map(words, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if n[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def by_id(rs):
    return sorted(rs, key=repr)


@pytest.mark.parametrize("window", [3, 8, 35])
def test_substrings(spark, window):
    docs = rows()
    want = []
    for r, gone in zip(docs, removed([r[1] for r in docs], window), strict=True):
        kept = " ".join(w for w, g in zip(words(r[1]), gone) if not g)
        want.append((r[0], len(gone), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in substring_dedup.remove_recurring(table(spark), window, digest=True).collect()]
    assert by_id(got) == by_id(want)


def test_substring_texts_and_rewrite(spark):
    docs = rows()
    gone = removed([r[1] for r in docs], 35)
    want = [r if not any(g) else (*r[:1], t := " ".join(w for w, x in zip(words(r[1]), g) if not x), *r[2:4], len(t), *r[5:]) for r, g in zip(docs, gone, strict=True)]
    got = substring_dedup.rewrite(table(spark))
    assert got.columns == table(spark).columns
    assert by_id(map(tuple, got.collect())) == by_id(want)
    assert substring_dedup.rewrite(empty(spark)).count() == substring_dedup.remove_recurring(empty(spark)).count() == 0


def test_a_common_passage_in_many_contexts(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HEAVY_BLOCKS", 5)
    monkeypatch.setattr(substring_dedup, "SHARD_BLOCKS", 7)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [f"{' '.join(f'a{k}x{i}' for i in range(10))} {common} {' '.join(f'b{k}x{i}' for i in range(10))}" for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_recurring(df, 10).collect()}
    assert got == dict.fromkeys(range(60), 12)


def sets(texts, width=5):
    out = []
    for t in texts:
        w = words((t or "").translate(LOWER))
        out.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def near(ids, texts, percent):
    found = sets(texts)
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(found[i] & found[j])
            if found[i] and found[j] and 100 * both >= percent * (len(found[i]) + len(found[j]) - both):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        least[root(i)].append(x)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(x, len(found[i]), low[root(i)], x == low[root(i)]) for i, x in enumerate(ids)]


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_near_duplicates(spark, percent):
    docs = rows()
    got = [tuple(r) for r in near_dedup.near_duplicates(table(spark), percent=percent).collect()]
    assert by_id(got) == by_id(near([r[0] for r in docs], [r[1] for r in docs], percent))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    # most pairs lie just below or above the threshold, so stars alone leave components apart
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    import random

    rnd = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _k in range(120):
        w = list(base)
        for i in rnd.sample(range(150), rnd.randint(0, 9)):
            w[i] = f"e{rnd.randint(0, 30)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(df, percent=85).collect())
    assert got == sorted(near(list(range(120)), texts, 85))


def test_small_sets(spark):
    """Texts of a few shingles fill few bins: none of their links is lost."""
    import random

    rnd, texts = random.Random(8), []
    for k in range(60):
        w = [f"k{k}w{i}" for i in range(rnd.randint(1, 40))]
        texts += [" ".join(w), " ".join([*w, "more"]), " ".join(w[: max(1, len(w) - 1)]), " ".join(["first", *w])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(df, percent=85).collect())
    assert got == sorted(near(list(range(len(texts))), texts, 85))


def test_keep_one(spark):
    got = near_dedup.keep_one(table(spark))
    assert got.columns == table(spark).columns
    docs = rows()
    kept = [tuple(r) for r in got.collect()]
    texts = Counter(r[1] for r in kept)
    assert texts[docs[6][1]] <= 1 and texts[None] == 2
    # every document that went has a kept one that it is joined with
    parts = near(list(range(len(docs))), [r[1] for r in docs], 80)
    want = {p[2] for p, r in zip(parts, docs) if words(r[1])}
    assert len([r for r in kept if words(r[1])]) == len(want)
    assert near_dedup.keep_one(empty(spark)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:900], rng.integers(0, 2**63, 100, dtype=np.uint64))))
    both = np.intersect1d(a, b).size
    sig = near_dedup.signatures([a, b, a[:3], a[:3].copy()])
    assert abs((sig[0] == sig[1]).mean() - both / (len(a) + len(b) - both)) < 0.12
    assert (sig[2] == sig[3]).all()


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(5, 5), (1, 3), (3, 1), (2, 4), (4, 6)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in components(df).collect()} == {x: root(x) for x in linked}


def test_schema_is_as_given():
    assert SCHEMA.startswith("doc_id long, text string")
