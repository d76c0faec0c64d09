import hashlib
import random

import numpy as np
import pytest

from folio.llm import clustering
from folio.llm.clustering import Centroids, integers

SCHEMA = "vec_id long, embedding array<double>, cluster string, id int, v double"


def brute(vectors, clusters, rounds, size):
    """The same rounds with Python's integers, one vector and one centroid at a time."""
    kept = [(i, [int(x * 256 // 1) if abs(x) < 2**45 else int(x) * 256 for x in v]) for i, v in vectors if v is not None and len(v) == size and all(x is not None and x == x and abs(x) != float("inf") for x in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in seeds[:clusters]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((dist(v, c), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for k in range(len(cents)):
            mine = [v for (_, v), c in zip(kept, of, strict=True) if c == k]
            if mine:
                cents[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    ends = [nearest(v) for _, v in kept]
    inertia = [sum(d for d, c in ends if c == k) for k in range(len(cents))]
    long = lambda x: x if x < 2**63 else None
    return sorted(((i, k, long(d), long(inertia[k]), long(sum(inertia)), hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()) for (i, _), (d, k) in zip(kept, ends, strict=True)), key=repr)


def result(spark, vectors, clusters=4, rounds=5, size=3, parts=3):
    df = spark.createDataFrame([(i, v, "x", 0, 0.0) for i, v in vectors], SCHEMA).repartition(parts)
    return sorted(map(tuple, clustering.cluster(df, clusters, rounds, size).collect()), key=repr)


def test_awkward_rows(spark):
    rnd = random.Random(1)
    vectors = [(i, [rnd.gauss(i % 3, 0.3) for _ in range(3)]) for i in range(60)]
    vectors += [vectors[5]] * 40 + [(None, [0.1, 0.2, 0.3]), (1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]), (6, [float("-inf"), 1.0, 2.0]), (7, [1.0] * 4)]
    got = result(spark, vectors)
    assert got == brute(vectors, 4, 5, 3)
    assert len(got) == 101
    assert got == result(spark, vectors, parts=1)


def test_fewer_vectors_than_clusters_and_none(spark):
    few = [(1, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (2, [0.0, 0.0, 0.0])]
    assert result(spark, few) == brute(few, 4, 5, 3)
    assert result(spark, [(1, None)]) == []
    assert result(spark, []) == []


@pytest.mark.parametrize("scale", [2.0**18, 2.0**24, 1e18, 1e150])
def test_large_components(spark, scale):
    rnd = random.Random(2)
    vectors = [(i, [rnd.gauss(0, 1) * (scale if i % 4 == 0 else 1.0) for _ in range(3)]) for i in range(40)]
    got = result(spark, vectors)
    assert got == brute(vectors, 4, 5, 3)
    assert (scale < 2.0**20) == (got[0][4] is not None)


def test_product_at_the_bound_and_ties():
    rnd = np.random.default_rng(4)
    for most in (1 << 10, 1 << 22, 1 << 23, 1 << 26, 1 << 30, 1 << 40):
        cents = rnd.integers(-most, most, (9, 64)).tolist()
        cents.append(cents[2])
        x = np.vstack([rnd.integers(-most, most, (50, 64)).astype(np.float64), np.array(cents, np.float64)])
        which, far = Centroids(cents).nearest(x)
        for row, k, d in zip(x.tolist(), which.tolist(), far.tolist(), strict=True):
            every = [sum((int(a) - b) ** 2 for a, b in zip(row, c, strict=True)) for c in cents]
            assert (d, k) == (min(every), every.index(min(every)))


def test_integers():
    assert integers(np.array([[0.1, -0.1, 1.0]]), 256).tolist() == [[25.0, -26.0, 256.0]]
    assert integers(np.array([[1e308, -0.1]]), 256).tolist() == [[int(1e308) * 256, -26]]
