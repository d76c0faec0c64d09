import random
import zlib
from collections import defaultdict
from math import ceil

from folio.llm import bpe, packing
from folio.llm.queries import tokenizer_path
from tests.llm.cases import empty, rows, table


def test_pack(spark):
    got = packing.pack(table(spark), tokenizer_path(), capacity=256).collect()
    ours = bpe.load(tokenizer_path())
    want = []
    for r in rows():
        ids = [*next(ours.encode_batch([r[1] or ""])).tolist(), 2]
        head = len(ids) % 256 or 256
        cuts = [0, *range(head, len(ids) + 1, 256)]
        want += [(r[0], k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(g)[:5] for g in got), key=repr) == sorted(want, key=repr)
    by = defaultdict(list)
    for g in got:
        by[g.sequence_id].append((g.offset, g.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= ceil(sum(w[3] for w in want) / 256) + 1
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_genetic_steps_keep_every_item_once():
    rnd = random.Random(5)
    size = [rnd.randint(1, 100) for _ in range(400)]
    a, b = packing.seed_packing(size, 100, rnd, 0.0), packing.seed_packing(size, 100, rnd, 0.3)
    child = packing.crossover(a, b, rnd)
    for p in (a, b, child, packing.evolve([a, b, child], rnd)):
        assert sorted(i for x in p.bins for i in x) == list(range(400))
        assert all(100 - sum(size[i] for i in x) == f >= 0 for x, f in zip(p.bins, p.free))
    assert packing.evolve([a, b], rnd).fitness() <= min(a.fitness(), b.fitness())
    again = packing.from_labels(size, 100, child.labels())
    assert again.fitness() == child.fitness()


def triplets(rnd, n):
    """Items that fill n bins of 1000 by threes, in no order."""
    out = []
    for _ in range(n):
        a = rnd.randint(380, 490)
        b = rnd.randint(200, 1000 - a - 200)
        out += [a, b, 1000 - a - b]
    rnd.shuffle(out)
    return out


def test_evolution_beats_its_seeds():
    better = 0
    for k in range(6):
        rnd = random.Random(k)
        size = triplets(rnd, 80)
        seeds = [packing.seed_packing(size, 1000, rnd, 0.02 * j) for j in range(4)]
        least = min(len(x.bins) for x in seeds)
        got = packing.evolve(seeds, rnd, generations=30)
        assert sorted(i for x in got.bins for i in x) == list(range(240)) and all(sum(size[i] for i in x) <= 1000 for x in got.bins)
        assert len(got.bins) <= least
        better += len(got.bins) < least
    assert better >= 5


def test_refill_fills_better():
    bins, loose = packing.refill([[0, 1], [2]], [3, 4], [40, 30, 90, 55, 35], 100)
    assert sorted(sum(bins, loose)) == [0, 1, 2, 3, 4] and bins[0] == [3, 0]


def test_packed_bins_are_not_lost(spark):
    rnd, items = random.Random(3), []
    for k in range(60):
        a, b = sorted(rnd.sample(range(1, 1000), 2))
        items += [(3 * k + i, n, 0, k, 0) for i, n in enumerate((a, b - a, 1000 - b))]
    pool = spark.createDataFrame(items, "row long, length long, group long, bin long, free long")
    for groups in (1, 3):
        got = packing._evolve_groups(pool, groups, 1000).collect()
        assert sorted(r.row for r in got) == list(range(180))
        assert len({(r.group, r.bin) for r in got}) == 60


def test_copies_of_one_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 20)
    df = spark.createDataFrame([(1, "the same text again and again")] * 200 + [(2, "another")], "doc_id long, text string")
    got = packing.pack(df, tokenizer_path(), capacity=64).collect()
    assert len(got) == 201 and len({r.sequence_id for r in got}) <= ceil(sum(r.length for r in got) / 64) + 12


def test_no_items():
    assert packing.evolve([packing.Bins([], 10)], random.Random(1)).bins == []
