import hashlib
import os
import random

import pytest

from folio.llm import bpe
from folio.llm.queries import tokenizer_path
from tests.llm.cases import empty, rows, table

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def both():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_path()), bpe.ByteBPE(tokenizer_path())


def test_same_ids_as_the_library(both):
    theirs, ours = both
    rnd = random.Random(3)
    parts = ["'", "s", "'re", "'LL", " ", "  ", "\n", "\t", "a", "Bc", "é", "12", "!", "　", "\xa0", "日本", "<|endoftext|>", "aaaa", "\x1c", "\x85", "😀", "​"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + ["", "<|endoftext|>", "x" * 3000]
    for t, want, got in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), ours.encode_batch(texts), strict=True):
        assert want.ids == got.tolist(), t
        assert ours.decode(got) == theirs.decode(want.ids, skip_special_tokens=False) == t


def test_classes_of_all_code_points(both):
    theirs, ours = both
    texts = [f"a{chr(c)}1 {chr(c)}" for c in [*range(0x3100), *range(0xA000, 0xA900, 3), *range(0xE000, 0x20000, 37)]]
    for t, want, got in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), ours.encode_batch(texts), strict=True):
        assert want.ids == got.tolist(), hex(ord(t[1]))


def test_a_full_cache_changes_nothing(both, monkeypatch):
    theirs, ours = both
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    texts = ["some more words than five", "and again some more words", "x y z"]
    assert [x.tolist() for x in ours.encode_batch(texts)] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_tables(spark, both):
    got = sorted(bpe.digest(table(spark), tokenizer_path()).collect(), key=repr)
    want = []
    for r in rows():
        ids = both[0].encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert [tuple(r) for r in got] == sorted(want, key=lambda w: repr(w) and str(next(g for g in got if tuple(g) == w)))
    out = bpe.encode_decode(table(spark), tokenizer_path()).collect()
    assert sorted(r.decoded for r in out) == sorted(r[1] or "" for r in rows())
    assert bpe.digest(empty(spark), tokenizer_path()).count() == 0
