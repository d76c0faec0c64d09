"""Equal hashes must not make unequal words equal."""

import numpy as np
import pytest
import tokenizers

from folio.llm import bpe, lm_score, near_dedup, quality, substring_dedup
from folio.llm.queries import tokenizer_path
from folio.llm.textnum import Words, byte_hashes, numbered, span_hashes


def twins(steps: int) -> list[str]:
    """The Thue-Morse word of 2 ** steps letters and its complement: any polynomial modulo a power of two gives them one hash."""
    bits = [0]
    for _ in range(steps):
        bits += [1 - b for b in bits]
    return ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]


@pytest.mark.parametrize("steps", [3, 5, 6, 10, 12])
def test_twins_have_two_hashes(steps):
    a, b = twins(steps)
    w = Words([a, b, a])
    assert w.hash[0] != w.hash[1] and w.hash[0] == w.hash[2] and w.other[0] != w.other[1] and w.hash[0] != w.other[0]
    x = np.array([[3 if c == "a" else 7 for c in t] for t in (a, b, a)], np.uint64)
    at = np.arange(3) * len(a)
    h = span_hashes(x.reshape(-1), at, at + len(a))
    assert h[0] != h[1] and h[0] == h[2]


def test_byte_hashes_see_bytes_and_length_only():
    data = b"abcdefgh\0\0abcdefgh\0abcdefghi" + b"z" * 200
    start, end = np.array([0, 10, 0, 10, 0, 19, 28, 29, 28]), np.array([8, 18, 9, 19, 10, 28, 28, 129, 129])
    h = byte_hashes(data, start, end)
    assert h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 7


def test_numbered_compares_slices():
    data = np.frombuffer(b"ab cd ab ef cd", np.uint8)
    start, end = np.arange(0, 15, 3), np.arange(2, 15, 3)
    _, first, which = numbered(np.zeros(5, np.uint64), data, start, end)
    words = [bytes(data[a:b]) for a, b in zip(start, end)]
    assert all(words[first[k]] == w for k, w in zip(which, words))


def test_tokens_of_twins(monkeypatch):
    own = tokenizers.Tokenizer.from_file(tokenizer_path())
    a, b = twins(12)
    texts = [a, b, f"{a} {b}", *" ".join(twins(5)).split(" "), "the cat sat on the mat"]
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in bpe.ByteBPE(tokenizer_path()).encode_batch(texts)] == want
    # and with hashes that say next to nothing, cached or not
    monkeypatch.setattr(bpe, "byte_hashes", lambda *x: byte_hashes(*x) % np.uint64(3))
    poor = bpe.ByteBPE(tokenizer_path())
    for _ in range(2):
        assert [x.tolist() for x in poor.encode_batch(texts)] == want


def test_passages_with_twins(spark):
    a, b = twins(10)
    rest = [f"w{i}" for i in range(34)]
    df = spark.createDataFrame([(1, " ".join([a, *rest])), (2, " ".join([b, *rest])), (3, " ".join([*rest, a])), (4, " ".join([*rest, a]))], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_recurring(df, 35).collect()}
    assert got == {1: 0, 2: 0, 3: 35, 4: 35}


def test_windows_are_judged_by_words(monkeypatch):
    monkeypatch.setattr(substring_dedup, "span_hashes", lambda v, s, e: span_hashes(v, s, e) % np.uint64(2))
    segments = [b"a b c d", b"x a b c", b"p q r", b"s t u v"]
    assert substring_dedup.locate(segments, np.array([1, 1, 1, 2]), 3) == [[0], [1], [], [0, 1]]


def test_sets_of_twins(spark):
    a, b = twins(10)
    df = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, percent=85).collect()} == {1: 1, 2: 2, 3: 1}


def test_counts_and_features_of_twins():
    a, b = twins(10)
    u = lm_score.Unit([a, b, a], np.zeros(3, bool))
    assert len(np.unique(u.token)) == 3
    m = quality.Measures([f"{a} {b}", f"{a} {a}"])
    assert m.same.tolist() == [0, 1]
