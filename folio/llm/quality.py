"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote good, bad or nothing on a document. Their votes
on all documents are counted by pattern; expectation-maximisation over the patterns
estimates the labellers' accuracies, the share of good documents and a posterior for each
pattern. Bad documents differ in kind and show few faults each, so the bad class is a mixture
with a part for each labeller's kind of fault, which starts with the documents that this one accuses and
never holds one that it votes good; good ones start as those that none accuses. All other rates,
and all shares, are estimated.
A hashed linear scorer (logistic regression on hashed word and character-class features, with
squared weights as penalty) learns from the posteriors of all documents, copies included: their counts
are measured once and stored, each round is one scan of them that sums loss and gradient, and rounds go on to
the minimum, of which there is one. A bounded sample of texts (FIT_ROWS) only says where the rounds
start and how they scale their steps; scores are alike to about 2e-9 whichever texts these are. The score below which a document is rejected is the one
with the fewest expected errors on all documents, by their posteriors: sums along the sorted scores.

Defined results: a null, empty or blank text has no votes and no features; it scores 0 and
is rejected. Equal texts score equally. Every row gives a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.html_extract import STOP
from folio.llm.batches import lean
from folio.llm.shared import drop, stored, tidy
from folio.llm.textnum import U64, Words, byte_hashes, chunked, mix

GOOD, BAD, NONE = 1, -1, 0
LABELLERS = ("signs", "shouting", "bars", "stop_words", "exclaims", "repeats", "word_length", "letters", "runs")
#: Texts that the fit's start is taken from, at most; where it ends does not depend on them.
FIT_ROWS = 4000
WORD_FEATURES, CLASS_FEATURES = 512, 512
#: Shares of repeated lines, of words that repeat the one before, and of distinct words.
SHARES = 3
FEATURES = WORD_FEATURES + CLASS_FEATURES + SHARES
ROUNDS, STEPS = 60, 300
PENALTY = 1e-4
#: The fit ends when the next step would lower the loss by less than about half of this. Where it started then shows in scores by
#: about 2e-9 (by 4e-6 at 1e-12); rounded sums alone leave steps of less than 1e-24 on 256,410 documents.
TOLERANCE = 1e-18
#: Sums of tasks are in units of these, so that their order has no say.
UNIT, GAIN_UNIT = 2.0**-50, 2.0**-30
#: In place of a chance of nothing.
NEVER = 1e-12
# byte classes
LOWER, UPPER, DIGIT, BLANK, LINE, HIGH = range(6)
_CLASS = np.zeros(256, np.int64)
_CLASS[:] = LINE + 1
for _b in range(256):
    _CLASS[_b] = HIGH if _b >= 128 else LOWER if 97 <= _b <= 122 else UPPER if 65 <= _b <= 90 else DIGIT if 48 <= _b <= 57 else LINE if _b == 10 else BLANK if _b in (9, 11, 12, 13, 32) else 6 + _b
_CLASSES = 6 + 128
_SIGNS = [6 + b for b in b"#$%&*@^~<>{}[]\\=_+"]


def _hashes(words: list[str]) -> np.ndarray:
    w = Words([" ".join(words)])
    return np.sort(w.hash)


_STOP = _hashes(sorted(STOP))
_TRIM = np.zeros(256, bool)
_TRIM[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


class Counts:
    """What the scorer needs of a run of texts, in the form it is stored in: totals, and the counts of the hashed features that occur."""

    TOTALS = ("n_words", "n_bytes", "lines", "repeated", "same", "distinct")
    SCHEMA = ", ".join(f"{t} long" for t in TOTALS) + ", at binary, n binary"

    def __init__(self, totals: list[np.ndarray], each: np.ndarray, at: np.ndarray, n: np.ndarray):
        """each: how many features of each text occur; at and n: which they are, and how often."""
        self.totals, self.each, self.at, self.n = totals, each, at.astype(np.uint16), n.astype(np.uint32)
        n_words, n_bytes, lines, repeated, same, distinct = totals
        words = np.maximum(1, n_words)
        self.row = np.repeat(np.arange(len(each)), each)
        of = np.where(self.at < WORD_FEATURES, words[self.row], np.maximum(1, n_bytes)[self.row])
        # little text says little
        self.value = np.sqrt(self.n / of) * np.minimum(1, n_words / 20)[self.row]
        self.shares = np.stack((repeated / np.maximum(1, lines), same / words, distinct / words), axis=1)

    @classmethod
    def read(cls, b: pa.RecordBatch) -> Counts:
        """From columns that columns() made."""

        def flat(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
            column = b.column(name)
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            data = column.buffers()[2]
            return np.diff(ends) // np.dtype(kind).itemsize, np.frombuffer(data[int(ends[0]) : int(ends[-1])] if data else b"", kind)

        each, at = flat("at", np.uint16)
        return cls([b.column(t).to_numpy() for t in cls.TOTALS], each, at, flat("n", np.uint32)[1])

    def columns(self) -> list[pa.Array]:
        def rows(values: np.ndarray) -> pa.Array:
            ends = np.concatenate(([0], np.cumsum(self.each))) * values.itemsize
            return pa.Array.from_buffers(pa.binary(), len(self.each), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])

        return [*(pa.array(t.astype(np.int64)) for t in self.totals), rows(self.at), rows(self.n)]

    def logits(self, w: np.ndarray, b: float) -> np.ndarray:
        """x @ w + b for each text's features x; summed in one order, so that equal texts get equal sums."""
        z = np.bincount(self.row, self.value * w[self.at], len(self.each))
        for share, one in zip(self.shares.T, w[-SHARES:], strict=True):
            z = z + share * one
        return z + b

    def sums(self, by: np.ndarray) -> np.ndarray:
        """by @ x, for a number a text."""
        return np.concatenate((np.bincount(self.at, self.value * by[self.row], WORD_FEATURES + CLASS_FEATURES), by @ self.shares))

    def dense(self) -> np.ndarray:
        x = np.zeros((len(self.each), FEATURES))
        x[self.row, self.at] = self.value
        x[:, -SHARES:] = self.shares
        return x


class Measures:
    """Counts that the labellers and the scorer need, for a run of texts."""

    def __init__(self, texts: list[str]):
        words = Words(texts, lower=False)
        buf = np.frombuffer(words.raw, np.uint8)
        sizes = np.array([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        kind = _CLASS[buf]
        table = np.bincount(doc * _CLASSES + kind, minlength=len(texts) * _CLASSES).reshape(len(texts), _CLASSES)
        table[:, LINE] -= 1  # the separator
        self.table = table
        self.n_bytes = sizes - 1
        self.n_words = np.diff(words.first)
        low = Words(texts, lower=True)
        # trailing signs do not hide a stop word
        last = low.end - 1
        for _ in range(3):
            cut = (last > low.start) & _TRIM[low.buf[last]]
            last = last - cut
        bare = byte_hashes(low.raw, low.start, last + 1)
        at = np.minimum(np.searchsorted(_STOP, bare), len(_STOP) - 1)
        owner = np.repeat(np.arange(len(texts)), self.n_words)
        self.stop = np.bincount(owner, weights=_STOP[at] == bare, minlength=len(texts))
        # lines that occur before in their text
        cuts = np.flatnonzero(buf == 10)
        begin = np.concatenate(([0], cuts[:-1] + 1))
        of = doc[cuts]
        some = cuts > begin
        begin, cuts, of = begin[some], cuts[some], of[some]
        line = mix(byte_hashes(words.raw, begin, cuts) + of.astype(U64))
        first = np.zeros(len(line), bool)
        first[np.unique(line, return_index=True)[1]] = True
        self.lines = np.bincount(of, minlength=len(texts))
        self.repeated = np.bincount(of, weights=~first, minlength=len(texts))
        # pairs of neighbouring classes, and words as they stand in lower case
        pair = (kind[:-1] * 31 + kind[1:] * 977) % CLASS_FEATURES
        inner = np.ones(len(kind) - 1, bool)
        inner[ends[:-1] - 1] = False
        inner &= np.concatenate((np.ones(len(kind) - 2, bool), [False])) if len(kind) > 1 else inner
        pairs = np.bincount((doc[:-1] * CLASS_FEATURES + pair)[inner], minlength=len(texts) * CLASS_FEATURES).reshape(len(texts), CLASS_FEATURES)
        same = np.zeros(len(bare), bool)
        same[1:] = (bare[1:] == bare[:-1]) & (owner[1:] == owner[:-1])
        self.same = np.bincount(owner, weights=same, minlength=len(texts))
        new = np.zeros(len(bare), bool)
        new[np.unique(mix(bare + owner.astype(U64)), return_index=True)[1]] = True
        distinct = np.bincount(owner, weights=new, minlength=len(texts))
        word = (bare % U64(WORD_FEATURES)).astype(np.int64)
        counts = np.bincount(owner * WORD_FEATURES + word, minlength=len(texts) * WORD_FEATURES).reshape(len(texts), WORD_FEATURES)
        joint = np.concatenate((counts, pairs), axis=1)
        of, at = np.nonzero(joint)
        self.counts = Counts([self.n_words, self.n_bytes, self.lines, self.repeated, self.same, distinct], np.bincount(of, minlength=len(texts)), at, joint[of, at])

    def votes(self) -> np.ndarray:
        t, n, words = self.table, np.maximum(1, self.n_bytes), np.maximum(1, self.n_words)
        letters = t[:, [LOWER, UPPER, HIGH]].sum(axis=1)
        length = letters / words
        enough = self.n_words >= 20
        repeats = self.repeated / np.maximum(1, self.lines)
        stop = self.stop / words

        def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
            return np.where(bad, BAD, np.where(good, GOOD, NONE))

        signs, upper, bars, exclaims = t[:, _SIGNS].sum(axis=1) / n, t[:, UPPER] / np.maximum(1, letters), t[:, 6 + ord("|")] / words, t[:, 6 + ord("!")] / words
        out = np.stack(
            [
                vote(signs < 0.01, signs > 0.05),
                vote(upper < 0.2, upper > 0.5),
                vote(bars < 0.01, bars > 0.08),
                vote(enough & (stop >= 0.15), enough & (stop < 0.05)),
                vote(exclaims < 0.02, exclaims > 0.2),
                vote((self.lines > 3) & (repeats < 0.1), (self.lines > 3) & (repeats > 0.5)),
                vote((length > 2.5) & (length < 9), (length < 1.5) | (length > 14)),
                vote((letters + t[:, BLANK]) / n > 0.93, (letters + t[:, BLANK]) / n < 0.6),
                vote(enough & (self.same < 0.05 * words), enough & (self.same > 0.3 * words)),
            ],
            axis=1,
        )
        out[self.n_words == 0] = NONE
        return out


def pattern(votes: np.ndarray) -> np.ndarray:
    """Votes as one number, base 3."""
    return (votes + 1) @ 3 ** np.arange(votes.shape[1])


def estimate(patterns: dict[int, int], rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray, float]:
    """From counts by vote pattern: each pattern's posterior of good, the labellers' accuracies on (bad, good), the share of good.

    Class 0 is good; each other one is of a labeller's own kind of fault, to which this labeller never gives a good vote. Labellers are taken as independent in each class; an
    abstention says nothing. Each class has one vote more, split as the labeller's votes on all documents are, and one document more;
    this keeps rates off 0 and 1 and leaves small classes as sharp as large ones.
    """
    keys = np.array(sorted(patterns), np.int64)
    n = np.array([patterns[k] for k in keys.tolist()], np.float64)
    k = len(LABELLERS)
    outcome = keys[:, None] // 3 ** np.arange(k) % 3
    accused = outcome == 0
    own = np.flatnonzero(accused.any(axis=0))  # a labeller that accuses none has no class
    accused = accused[:, own]
    post = np.concatenate((~accused.any(axis=1, keepdims=True), accused / np.maximum(1, accused.sum(axis=1, keepdims=True))), axis=1)
    told = np.stack([n @ (outcome == o) for o in (0, 2)]) + 0.5
    told /= told.sum(axis=0)
    for _ in range(rounds):
        weight = n[:, None] * post
        share = (weight.sum(axis=0) + 1) / (n.sum() + post.shape[1])
        against, in_favour = (weight.T @ (outcome == o) + more for o, more in zip((0, 2), told, strict=True))
        rate = np.stack((against, np.ones_like(against) * (against + in_favour), in_favour), axis=2) / (against + in_favour)[:, :, None]
        rate[1 + np.arange(len(own)), own] = 1, 1, NEVER
        log = np.log(share) + np.log(rate[:, np.arange(k), outcome]).sum(axis=2).T
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
    on_bad = share[1:] @ rate[1:, :, 0] / max(1e-12, share[1:].sum())
    return dict(zip(keys.tolist(), post[:, 0].tolist(), strict=True)), np.stack([on_bad, rate[0, :, 2]], axis=1), float(share[0])


def class_weight(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A document's weight by its posterior of good, n documents each: those likely good weigh half of all, the others half."""
    share = np.where(good > 0.5, n[good > 0.5].sum(), n[good <= 0.5].sum()) / n.sum()
    return 0.5 / np.maximum(1e-9, share) / n.sum()


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by gradient steps with momentum; both classes weigh the same."""
    x = x.astype(np.float64)
    weight = class_weight(y, np.ones(len(y)))
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = weight * (p - y)
        vw = 0.9 * vw - 2.0 * (x.T @ g + PENALTY * w)
        vb = 0.9 * vb - 2.0 * g.sum()
        w, b = w + vw, b + vb
    return w, b


def curvature(x: np.ndarray, y: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """Second derivatives of the loss of fit() by weights and bias; the bias, which has no penalty, gets a slight one, so that there is an inverse."""
    p = 1 / (1 + np.exp(-(x @ w + b)))
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    return (x * (class_weight(y, np.ones(len(y))) * p * (1 - p))[:, None]).T @ x + np.diag(np.append(np.full(len(w), PENALTY), 1e-6))


def descend(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, metric: np.ndarray) -> np.ndarray:
    """Where a convex loss (value and gradient) is least, by limited-memory BFGS from x; metric: roughly the inverse of its second derivatives."""
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    value, slope = loss(x)
    while True:
        step, along = slope.copy(), []
        for s, y in reversed(pairs):
            along.append(s @ step / (s @ y))
            step -= along[-1] * y
        step = metric @ step
        for (s, y), a in zip(pairs, reversed(along), strict=True):
            step += s * (a - y @ step / (s @ y))
        fall = slope @ step
        if fall < TOLERANCE:
            return x
        size = 1.0
        while (got := loss(x - size * step))[0] > value - 1e-4 * size * fall + 1e-13:  # sums are rounded
            size /= 2
        pairs = [*pairs[-19:], (-size * step, got[1] - slope)]
        x, (value, slope) = x - size * step, got


class Run(NamedTuple):
    """A run of ascending scores. errors: what rejecting its first ones adds to the errors, at the least; below and above: the scores around that cut."""

    first: float
    total: int
    errors: int
    below: float
    above: float | None


def lowest(score: np.ndarray, gain: np.ndarray) -> Run:
    """The run of these scores, ascending and distinct; gain: good documents less bad ones at each, in units of GAIN_UNIT."""
    sums = np.cumsum(gain)
    k = int(np.argmin(sums))
    return Run(float(score[0]), int(sums[-1]), int(sums[k]), float(score[k]), float(score[k + 1]) if k + 1 < len(score) else None)


def joined(a: Run, b: Run) -> Run:
    """The run of a's scores and then b's."""
    if a.total + b.errors < a.errors:
        return Run(a.first, a.total + b.total, a.total + b.errors, b.below, b.above)
    return Run(a.first, a.total + b.total, a.errors, a.below, b.first if a.above is None else a.above)


def gains(good: np.ndarray) -> np.ndarray:
    return np.rint((2 * good - 1) / GAIN_UNIT).astype(np.int64)


def between(run: Run | None) -> float:
    """The least score to keep: half way between the scores around the cut, or 0 to keep all."""
    if run is None or run.errors >= 0:
        return 0.0
    if run.above is None:
        return float(np.nextafter(run.below, 2))
    half = (run.below + run.above) / 2
    return half if half > run.below else run.above


def cut(score: np.ndarray, good: np.ndarray) -> float:
    """The least score to keep, with the fewest expected errors by the posteriors of good; cut_of() is the same for a table."""
    # between equal scores there is no cut
    score, which = np.unique(score, return_inverse=True)
    gain = np.zeros(len(score), np.int64)
    np.add.at(gain, which, gains(good))
    return between(lowest(score, gain) if len(score) else None)


class Model:
    def __init__(self, weights: np.ndarray, bias: float, threshold: float, accuracy: np.ndarray, share: float):
        self.weights, self.bias, self.threshold, self.accuracy, self.share = weights, bias, threshold, accuracy, share

    def scores(self, counts: Counts) -> np.ndarray:
        return 1 / (1 + np.exp(-counts.logits(self.weights, self.bias)))


def measured(docs: DataFrame, text_col: str) -> DataFrame:
    """Vote pattern, hash and Counts of every document with words."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            for at, texts in chunked(b.column(0).to_pylist()):
                m = Measures(texts)
                out = [pa.array(pattern(m.votes()), pa.int32()), b.column(1).slice(at, len(texts)), *m.counts.columns()]
                yield pa.RecordBatch.from_arrays(out, names=["pattern", "h", *Counts.TOTALS, "at", "n"]).filter(pa.array(m.n_words > 0))

    return docs.select(text.alias("text"), F.xxhash64(text).alias("h")).mapInArrow(run, f"pattern int, h long, {Counts.SCHEMA}")


def fit_all(rows: DataFrame, start: np.ndarray, metric: np.ndarray, posterior: dict[int, float], patterns: dict[int, int]) -> np.ndarray:
    """Weights, and the bias as the last, with the least loss over all rows of measured(): a scan of them a round."""
    keys = np.array(sorted(patterns))
    good = np.array([posterior[k] for k in keys.tolist()])
    weight = class_weight(good, np.array([patterns[k] for k in keys.tolist()], np.float64))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(FEATURES + 2)  # by weights and bias, and the loss
            for b in lean(batches):
                at = np.searchsorted(keys, b.column("pattern").to_numpy())
                y, of, counts = good[at], weight[at], Counts.read(b)
                z = counts.logits(x[:-1], x[-1])
                by = of * (1 / (1 + np.exp(-z)) - y)
                sums += np.concatenate((counts.sums(by), [by.sum(), of @ (np.logaddexp(0, z) - y * z)]))
            # weights add up to 1: a loss of 8 is far above that of even odds, and no step is taken there
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(np.rint(np.minimum(sums, 8) / UNIT).astype(np.int64))], names=["k", "v"])

        with tidy(rows.sparkSession):
            got = rows.drop("h").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()  # FEATURES + 2 rows
        sums = np.zeros(FEATURES + 2)
        for r in got:
            sums[r.k] = r.v * UNIT
        w = np.append(x[:-1], 0.0)
        return float(sums[-1] + PENALTY / 2 * (w @ w)), sums[:-1] + PENALTY * w

    return descend(loss, start, metric)


def cut_of(rows: DataFrame, model: Model, posterior: dict[int, float]) -> float:
    """cut() over all rows of measured(): ranges of scores are runs, of which a task sends what joined() needs."""
    keys = np.array(sorted(posterior))
    gain = gains(np.array([posterior[k] for k in keys.tolist()]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.scores(Counts.read(b))), pa.array(gain[np.searchsorted(keys, b.column("pattern").to_numpy())])], names=["score", "gain"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [lowest(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if runs:
            yield pa.RecordBatch.from_pylist([reduce(joined, runs)._asdict()], schema=pa.schema([("first", pa.float64()), ("total", pa.int64()), ("errors", pa.int64()), ("below", pa.float64()), ("above", pa.float64())]))

    distinct = rows.drop("h").mapInArrow(score, "score double, gain long").groupBy("score").agg(F.sum("gain").alias("gain"))
    with tidy(rows.sparkSession):
        got = distinct.repartitionByRange("score").sortWithinPartitions("score").mapInArrow(run, "first double, total long, errors long, below double, above double").collect()  # one a range
    runs = sorted((Run(*r) for r in got), key=lambda r: r.first)
    return between(reduce(joined, runs) if runs else None)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Votes of all documents, EM over their patterns, and the scorer and its threshold fitted on all of them."""
    rows = stored(measured(docs, text_col), "measured")
    with tidy(docs.sparkSession):
        counted = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("texts")).collect()  # 3 ** labellers rows at most
    patterns = {r.pattern: r.n for r in counted}
    if not patterns:
        drop(rows)
        return Model(np.zeros(FEATURES), 0.0, 0.0, np.zeros((len(LABELLERS), 2)), 0.5)
    posterior, accuracy, share = estimate(patterns)

    # where to start: the texts with the lowest hashes, of equal ones one; a threshold that about twice as many texts pass leaves little to sort
    part = min(1.0, 2 * FIT_ROWS / sum(r.texts for r in counted))
    low = rows.where(F.col("h") <= int(-(2**63) + part * (2**64 - 1) if part < 1 else 2**63 - 1))
    with tidy(docs.sparkSession):
        some = low.dropDuplicates(["h"]).orderBy("h").limit(FIT_ROWS).toArrow().combine_chunks().to_batches()
    x = np.concatenate([np.zeros((0, FEATURES)), *(Counts.read(b).dense() for b in some)])
    y = np.array([posterior[p] for b in some for p in b.column("pattern").to_pylist()])
    w, b = fit(x, y)
    fitted = fit_all(rows, np.append(w, b), np.linalg.inv(curvature(x, y, w, b)), posterior, patterns)

    model = Model(fitted[:-1], float(fitted[-1]), 0.0, accuracy, share)
    model.threshold = cut_of(rows, model, posterior)
    drop(rows)
    return model


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """id, votes_good, votes_bad, score (0 to 1) and keep (has words, and the score reaches the threshold) for every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = model.value.threshold if threshold is None else threshold
        for b in lean(batches):
            for at, texts in chunked([t or "" for t in b.column(1).to_pylist()]):
                m = Measures(texts)
                votes = m.votes()
                score = np.where(m.n_words > 0, model.value.scores(m.counts), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array((votes == GOOD).sum(axis=1), pa.int32()), pa.array((votes == BAD).sum(axis=1), pa.int32()), pa.array(score, pa.float64()), pa.array((m.n_words > 0) & (score >= least))],
                    names=[id_col, "votes_good", "votes_bad", "score", "keep"],
                )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, votes_good int, votes_bad int, score double, keep boolean")


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """The rows of docs that classify() keeps, with all their columns. Narrow."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = model.value.threshold if threshold is None else threshold
        for b in lean(batches):
            keep = [np.zeros(0, bool)]
            for _, texts in chunked([t or "" for t in b.column(at_text).to_pylist()]):
                m = Measures(texts)
                keep.append((m.n_words > 0) & (model.value.scores(m.counts) >= least))
            yield b.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
