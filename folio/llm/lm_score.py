"""Language-model scores by a weighted backoff automaton over n-grams of up to ORDER words.

Training counts cover every training document. Documents are packed to units of some
megabytes; a unit asks once for each distinct word and word pair it holds, with its own
training counts. Questions are dealt to shards by hash; a shard adds up the counts of all
units and answers each unit with totals, in the order of its questions, so an answer is
little more than a byte a question. Then it asks, level by level, for the longer n-grams
whose two parts also occur in other units' training texts; of the others it knows the total. A
unit thus gets the part of the model that its documents can use, however large the model
grows; nothing of it is broadcast.

The automaton of a unit has a state for each n-gram of up to ORDER - 1 words seen in
training (the start counts as a word), and the root. An n-gram h w is an arc from state h by
w, of weight (1 - l) c(h w) / c(h) + l P(w | h without its first word), to the longest state
that ends in w; a failure arc of weight l leads from h to h without its first word, at last
to the root, whose arcs have the base weights p(w) = (c + 0.5) / (N + 0.5 (V + 1)). l depends on the
level and on c(h): for each power of two it is the share of training n-grams that occur once, so
would be new if left out, among contexts of that count; at most MAX_BUCKETS numbers a
level, taken over all training data. One traversal from left to right carries the state, follows
arcs or fails, and adds up logarithms. After ORDER - 1 words the state no longer depends on
where the walk began, so long texts are walked in runs that begin as many words early, and
all runs of a unit step together.

Rows of questions are one for each unit and shard at most, and no more than distinct n-grams of the
units, so they grow with the input.

Defined results: a null text is an empty one, whose only token is the end. Each row is
scored, repeated rows too; a null id is held out or not by the checksum of the empty
string. Without training documents N and V are 0. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from folio.llm.shared import stored, tidy
from folio.llm.textnum import U64, Words, chunked, expand, mix

#: Characters of a unit, and of a unit's text for each shard's share.
UNIT_CHARS, SHARD_CHARS = 6 << 20, 8 << 20
MAX_BUCKETS = 64
ORDER = 3
#: Tokens of a run of the traversal, and units of a task.
RUN, TASK_UNITS = 256, 8
END, START = U64(0x9AE16A3B2F90404F), U64(0xC949D7C7509E6557)
FOLDS, HELD_OUT = 5, 1


def held_out(ids: pd.Series) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % FOLDS == HELD_OUT for i in ids], bool)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, a place of each, and for every number its own among them; in less time than np.unique, which keeps the order of equal ones."""
    order = np.argsort(x)
    ranked = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    which = np.empty(len(x), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


class Level:
    """The n-grams of one length in a unit: sorted distinct hashes, a place of each, and for each token its own number, or -1."""

    def __init__(self, grams: np.ndarray, valid: np.ndarray, train: np.ndarray):
        at = np.flatnonzero(valid)
        self.keys, some, which = distinct(grams[at])
        self.first = at[some]
        self.number = np.full(len(grams), -1)
        self.number[at] = which
        self.own = np.bincount(which[train[at]], minlength=len(self.keys)) if len(at) else np.zeros(0, np.int64)
        self.total = self.own.astype(np.int64)

    def of_tokens(self, values: np.ndarray) -> np.ndarray:
        """A value of each n-gram for the token that ends it; 0 where there is none."""
        return np.append(values, 0)[self.number]


class Unit:
    """Tokens of a unit's texts by hash, the document of each, and the n-grams that end there by level."""

    def __init__(self, texts: list[str], out: np.ndarray, order: int = ORDER):
        # hashed in smaller runs, whose arrays over bytes are short-lived
        hashes, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for _, run in chunked(texts):
            words = Words(run, lower=True)
            hashes.append(words.hash)
            counts.append(np.diff(words.first))
        n, flat = np.concatenate(counts), np.concatenate(hashes)
        ends = np.cumsum(n) + np.arange(len(n))
        self.size = n + 1
        self.token = np.full(len(flat) + len(n), END)
        inner = np.ones(len(self.token), bool)
        inner[ends] = False
        self.token[inner] = flat
        self.doc = np.repeat(np.arange(len(n)), self.size)
        self.place = np.arange(len(self.token)) - (ends - n)[self.doc]
        self.train = ~out[self.doc]
        self.train_docs = int((~out).sum())
        self.grams = [self.token]
        self.levels = [Level(self.token, np.ones(len(self.token), bool), self.train)]
        self.starts = 0  # training documents everywhere
        for _ in range(order - 1):
            self._longer()

    def _longer(self) -> None:
        m, last = len(self.levels), self.grams[-1]
        before = np.concatenate(([START], last[:-1]))
        if m == 1:
            before[self.place == 0] = START
        self.grams.append(mix(mix(before + U64(m)) + self.token))
        self.levels.append(Level(self.grams[-1], self.place >= m - 1, self.train))

    def contexts(self, m: int) -> np.ndarray:
        """The training count of what stands before each token in its n-gram of level m (from 1)."""
        got = np.concatenate(([0], self.levels[m - 1].of_tokens(self.levels[m - 1].total)[:-1]))
        if m == 1:
            got[self.place == 0] = self.starts
        return got

    def asked(self, phase: int) -> list[np.ndarray]:
        """For each level that a phase asks for, the numbers of n-grams: words and pairs at first, then the next level's that others may know."""
        if phase == 0:
            return [np.arange(len(x.keys)) for x in self.levels[:2]]
        low = self.levels[phase]
        shared = low.of_tokens((low.total > low.own).astype(np.int64)) > 0
        high = self.levels[phase + 1]
        return [np.flatnonzero(shared[high.first] & shared[high.first - 1])]

    def questions(self, phase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, own training counts, and whether each is a word."""
        which = self.asked(phase)
        levels = self.levels[:2] if phase == 0 else [self.levels[phase + 1]]
        keys, own = np.concatenate([x.keys[w] for x, w in zip(levels, which)]), np.concatenate([x.own[w] for x, w in zip(levels, which)])
        word = np.zeros(len(keys), bool)
        if phase == 0:
            word[: len(which[0])] = True
            keys, own, word = np.append(keys, START), np.append(own, self.train_docs), np.append(word, False)
        order = np.argsort(keys, kind="stable")
        return keys[order], own[order], word[order]

    def learn(self, phase: int, totals: np.ndarray) -> None:
        """Take in the totals of a phase, in the order of its questions."""
        which = self.asked(phase)
        levels = self.levels[:2] if phase == 0 else [self.levels[phase + 1]]
        keys = [x.keys[w] for x, w in zip(levels, which)] + ([np.array([START])] if phase == 0 else [])
        back = np.empty(len(totals), np.int64)
        back[np.argsort(np.concatenate(keys), kind="stable")] = totals
        for x, w, part in zip(levels, which, np.split(back, np.cumsum([len(w) for w in which]))):
            x.total[w] = part
        if phase == 0:
            self.starts = int(back[-1])


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _pack(x: np.ndarray) -> bytes:
    """Numbers from 0 on in the narrowest type that holds them, whose width comes first."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    return bytes([kind.itemsize]) + _press(x.astype(kind))


def _unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x[1:]), f"<u{x[0]}").astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their steps, byte by byte: the upper bytes of small steps are zeros."""
    steps = np.diff(keys, prepend=U64(0))
    return _press(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_keys(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).reshape(-1), dtype=U64)


def units_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(unit, n_chars, body): ids and texts of about UNIT_CHARS characters, compressed as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            body = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([body], pa.binary())], names=["n_chars", "body"])

        rows: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            long = np.cumsum([len(t or "") for t in b.column(1).to_pylist()])
            at = 0
            while at < b.num_rows:
                base = int(long[at - 1]) if at else 0
                stop = min(b.num_rows, max(at + 1, int(np.searchsorted(long, base + UNIT_CHARS - size, "right"))))
                rows.append(b.slice(at, stop - at))
                size += int(long[stop - 1]) - base
                at = stop
                if size >= UNIT_CHARS or at < b.num_rows:
                    yield packed()
                    rows, size = [], 0
        if rows:
            yield packed()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "n_chars long, body binary").withColumn("unit", F.monotonically_increasing_id())


def _opened(body: bytes) -> tuple[pa.Array, list[str], np.ndarray]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all().combine_chunks()
    ids = table.column(0).combine_chunks()
    return ids, [t or "" for t in table.column(1).to_pylist()], held_out(ids.to_pylist())


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys of each shard begin, and the end: shards are ranges of hashes."""
    shard = ((keys >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
    return np.searchsorted(shard, np.arange(shards + 1))


def _asking(unit: int, u: Unit, phase: int, shards: int) -> dict[str, list]:
    keys, own, word = u.questions(phase)
    cuts = _cuts(keys, shards)
    some = np.flatnonzero(np.diff(cuts))
    parts = [(k, slice(cuts[k], cuts[k + 1])) for k in some.tolist()]
    # the lowest bit tells words from the rest
    return {"shard": [k for k, _ in parts], "unit": [unit] * len(parts), "keys": [_pack_keys(keys[x]) for _, x in parts], "counts": [_pack(own[x] << 1 | word[x]) for _, x in parts]}


QUESTIONS = "shard long, unit long, keys binary, counts binary"


def ask(units: DataFrame, shards: int, order: int = ORDER) -> DataFrame:
    """(shard, unit, keys, counts) of each unit's first questions: its words and pairs, with its own training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for unit, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, texts, out = _opened(body)
                rows = _asking(unit, Unit(texts, out, 2), 0, shards)
                yield pa.RecordBatch.from_arrays([pa.array(rows["shard"], pa.int64()), pa.array(rows["unit"], pa.int64()), pa.array(rows["keys"], pa.binary()), pa.array(rows["counts"], pa.binary())], names=list(rows))

    return units.select("unit", "body").mapInArrow(run, QUESTIONS)


def answer(questions: DataFrame, shards: int) -> DataFrame:
    """(shard, unit, totals, tokens, kinds): totals in the order of the unit's keys; once a shard, its token and word-type counts."""

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack_keys(k) for k in pdf["keys"]]
        own = np.concatenate([_unpack(c) for c in pdf["counts"]])
        every, _, place = distinct(np.concatenate(keys))
        sums = np.zeros(len(every), np.int64)
        np.add.at(sums, place, own >> 1)
        words = np.zeros(len(every), bool)
        words[place[own & 1 == 1]] = True
        parts = np.split(sums[place], np.cumsum([len(k) for k in keys])[:-1])
        tokens, kinds = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        tokens[0], kinds[0] = sums[words].sum(), (sums[words] > 0).sum()
        return pd.DataFrame({"shard": pdf.shard, "unit": pdf.unit, "totals": [_pack(p) for p in parts], "tokens": tokens, "kinds": kinds})

    return _dealt(questions, "shard", shards).applyInPandas(total, "shard long, unit long, totals binary, tokens long, kinds long")


def _dealt(rows: DataFrame, key: str, groups: int) -> GroupedData:
    """rows by key, in as many tasks as its groups need: what a task reads stays the same as the input grows."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-groups // TASK_UNITS)), key).groupBy(key)


class Automaton:
    """A unit's part of the model. State 0 is the root, 1 the start; then the n-grams of each level but the last that training knows."""

    def __init__(self, u: Unit, tokens: int, kinds: int, backoff: np.ndarray):
        words = u.levels[0]
        self.words = len(words.keys)
        self.root = np.log10((words.total + 0.5) / (tokens + 0.5 * (kinds + 1)))
        # states of each level's n-grams
        state, size = [], 2
        for x in u.levels[:-1]:
            known = x.total > 0
            state.append(np.where(known, size + np.cumsum(known) - 1, 0))
            size += int(known.sum())
        self.target = state[0]
        self.fail, self.fall = np.zeros(size, np.int64), np.zeros(size)
        self.fall[1] = np.log10(backoff[0][bucket(np.array([u.starts]))[0]])
        keys, weights, targets = [], [], []
        lower, chance = state[0], 10.0**self.root
        for m in range(1, len(u.levels)):
            x, below = u.levels[m], u.levels[m - 1]
            got = np.flatnonzero(x.total > 0)
            at = x.first[got]
            count = u.contexts(m)[at]
            begin = lower[below.number[at - 1]]
            if m == 1:
                begin = np.where(u.place[at] == 0, 1, begin)
            fall = backoff[m - 1][bucket(count)]
            p = (1 - fall) * x.total[got] / count + fall * chance[below.number[at]]
            to = state[m][got] if m < len(state) else state[m - 1][below.number[at]]
            keys.append(begin * self.words + words.number[at])
            weights.append(np.log10(p))
            targets.append(to)
            # the states of the level before fail to those without their first word
            known = np.flatnonzero(below.total > 0)
            self.fall[lower[known]] = np.log10(backoff[m - 1][bucket(below.total[known])])
            if m > 1:
                two = u.levels[m - 2]
                self.fail[lower[known]] = state[m - 2][two.number[below.first[known]]]
            if m < len(state):
                lower, chance = state[m], np.zeros(len(x.keys))
                chance[got] = p
        key = np.concatenate(keys)
        order = np.argsort(key)
        self.arcs, self.weight, self.to = key[order], np.concatenate(weights)[order], np.concatenate(targets)[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and log10 weights of a word from each state, by its arc or by failure arcs until there is one."""
        now, weight, to = state.copy(), np.zeros(len(state)), np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            here = now[left]
            at_root = here == 0
            some = left[at_root]
            weight[some] += self.root[word[some]]
            to[some] = self.target[word[some]]
            left, here = left[~at_root], here[~at_root]
            key = here * self.words + word[left]
            ranked = np.argsort(key)  # neighbours in the table are looked for together
            left, key = left[ranked], key[ranked]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[arc] == key if len(self.arcs) else np.zeros(len(key), bool)
            some, taken = left[hit], arc[hit]
            weight[some] += self.weight[taken]
            to[some] = self.to[taken]
            left = left[~hit]
            weight[left] += self.fall[now[left]]
            now[left] = self.fail[now[left]]
        return to, weight

    def traverse(self, u: Unit) -> np.ndarray:
        """The log10 weight of each token on the walk through its text."""
        word, early = u.levels[0].number, len(u.levels) - 1
        per_doc = -(-u.size // RUN)
        doc_at = np.cumsum(u.size) - u.size
        start = np.repeat(doc_at, per_doc) + RUN * expand(np.zeros(len(per_doc), np.int64), per_doc)
        stop = np.minimum(start + RUN, np.repeat(doc_at + u.size, per_doc))
        begin = np.maximum(start - early, np.repeat(doc_at, per_doc))
        order = np.argsort(begin - stop, kind="stable")
        start, stop, at = start[order], stop[order], begin[order]
        state = (u.place[at] == 0).astype(np.int64)  # the start, or the root
        out = np.zeros(len(u.token))
        live = len(at)
        while live:
            at, state, start = at[:live], state[:live], start[:live]
            state, weight = self.step(state, word[at])
            sure = at >= start
            out[at[sure]] = weight[sure]
            at = at + 1
            live = int((at < stop[:live]).sum())
        return out


def bucket(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every text."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    units = stored(units_of(docs, id_col, text_col), "units")
    n_units, chars = units.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_chars"), F.lit(0))).first()
    shards = max(1, -(-chars // SHARD_CHARS))
    answers = [stored(answer(ask(units, shards, order), shards), "answers")]
    tokens, kinds = (int(x) for x in answers[0].agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first())

    def told(pdf: pd.DataFrame, levels: int) -> tuple[pa.Array, np.ndarray, Unit]:
        ids, texts, out = _opened(pdf.body.dropna().iloc[0])
        u = Unit(texts, out, levels)
        for phase, got in pdf[pdf.totals.notna()].groupby("phase", sort=True):
            u.learn(phase, np.concatenate([_unpack(t) for t in got.sort_values("shard").totals]))
        return ids, out, u

    def grouped() -> GroupedData:
        rows = units.select("unit", "body", F.lit(-1).alias("phase"), F.lit(-1).cast("long").alias("shard"), F.lit(None).cast("binary").alias("totals"))
        for phase, got in enumerate(answers):
            rows = rows.unionByName(got.select("unit", F.lit(None).cast("binary").alias("body"), F.lit(phase).alias("phase"), "shard", "totals"))
        return _dealt(rows, "unit", n_units)

    def asking(phase: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda pdf: pd.DataFrame(_asking(int(pdf.unit.iat[0]), told(pdf, phase + 2)[2], phase, shards))

    for phase in range(1, order - 1):
        answers.append(stored(answer(grouped().applyInPandas(asking(phase), QUESTIONS), shards), "answers"))

    def novelty(pdf: pd.DataFrame) -> pd.DataFrame:
        u = told(pdf, order)[2]
        parts = []
        for m in range(1, order):
            x = u.levels[m]
            at = u.train & (x.number >= 0)
            of = bucket(u.contexts(m)[at])
            once = np.bincount(of, weights=x.of_tokens(x.total)[at] == 1, minlength=MAX_BUCKETS).astype(np.int64)
            parts.append(pd.DataFrame({"level": m, "of": np.arange(MAX_BUCKETS), "once": once, "n": np.bincount(of, minlength=MAX_BUCKETS)}))
        return pd.concat(parts)

    backoff = np.full((order, MAX_BUCKETS), 0.5)
    with tidy(spark):
        rates = grouped().applyInPandas(novelty, "level int, of int, once long, n long").groupBy("level", "of").agg(F.sum("once"), F.sum("n")).collect()
    for level, of, once, n in rates:
        # one more of either kind keeps it inside 0 and 1
        backoff[level - 1, of] = (once + 1) / (n + 2)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, out, u = told(pdf, order)
        model = Automaton(u, tokens, kinds, backoff)
        full, word = model.traverse(u), u.levels[0].number
        first = np.cumsum(u.size) - u.size
        return pd.DataFrame(
            {
                id_col: pd.Series(ids.to_pylist(), dtype="Int64" if kind in ("bigint", "int") else "object"),
                "held_out": out,
                "n_tokens": u.size.astype(np.int64),
                "n_known": np.add.reduceat((u.levels[0].total[word] > 0).astype(np.int64), first),
                "train_tokens": np.int64(tokens),
                "base_score": np.add.reduceat(model.root[word], first),
                "score": np.add.reduceat(full, first),
            }
        )

    return grouped().applyInPandas(run, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
