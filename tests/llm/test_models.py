import functools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import html_extract, license_scan, lm_score, quality
from tests.llm.cases import empty, rows, table

SF = "/root/testdata/sf0.01"
LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None]


def brute(docs, order):
    """(held_out, n_tokens, n_known, N, base, score) for each (id, text): probabilities by the recursion itself."""
    texts = [["<start>", *tokens(t)] for _, t in docs]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    c = Counter()
    for t, h in zip(texts, out):
        for i in range(1, len(t)) if not h else ():
            c.update(tuple(t[i - m : i + 1]) for m in range(min(order, i + 1)))
    n, v = sum(k for g, k in c.items() if len(g) == 1), sum(len(g) == 1 for g in c)
    c["<start>",] = len(docs) - sum(out)
    once, all_ = Counter(), Counter()
    for g, k in c.items():
        if len(g) > 1:
            b = len(g), c[g[:-1]].bit_length()
            all_[b] += k
            once[b] += k == 1

    def base(w):
        return ((c[w,] if w != "<start>" else 0) + 0.5) / (n + 0.5 * (v + 1))

    def p(g):
        if len(g) == 1:
            return base(g[0])
        k = c[g[:-1]]
        if not k:
            return p(g[1:])
        b = len(g), k.bit_length()
        rate = (once[b] + 1) / (all_[b] + 2) if all_[b] else 0.5
        return (1 - rate) * c[g] / k + rate * p(g[1:])

    for t, h in zip(texts, out):
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1) : i + 1]))) for i in range(1, len(t)))
        yield h, len(t) - 1, sum(c[w,] > 0 for w in t[1:]), n, sum(math.log10(base(w)) for w in t[1:]), score


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores(spark, monkeypatch, order):
    monkeypatch.setattr(lm_score, "SHARD_CHARS", 20_000)
    monkeypatch.setattr(lm_score, "UNIT_CHARS", 9_000)
    docs = [(r[0], r[1]) for r in rows()]
    got = sorted(lm_score.score(table(spark), order=order).collect(), key=lambda r: (repr(r.doc_id), r.n_tokens))
    want = sorted(((i, *b) for (i, _), b in zip(docs, brute(docs, order), strict=True)), key=lambda r: (repr(r[0]), r[2]))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9) and g.score == pytest.approx(w[6], rel=1e-9)
    assert lm_score.score(empty(spark)).count() == 0


def test_scores_beat_the_base_on_held_out_documents(spark):
    r = lm_score.score(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").selectExpr("sum(base_score) as base", "sum(score) as score").first()
    assert r.score > 0.95 * r.base


def test_quality_on_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = quality.classify(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    n = {(r.quality, r.keep): r["count"] for r in got.groupBy("quality", "keep").count().collect()}
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.9
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.98
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == quality.classify(docs).where("keep").count()


def test_quality_sample_of_copies(spark, monkeypatch):
    fitted, fit = [], quality.fit
    monkeypatch.setattr(quality, "FIT_ROWS", 60)
    monkeypatch.setattr(quality, "fit", lambda x, y: fitted.append(len(x)) or fit(x, y))
    # 200 texts in 4,000 rows
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('the house of the king number ', id % 200, ' is in a land') as text")
    quality.train(docs)
    assert fitted == [60]


def test_quality_cases(spark):
    got = {(r.doc_id, r.score) for r in quality.classify(table(spark)).collect()}
    assert len(quality.classify(table(spark)).collect()) == len(rows())
    assert (0, 0.0) in got and (3, 0.0) in got
    assert quality.classify(empty(spark)).count() == quality.keep_good(empty(spark)).count() == 0
    assert all(words.strip() for words in (r.text for r in quality.keep_good(table(spark)).collect()))


def test_estimate_finds_accuracies():
    import random

    rnd = random.Random(2)
    k = len(quality.LABELLERS)
    counts, truth = Counter(), Counter()
    for _ in range(4000):
        good = rnd.random() < 0.8
        fault = rnd.randrange(k)
        # a bad document shows one fault or two, a good one none
        votes = [1 if good or i != fault and rnd.random() < 0.8 else -1 for i in range(k)]
        key = sum((v + 1) * 3**i for i, v in enumerate(votes))
        counts[key] += 1
        truth[key] += good
    post, accuracy, share = quality.estimate(counts)
    right = sum(truth[p] if q > 0.5 else counts[p] - truth[p] for p, q in post.items())
    assert right > 0.97 * 4000 and abs(share - 0.8) < 0.05 and (accuracy[:, 1] > 0.95).all()


def test_estimate_against_loops():
    import random

    rnd = random.Random(5)
    k = len(quality.LABELLERS)
    counts = Counter(sum(rnd.choice((0, 1, 2, 2, 2, 2)) * 3**i for i in range(k)) for _ in range(300))
    votes = {p: [p // 3**i % 3 for i in range(k)] for p in counts}
    post = {p: [0.0 if 0 in v else 1.0, *((x == 0) / max(1, v.count(0)) for x in v)] for p, v in votes.items()}
    told = []
    for i in range(k):
        no, yes = (sum(n for p, n in counts.items() if votes[p][i] == o) + 0.5 for o in (0, 2))
        told.append({0: no / (no + yes), 2: yes / (no + yes)})
    for _ in range(7):
        share = [(sum(n * post[p][c] for p, n in counts.items()) + 1) / (sum(counts.values()) + k + 1) for c in range(k + 1)]
        rate = []
        for c in range(k + 1):
            one = []
            for i in range(k):
                no, yes = (sum(n * post[p][c] for p, n in counts.items() if votes[p][i] == o) + told[i][o] for o in (0, 2))
                one.append({0: no / (no + yes), 1: 1.0, 2: yes / (no + yes)} if c != i + 1 else {0: 1.0, 1: 1.0, 2: quality.NEVER})
            rate.append(one)
        for p, v in votes.items():
            joint = [share[c] * math.prod(rate[c][i][x] for i, x in enumerate(v)) for c in range(k + 1)]
            post[p] = [j / sum(joint) for j in joint]
    got, accuracy, good = quality.estimate(counts, 7)
    assert got == pytest.approx({p: x[0] for p, x in post.items()}, abs=1e-9) and good == pytest.approx(share[0])
    on_bad = [sum(share[c] * rate[c][i][0] for c in range(1, k + 1)) / sum(share[1:]) for i in range(k)]
    assert accuracy[:, 0] == pytest.approx(on_bad) and accuracy[:, 1] == pytest.approx([rate[0][i][2] for i in range(k)])


def test_cut_has_the_fewest_errors():
    import random

    rnd = random.Random(1)
    for _ in range(50):
        score = np.array([rnd.choice((0.1, 0.2, 0.3, 0.4, 0.5)) for _ in range(12)])
        good = np.array([rnd.random() for _ in range(12)])
        least = quality.cut(score, good)
        errors = lambda t: sum(g if s < t else 1 - g for s, g in zip(score, good))
        assert errors(least) == pytest.approx(min(map(errors, (0, 0.15, 0.25, 0.35, 0.45, 0.6))))
    assert quality.cut(np.array([0.2, 0.3]), np.array([1.0, 1.0])) == 0.0 and quality.cut(np.array([0.2]), np.array([0.0])) > 0.2


def test_quality_is_fitted_on_all_documents(spark, monkeypatch):
    """Weights and threshold are those of the whole table, wherever the fit starts: held against Newton's method on all rows at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(30))  # copies count
    texts = [t for t in ((r.text or "") for r in docs.select("text").collect()) if t.strip()]
    measures = quality.Measures(texts)
    seen = quality.pattern(measures.votes()).tolist()
    posterior, _, _ = quality.estimate(Counter(seen))
    y = np.array([posterior[p] for p in seen])
    x = np.concatenate((measures.counts.dense(), np.ones((len(y), 1))), axis=1)
    weight = np.where(y > 0.5, 0.5 / (y > 0.5).sum(), 0.5 / (y <= 0.5).sum())
    penalty = np.append(np.full(quality.FEATURES, 1e-4), 0)
    w = np.zeros(len(penalty))
    for _ in range(15):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (p - y)) + penalty * w)
    want = 1 / (1 + np.exp(-x @ w))
    for rows in (60, 4000):
        monkeypatch.setattr(quality, "FIT_ROWS", rows)
        model = quality.train(docs)
        got = model.scores(measures.counts)
        assert np.abs(got - want).max() < 1e-4
        assert model.threshold == pytest.approx(quality.cut(got, y), abs=1e-12)


def test_quality_start_has_no_say(spark, monkeypatch):
    """Scores are those of the one minimum over all documents: texts that the fit starts from don't show in them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = quality.Measures([r.text or "" for r in docs.select("text").collect()]).counts
    models = []
    for rows in (300, 4000):
        monkeypatch.setattr(quality, "FIT_ROWS", rows)
        models.append(quality.train(docs))
    a, b = models
    assert np.abs(a.scores(counts) - b.scores(counts)).max() < 1e-8
    assert a.threshold == pytest.approx(b.threshold, abs=1e-8)


def test_counts_as_stored():
    texts = ["the cat  sat\n\nthe cat sat\n", "", "a" * 70_000 + " b", "é! é! x"]
    counts = quality.Measures(texts).counts
    b = pa.RecordBatch.from_arrays(counts.columns(), names=[*quality.Counts.TOTALS, "at", "n"])
    w = np.random.default_rng(1).normal(size=quality.FEATURES)
    z = counts.logits(w, 0.5)
    assert z == pytest.approx(counts.dense() @ w + 0.5) and counts.sums(z) == pytest.approx(z @ counts.dense())
    for part in (b, b.slice(1, 2), b.slice(3), b.slice(0, 0)):
        read = quality.Counts.read(part)
        at = [b.column("n_bytes").to_pylist().index(n) for n in part.column("n_bytes").to_pylist()]
        assert (read.dense() == counts.dense()[at]).all() and (read.logits(w, 0.5) == z[at]).all()


def test_cut_in_runs():
    rnd = np.random.default_rng(3)
    for _ in range(100):
        score = np.sort(rnd.choice(1000, 12, replace=False) / 1000)
        good = rnd.random(12)
        ends = [0, *sorted({int(e) for e in rnd.integers(1, 12, 3)}), 12]
        runs = [quality.lowest(score[a:b], quality.gains(good[a:b])) for a, b in zip(ends, ends[1:])]
        assert quality.between(functools.reduce(quality.joined, runs)) == quality.cut(score, good)
    assert quality.cut(np.zeros(0), np.zeros(0)) == 0.0


@pytest.fixture(scope="module")
def model():
    return license_scan.fit()


def family(model, text):
    """The same classification in plain Python."""
    line = text.lower()
    grams = set(license_scan.grams_of(line)) & set(model.weights)
    z = [(b + sum(model.weights[g][k] for g in grams)) / model.temperature for k, b in enumerate(model.bias)]
    top = max(z)
    p = 1 / sum(math.exp(v - top) for v in z)
    name = model.classes[z.index(top)]
    templates = [set(license_scan.grams_of(t)) for t in license_scan.TEMPLATES.get(name, ())]
    return name if p >= license_scan.MIN_PROBABILITY and any(len(t & grams) >= license_scan.MIN_TEMPLATE * len(t) for t in templates) else "unknown", p


def test_licences(spark, model):
    lines = [(t, k) for k, ts in license_scan.TEMPLATES.items() for t in ts] + [(t, "unknown") for t in ("", "the licence of the work", "Permission to use", "a public library in the city", "the software license version", "nothing here")]
    df = spark.createDataFrame([(i, f"first\n\nx {t} y\nlast") for i, (t, _) in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(df, model=model).collect()}
    for i, (t, k) in enumerate(lines):
        assert [(m.paragraph, m.family) for m in got[i].matches] == ([(2, k)] if k != "unknown" else []), t
        name, p = family(model, f"x {t} y")
        assert name == k
        assert got[i].matches == [] or got[i].matches[0].probability == pytest.approx(p, rel=1e-6)
    for k in (0, 1):
        plan = license_scan.scan(df, model=model)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_lines_that_are_passed_over_cannot_match(model):
    words = set(model.words)
    for family in license_scan.TEMPLATES:
        for t in license_scan.TEMPLATES[family]:
            grams = set(license_scan.grams_of(t))
            slight = [g for g in grams if not words & set(g.split())]
            assert len(slight) < license_scan.MIN_TEMPLATE * len(grams), t
        for t in license_scan.TITLES[family]:
            assert any(words & set(g.split()) for g in license_scan.grams_of(t)), t


def test_licence_cases(spark, model):
    got = license_scan.scan(table(spark), model=model).collect()
    assert len(got) == len(rows())
    assert sorted(m.family for r in got for m in r.matches) == ["apache-2.0"]
    assert {r.n_paragraphs for r in got if r.doc_id in (0, 3)} == {0}
    assert license_scan.summary(empty(spark)).count() == 0


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
WRAPPED = [
    (
        """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
        [(0, "mit"), (4, "mit")],
    ),
    (
        """a first line
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# a last line""",
        [(1, "gpl")],
    ),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation", [(0, "lgpl")]),
    (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
        [(0, "bsd")],
    ),
    (
        "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        [(0, "apache-2.0")],
    ),
    ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International\nLicense.", [(0, "cc-by-nc")]),
    ("// SPDX-License-Identifier: MIT", [(0, "mit")]),
    ("/* SPDX-License-Identifier: GPL-3.0-or-later */", [(0, "gpl")]),
    ("# SPDX-License-Identifier: LGPL-2.1-only", [(0, "lgpl")]),
    ("# SPDX-License-Identifier: Apache-2.0", [(0, "apache-2.0")]),
    ("# SPDX-License-Identifier: CC-BY-SA-4.0", [(0, "cc-by-sa")]),
    ("# SPDX-License-Identifier: BSD-3-Clause", [(0, "bsd")]),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", [(0, "gpl")]),
    ("The MIT License (MIT)", [(0, "mit")]),
    (
        "This program is free software: you can redistribute it and/or modify it under\nthe terms of the GNU Affero General Public License as published by the\nFree Software Foundation, either version 3 of the License, or later.",
        [(1, "agpl")],  # the line that names it says enough alone
    ),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", [(0, "cc-by-nd")]),
    ("Licensed under CC BY-ND 4.0", [(0, "cc-by-nd")]),
    ("Licensed under CC BY-NC-SA 4.0", [(0, "cc-by-nc-sa")]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", [(0, "isc")]),
    ("# SPDX-License-Identifier: AGPL-3.0-only", [(0, "agpl")]),
    ("The licence fee is paid by the public, and the rights of the software firm are protected by law.", []),
    ("Permission was granted to a person who dealt in copies of rare documentation.", []),
    ("Free commons near the foundation, general works on the program of the year.", []),
    ("Permission is hereby granted, free of charge, to any person\n\nobtaining a book of the public library", []),
    ("mit dem Wort\nlicense und version", []),
    (f"{MIT_TEXT}\nand now for something else\n{MIT_TEXT}", [(0, "mit"), (7, "mit")]),
    (f"{MIT_TEXT}\n{MIT_TEXT}\n\n{MIT_TEXT}", [(0, "mit"), (6, "mit"), (13, "mit")]),
    ("\n".join(MIT_TEXT.split()[:60]), [(0, "mit")]),
    ("This file is not released under the MIT License.", []),
    ("It is not licensed under the Apache License.", []),
    ("We considered the MIT License but did not choose it.", []),
    ("Works under the GNU Affero General Public License may be combined with it.", []),
    ("Unlike the Mozilla Public License it asks for nothing.", []),
    ("the software of a public library\nis free of charge for any person\nand the law of the work", []),
]


def test_wrapped_licences(spark, model):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WRAPPED)], "doc_id long, text string")
    got = {r.doc_id: [(m.paragraph, m.family) for m in r.matches] for r in license_scan.scan(df, model=model).collect()}
    assert got == {i: want for i, (_, want) in enumerate(WRAPPED)}


def test_licences_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.families for r in license_scan.summary(docs).collect()}
    for r in docs.collect():
        want = {k for k, v in {"apache-2.0": "Apache License, Version 2.0", "mit": "MIT License", "gpl": "GNU General Public", "cc-by-nc": "CC BY-NC"}.items() if v in r.text}
        assert got[r.doc_id] == ",".join(sorted(want))


PAGES = [
    ("<nav><a href=a>Home</a></nav><article><h1>T &amp; U</h1><p>One\n two<br>three<p>Four</article><footer>&copy; x</footer>", "T & U\nOne two three\nFour"),
    ("<script>var a='<p>no</p>'</script><main><p>Yes<!-- no --> it is</p><aside>no</aside><div class='comments'>no</div></main>", "Yes it is"),
    ("<article><p class='ad'>no<p>yes</article>", "yes"),
    ("<ul><li><a href=x>one</a><li><a href=y>two</a></ul>", ""),
    ("<p>" + "the house of the king and the queen is in a land that was not on the map and " * 2 + "</p><p>So it is.</p><form><p>name</p></form>", " ".join(("the house of the king and the queen is in a land that was not on the map and " * 2).split()) + "\nSo it is."),
    ("<article>a &lt;b&gt; &am &#x41;&nbsp;c 1 < 2</article>", "a <b> &am A c 1 < 2"),
    ("<article>x<!-- never closed <p>y</article>", "x"),
    ("<article><header><h1>Head</h1><p>by line</p></header><p>Body.</p></article>", "Head\nBody."),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html_extract.extract(page) == text


INLINE = [
    ("<article><p>One.</p>It is <span class='share'>3</span> old.<p>Two.</p><p>Three.</p></article>", "One.\nIt is 3 old.\nTwo.\nThree."),
    ("<article><p>One <strong class='alert'>now</strong>.<p>Two.<div>Three.</div></article>", "One now.\nTwo.\nThree."),
    ("<article><div><span class='comment'>Note</span> that.</div>Bare.</article>", "Note that.\nBare."),
    ("<article><div><span class='share'>no</span></div>Yes.<p class='ad'>no</p>Bare.</article>", "Yes.\nBare."),
    ("<article><p class='ad'>no <span>no</span> no <b>no</b></p>Yes.</article>", "Yes."),
    ("<article><div><span class='share'><span>no</span> no</span></div><p>Yes.</p></article>", "Yes."),
    ("<article><b class='alert'><p>no</b>no</p>Yes.</article>", "Yes."),
    ("<article><p>Yes<button><div>no</div></button> it is</p></article>", "Yes\nit is"),
]


@pytest.mark.parametrize(("page", "text"), INLINE)
def test_inline_elements(page, text):
    assert html_extract.extract(page) == text


PROSE = ("the house of the king and the queen is in a land that was not on the map and " * 2).strip()
WRAPPERS = [
    ("<div class='layout no-sidebar'><article><p>One.</p></article></div>", "One."),
    ("<div class='has-header page'><p>" + PROSE + "</p><div class='ad'>no</div></div>", PROSE),
    ("<main><div class='with-sidebar'><p>One.</p></div></main>", "One."),
    ("<form><div class='page header'><nav><a href=x>no</a></nav><article><h1>H</h1><p>One.</p><div class='comments'>no</div></article><footer>no</footer></div></form>", "H\nOne."),
    ("<form><p>" + PROSE + "</p><div class='ad'>" + PROSE[:90] + "</div><nav>no</nav><ul><li><a href=x>no</a></ul></form>", PROSE),
    ("<form><div class='header'><p>" + PROSE + "</p></div></form>", PROSE),
    ("<main><div class='sidebar-left'><a href=x>no no</a></div><div class='text-left share-right'>Yes.</div></main>", "Yes."),
    # still furniture
    ("<article>Yes.</article><div class='comments'><article><p>" + PROSE + "</p></article></div>", "Yes."),
    ("<main>Yes.<div id='comments'><article class='c'>" + PROSE + "</article></div></main>", "Yes."),
    ("<article>Yes.</article><aside><article>no</article></aside><footer><main>no</main></footer>", "Yes."),
    ("<article>Yes.</article><div class='related'><article>no</article></div>", "Yes."),
    ("<p>" + PROSE + "</p><form><p>" + PROSE + "</p><p>" + PROSE + "</p></form>", PROSE),
    ("<form><p>Name</p><p>Word</p></form>", ""),
]


@pytest.mark.parametrize(("page", "text"), WRAPPERS)
def test_wrappers(page, text):
    assert html_extract.extract(page) == text


JA = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。吾輩はここで始めて人間というものを見た。"
RU = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме Облонских. Жена узнала, что муж был в связи с бывшею в их доме француженкою, и объявила мужу, что не может жить с ним в одном доме."
NO_TAGS = [
    *((f"<nav><a href=x>no</a></nav><div><p>{t}</p><p>{t[:30].strip()}</p><ul><li><a href=y>{t[:20]}</a></ul></div><div class='cookie-notice'>{t}</div>", f"{t}\n{t[:30].strip()}") for t in (JA, RU, PROSE, "der die das und ist in den von zu " * 7 + "Ende.", "le chat est dans la maison et les enfants sont avec elle " * 4 + "oui.", "el perro y los niños que no se fueron en la casa de su abuela " * 4 + "fin.")),
    ("<div><p>Yes, it is so.</p></div>", "Yes, it is so."),
    ("<div><p>Short.</p><ul><li><a href=x>no</a></ul></div><footer>no</footer>", "Short."),
    ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>", "So x=1 holds."),
    ("<article><p class='notice-board'>Kept.</p><p class='site-notice'>no</p><div class='search-results'>Found.</div><div class='post-footer'>no</div></article>", "Kept.\nFound."),
    ("<article><h1>T</h1><p>One.</p><h2>Comments (3)</h2><p>no</p><h3>no</h3><p>no</p><h2>More</h2><p>Two.</p></article>", "T\nOne.\nMore\nTwo."),
    ("<article><h1>Comments</h1><p>On comments.</p></article>", "Comments\nOn comments."),
]


@pytest.mark.parametrize(("page", "text"), NO_TAGS)
def test_pages_in_six_languages_and_short_ones(page, text):
    assert html_extract.extract(page) == text


def test_second_pass():
    assert html_extract.second_pass([1, 0, 0, -1, 0, 1]) == [1, 1, -1, -1, -1, 1]
    assert html_extract.second_pass([0, 0]) == [-1, -1] and html_extract.second_pass([]) == [] and html_extract.second_pass([0, 1]) == [1, 1]


def test_second_pass_in_an_article_and_with_headings():
    assert html_extract.second_pass([0, -1, 0], article=True) == [1, -1, 1]
    assert html_extract.second_pass([-1, 0, 1], [False, True, False]) == [-1, 1, 1] and html_extract.second_pass([-1, 0, 1]) == [-1, -1, 1]


STOP_WORDS = ("the", "of", "and", "in", "la", "der")


def plain_page(rnd):
    """A page without article, class or furniture elements: its blocks as (text, characters in links, is heading), and its HTML."""
    found, html = [], []
    for _ in range(rnd.randint(0, 14)):
        n = rnd.choice((1, 3, 8, 14, 20, 45, 60))
        often = rnd.choice((0.0, 0.15, 0.2, 0.3, 0.5))
        words = [rnd.choice(STOP_WORDS) if rnd.random() < often else rnd.choice(("onther", "erwhat", "stion", "haveon", "lichke")) for _ in range(n)]
        k = rnd.choice((0, 0, 0, n // 4, n // 2, n))
        link, rest = " ".join(words[:k]), " ".join(words[k:])
        tag = rnd.choice(("p", "div", "h2", "li", "td"))
        found.append((" ".join(words), len(link), tag == "h2"))
        html.append(f"<{tag}>{f'<a href=x>{link}</a> ' if k else ''}{rest}</{tag}>" + rnd.choice(("", "\n", "<hr>", "<!-- x -->")))
    return found, "".join(html)


def plain_rules(found):
    """The two passes again, one block after the other, every neighbour looked at."""
    label = []
    told = [w for text, linked, _ in found if not linked for w in text.split()]
    strange = sum(w in STOP_WORDS for w in told) < 0.06 * len(told)
    for text, linked, _ in found:
        words, size = text.split(), len(text)
        often = sum(w in STOP_WORDS for w in words) / len(words)
        if strange and linked * 3 <= size * 0.99 and size >= 70:
            label.append("in" if size >= 200 else "?")
        elif linked * 3 > size * 0.99:
            label.append("out")
        elif size < 70:
            label.append("out" if linked else "?")
        elif often >= 0.25 or often >= 0.12 and size >= 200:
            label.append("in")
        else:
            label.append("?" if often >= 0.12 else "out")
    kept, short = [], "in" not in label
    for i, (text, _, heading) in enumerate(found):
        got = "in" if short and label[i] == "?" else label[i]
        if got == "?":
            left = next((label[j] for j in range(i - 1, -1, -1) if label[j] != "?"), None)
            right = next((label[j] for j in range(i + 1, len(found)) if label[j] != "?"), None)
            far = [next((d for d in range(1, len(found) + 1) if 0 <= i + s * d < len(found) and label[i + s * d] != "?"), 99) for s in (-1, 1)]
            if left is None or right is None:
                got = left or right or "out"
            else:
                got = right if heading or far[1] < far[0] else left
        if got == "in":
            kept.append(text)
    return "\n".join(kept)


def test_pages_without_marks():
    import random

    rnd, undecided, some = random.Random(7), 0, 0
    for _ in range(600):
        found, page = plain_page(rnd)
        assert html_extract.extract(page) == plain_rules(found)
        labels = [html_extract.first_pass(b) for b in html_extract.blocks(page)]
        undecided += labels.count(html_extract.UNSURE)
        some += bool(plain_rules(found))
    assert undecided > 500 and some > 200


def test_long_and_repeated_pages(spark):
    long = "<nav><a href=x>no</a></nav>" + f"<p>{PROSE}</p>" * 3000
    rows_ = [(1, "u", long), (1, "u", long), (2, None, None), (None, "v", ""), (3, "w", "<p>x")]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.url, r.n_chars) for r in html_extract.main_text(df).collect()), key=repr)
    n = (len(PROSE) + 1) * 3000 - 1
    assert got == sorted([(1, "u", n), (1, "u", n), (2, None, 0), (0, "v", 0), (3, "w", 1)], key=repr)
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_main_text_of_tables(spark):
    df = spark.createDataFrame([(i, "u", p, "t") for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    assert {r.page_id: (r.text, r.n_chars) for r in html_extract.main_text(df).collect()} == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_extract.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        import html

        body = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        parts = [" ".join(html.unescape(p.replace("<br>", " ").replace("<b>", "")).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p)
