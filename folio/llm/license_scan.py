"""Licence scans: a trained paragraph classifier in DataFrame functions.

A paragraph is known by the number of its first line. Lines are scored one by one, for
notices on one line; then each line with a telling word that matched nothing is scored
joined with the lines that follow it, up to a blank line, a matched line or SPAN_WORDS words (several times the
longest template), for hard-wrapped notices. A line whose only signs are those of a comment is blank. A joined match
has the lines that it needs, no others: the fewest lines from its first on that confirm a template, without lines before these that
it can do without. Matches of one family whose lines overlap are one; so are those that follow in one paragraph as long as they
confirm other templates. A template that comes again begins another notice.

The features of a paragraph are the presence of word unigrams and
bigrams that occur in the licence templates and have a telling word in them. A
multinomial logistic regression over them, fitted on the driver on variants of the
templates, on mixtures of their words and on ordinary sentences with such words (OTHER), tells the
families and an unknown class. Its logits are divided by a temperature, which calibrates the
probabilities: it is fitted on templates and ordinary sentences that a first model, fitted on the
others only, has not seen. A prediction stands only if a template of the family confirms it: a share
of the template's features must be in the paragraph, or all features of a title or SPDX
form of the family in a short one.

The scan is native: lines without a telling word have no feature, or a few words (SLIGHT) that no
template can be confirmed by, so their class is unknown and a pattern passes them over; the others are
scored in the row with array functions. No shuffle, no Python on the executors. Model and
templates are constants of some hundred entries.

Defined results: a null or empty text has no paragraphs and no licences. Repeated rows give
equal rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import random
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Sentences by which licence families are stated.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "isc": ("Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software: you can redistribute it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "bsd": (
        "Redistributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    "epl": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 2.0."),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "cc-by-nc-nd": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
}
#: Ordinary sentences with words of licences, which state none.
OTHER = (
    "Visitors need the owner's permission to enter the old foundation of the mill.",
    "The software was distributed on floppy disks together with a printed copy of the manual.",
    "Her driving license was granted in the spring, without any further conditions.",
    "The general public was free to use the library, and the rights of readers were respected.",
    "A person may obtain a copy of the file at the office, free of charge.",
    "The work was published under a false name and sold in many copies.",
    "The committee agreed to modify the terms of the contract in writing.",
    "Creative people often see the commons as a source of ideas for their work.",
    "International law and copyright were the subject of the first lecture.",
    "The program gives students a grant for their documentation of rare dialects.",
    "Apache helicopters were on display, and so was an eclipse of the sun on film.",
    "The binary form of a number is permitted in this notation, as is the usual one.",
    "The author has the right to merge two chapters and to publish them again.",
    "He was known as a liberal and as a dealer in rare products without warranty.",
    "All rights to the name of the product belong to the holder of the trade mark.",
    "The Berkeley campus is licensed to serve food, subject to local rules.",
)
#: Sentences that name a licence and don't grant it; @ is its title.
COUNTER = (
    "This file is not released under the @.",
    "It is not licensed under the @.",
    "We considered the @ but did not choose it.",
    "Works under the @ may be combined with it.",
    "Unlike the @, it asks for nothing.",
    "It was chosen instead of the @.",
    "The @ is compatible with it.",
)
#: Titles and SPDX forms; they count in paragraphs of at most TITLE_WORDS words.
TITLES = {
    "apache-2.0": ("Apache License", "SPDX-License-Identifier: Apache-2.0"),
    "mit": ("MIT License", "SPDX-License-Identifier: MIT"),
    "isc": ("ISC License", "SPDX-License-Identifier: ISC"),
    "gpl": ("GNU General Public License", "SPDX-License-Identifier: GPL"),
    "lgpl": ("GNU Lesser General Public License", "SPDX-License-Identifier: LGPL"),
    "agpl": ("GNU Affero General Public License", "SPDX-License-Identifier: AGPL"),
    "bsd": ("BSD 2-Clause License", "BSD 3-Clause License", "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl": ("Mozilla Public License", "SPDX-License-Identifier: MPL-2.0"),
    "epl": ("Eclipse Public License", "SPDX-License-Identifier: EPL-2.0"),
    "unlicense": ("The Unlicense", "SPDX-License-Identifier: Unlicense"),
    "cc-by": ("Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0"),
    "cc-by-sa": ("Creative Commons Attribution-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "cc-by-nc": ("Creative Commons Attribution-NonCommercial 4.0 International", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-nd": ("Creative Commons Attribution-NoDerivatives 4.0 International", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "cc-by-nc-sa": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
    "cc-by-nc-nd": ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "SPDX-License-Identifier: CC-BY-NC-ND-4.0"),
    "cc0": ("CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"),
}
TITLE_WORDS = 10
#: Words that tell nothing by themselves.
PLAIN = frozenset(
    "a above all along an and any anyone are as at be by can do either except extent following for form forms free from has have if in into is it its kind made may met name names neither nor not of on one or possible person published related"
    " should so that the this to under unless use used v was whom with without work you your".split()
)
#: Words of features that are common in other languages. No template or title can be confirmed by these and plain words alone.
SLIGHT = frozenset("mit nc nd sa".split())
WORD = r"[a-z0-9]+"
#: Variants that the model is fitted on, for each template, and as many mixtures.
VARIANTS = 60
STEPS, RATE, DECAY = 400, 1.0, 2e-4
MIN_PROBABILITY, MIN_TEMPLATE = 0.5, 0.6
#: Words from a line's first on that can belong to one template, whose longest has some forty; as many lines at most, as a line that is not blank has a word.
SPAN_WORDS = 120


def grams_of(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return [g for g in grams if any(telling(w) for w in g.split())]


def telling(word: str) -> bool:
    return word not in PLAIN and not word.isdigit()


@dataclass
class Model:
    classes: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    words: list[str]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(templates: dict[str, tuple[str, ...]], titles: dict[str, tuple[str, ...]], other: tuple[str, ...], told: list[str], rnd: random.Random) -> list[tuple[str, int]]:
    """Texts with the number of their class: variants of the templates, titles among plain words, other sentences, and mixtures of words, which are unknown."""
    texts: list[tuple[str, int]] = []
    unknown = len(TEMPLATES)

    def variants(t: str) -> list[str]:
        # whole first, then with words lost, as in broken or edited notices
        return [" ".join(w for w in t.split() if i == 0 or rnd.random() > 0.25 * rnd.random()) for i in range(VARIANTS)]

    for k, family in enumerate(TEMPLATES):
        texts += [(v, k) for t in templates[family] for v in variants(t)]
        for t in titles[family]:
            # titles only whole, among plain words
            for i in range(VARIANTS):
                noise = [rnd.choice(sorted(PLAIN)) for _ in range(i % 4)]
                cut = rnd.randint(0, len(noise))
                texts.append((" ".join([*noise[:cut], t, *noise[cut:]]), k))
    texts += [(v, unknown) for t in other for v in variants(t)[: VARIANTS // 3]]
    texts += [(c.replace("@", t), unknown) for ts in titles.values() for t in ts for c in COUNTER for _ in range(VARIANTS // 4)]
    texts += [(w, unknown) for w in told] + [("", unknown)] * VARIANTS
    everything = [w for ts in templates.values() for t in ts for w in t.split()]
    for _ in range(VARIANTS * 12):
        # telling words apart from their phrases, among plain ones
        mixed = [rnd.choice(everything) for _ in range(rnd.randint(1, 6))] + [rnd.choice(sorted(PLAIN)) for _ in range(rnd.randint(0, 6))]
        rnd.shuffle(mixed)
        texts.append((" ".join(mixed), unknown))
    return texts


def fit(seed: int = 11) -> Model:
    """The classifier, fitted on the templates' variants; the temperature on those that a model of the others has not seen. Same seed, same model."""
    rnd = random.Random(seed)
    classes = [*TEMPLATES, UNKNOWN]
    granting = {g for ts in (*TEMPLATES.values(), *TITLES.values()) for t in ts for g in grams_of(t)}
    features = sorted(granting | {g for c in COUNTER for part in c.split("@") for g in grams_of(part)})
    index = {g: i for i, g in enumerate(features)}
    told = sorted({w for g in granting for w in g.split() if telling(w)})

    def matrix(texts: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(texts), len(features)), np.float32)
        for i, (t, _) in enumerate(texts):
            x[i, [index[g] for g in grams_of(t) if g in index]] = 1
        return x, np.array([k for _, k in texts])

    def fitted(texts: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        x, y = matrix(texts)
        # equal rows count together
        x, at = np.unique(np.concatenate((x, y[:, None].astype(np.float32)), axis=1), axis=0, return_counts=True)
        x, target, share = x[:, :-1], np.eye(len(classes), dtype=np.float32)[x[:, -1].astype(int)], (at / at.sum()).astype(np.float32)[:, None]
        w, b = np.zeros((len(features), len(classes)), np.float32), np.zeros(len(classes), np.float32)
        for _ in range(STEPS):
            g = (_softmax(x @ w + b) - target) * share
            w -= RATE * (x.T @ g + DECAY * w) * 5
            b -= RATE * g.sum(axis=0)
        return w, b

    def part(of: dict[str, tuple[str, ...]], odd: int) -> dict[str, tuple[str, ...]]:
        return {k: tuple(t for i, t in enumerate(ts) if i % 2 == odd) for k, ts in of.items()}

    w, b = fitted(_examples(part(TEMPLATES, 0), part(TITLES, 0), OTHER[::2], told, rnd))
    x, y = matrix([e for e in _examples(part(TEMPLATES, 1), part(TITLES, 1), OTHER[1::2], [], rnd) if e[0]])
    z = x @ w + b
    loss = {t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in (k / 20 for k in range(4, 101))}
    w, b = fitted(_examples(TEMPLATES, TITLES, OTHER, told, rnd))
    return Model(classes, {g: [round(v, 6) for v in w[i].tolist()] for g, i in index.items()}, [round(v, 6) for v in b.tolist()], min(loss, key=loss.get), [w for w in told if w not in SLIGHT])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is named once, so that nothing is worked out twice."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))))


def _by_family(of: dict[str, tuple[str, ...]]) -> Column:
    """Features of each family's texts."""
    return F.from_json(F.lit(json.dumps({k: [sorted(set(grams_of(t))) for t in ts] for k, ts in of.items()} | {UNKNOWN: []})), "map<string,array<array<string>>>")


def _held(template: Column, grams: Column) -> Column:
    """Whether enough of a template is among the features."""
    return F.size(F.array_intersect(template, grams)) >= F.size(template) * F.lit(MIN_TEMPLATE)


def _paragraph(line: Column, model: Model) -> Column:
    """family and probability of a line (lower case) that has a telling word."""
    weights = F.from_json(F.lit(json.dumps(model.weights)), "map<string,array<double>>")
    templates, titles = _by_family(TEMPLATES), _by_family(TITLES)
    names = F.array(*map(F.lit, model.classes))
    words = _words(line)
    short = F.size(words) <= TITLE_WORDS
    grams = F.array_intersect(_grams(words), F.map_keys(weights))
    logits = F.aggregate(grams, F.array(*map(F.lit, model.bias)), lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda p, q: p + q))
    scaled = F.transform(logits, lambda v: v / F.lit(model.temperature))

    def chosen(z: Column) -> Column:
        top = F.array_max(z)
        p = 1 / F.aggregate(z, F.lit(0.0), lambda s, v: s + F.exp(v - top))
        return F.struct(F.element_at(names, F.array_position(z, top).cast("int")).alias("family"), p.alias("probability"))

    def confirmed(got: Column, found: Column, short: Column) -> Column:
        by_template = F.exists(F.element_at(templates, got["family"]), lambda t: _held(t, found))
        by_title = short & F.exists(F.element_at(titles, got["family"]), lambda t: F.size(F.array_except(t, found)) == 0)
        sure = (got["probability"] >= MIN_PROBABILITY) & (by_template | by_title)
        return F.struct(F.when(sure, got["family"]).otherwise(F.lit(UNKNOWN)).alias("family"), got["probability"].alias("probability"))

    return _let(F.struct(grams.alias("g"), scaled.alias("z"), short.alias("short")), lambda s: confirmed(_let(s["z"], chosen), s["g"], s["short"]))


def _lines_used(found: Column) -> Column:
    """found (paragraph, lines, family, probability) with the number of its first line and of its last, and the templates (by number) that these lines hold."""
    templates = F.element_at(_by_family(TEMPLATES), found["family"])
    lines = found["lines"]

    def held(first: Column, count: Column) -> Column:
        grams = _grams(_words(F.array_join(F.slice(lines, first, count), " ")))
        return F.filter(F.transform(templates, lambda t, i: F.when(_held(t, grams), i)), lambda i: i.isNotNull())

    places = F.sequence(F.lit(1), F.size(lines))
    # the end: fewest lines from the first on; then the start: as late as one of the templates allows
    end = F.coalesce(F.get(F.filter(places, lambda n: F.size(held(F.lit(1), n)) > 0), F.lit(0)), F.size(lines))

    def trimmed(e: Column) -> Column:
        late = F.filter(F.sequence(F.lit(1), e), lambda i: F.size(held(i, e - i + 1)) > 0)
        return _let(F.coalesce(F.try_element_at(late, F.lit(-1)), F.lit(1)), lambda i: F.struct((found["paragraph"] + i - 1).alias("paragraph"), found["family"].alias("family"), found["probability"].alias("probability"), (found["paragraph"] + e - 1).alias("end"), held(i, e - i + 1).alias("held")))

    return _let(end, trimmed)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """id, n_paragraphs (lines that are not blank), n_candidates (lines with a telling word) and matches: array of (paragraph, family, probability), one for each licence paragraph."""
    model = model or fit()
    # text is cut at the ends of words only, so the pattern needs no look-around but these
    telling_word = rf"(?<![a-z0-9])(?:{'|'.join(model.words)})(?![a-z0-9])"
    lines = F.split(F.lower(F.col(text_col)), "\n")
    base = docs.select(F.col(id_col), lines.alias("lines"))
    numbered = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(telling_word), F.struct(i.alias("paragraph"), x.alias("line")))), lambda s: s.isNotNull())
    base = base.select(id_col, "lines", F.coalesce(F.size(F.filter("lines", lambda x: F.trim(x) != "")), F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce(numbered, F.array().cast("array<struct<paragraph:int,line:string>>")).alias("candidates"))

    def judged(c: Column) -> Column:
        return F.struct(c["paragraph"].alias("paragraph"), _paragraph(c["line"], model).alias("m"))

    def matches(of: Column) -> Column:
        found = F.filter(F.transform(of, judged), lambda s: s["m"]["family"] != UNKNOWN)
        return F.transform(found, lambda s: F.struct(s["paragraph"].alias("paragraph"), s["m"]["family"].alias("family"), s["m"]["probability"].alias("probability")))

    alone = base.select("*", matches(F.col("candidates")).alias("alone"))
    taken = F.col("alone.paragraph")

    blank = lambda x: ~x.rlike(r"[\p{L}\p{N}]")

    def joined(c: Column) -> Column:
        """c with the lines that follow it in its paragraph; null if none does."""
        at = c["paragraph"]
        rest = F.slice("lines", at + 2, SPAN_WORDS)
        stop = F.array_position(F.transform(rest, lambda x, i: blank(x) | F.array_contains(taken, at + 1 + i)), F.lit(True))
        rest = F.when(stop > 0, F.slice(rest, 1, (stop - 1).cast("int"))).otherwise(rest)
        within = _let(F.concat(F.array(c["line"]), rest), lambda ls: F.transform(ls, lambda x: F.regexp_extract(x, rf"\A(?:[^a-z0-9]*+{WORD}+){{0,{SPAN_WORDS}}}+", 0)))
        return _let(within, lambda ls: F.when(F.size(ls) > 1, F.struct(at.alias("paragraph"), ls.alias("lines"), F.regexp_extract(F.array_join(ls, " "), rf"\A(?:[^a-z0-9]*+{WORD}+){{0,{SPAN_WORDS}}}+", 0).alias("line"))))

    left = F.filter("candidates", lambda c: ~F.array_contains(taken, c["paragraph"]))
    wrapped = alone.select("*", F.filter(F.transform(left, joined), lambda s: s.isNotNull()).alias("joined"))
    scored = F.filter(F.transform("joined", lambda c: F.struct(c["paragraph"].alias("paragraph"), c["lines"].alias("lines"), _paragraph(c["line"], model).alias("m"))), lambda s: s["m"]["family"] != UNKNOWN)
    used = F.transform(scored, lambda s: _lines_used(F.struct(s["paragraph"].alias("paragraph"), s["lines"].alias("lines"), s["m"]["family"].alias("family"), s["m"]["probability"].alias("probability"))))
    wrapped = wrapped.withColumn("wrapped", F.array_sort(used))

    def one_paragraph(k: Column, m: Column) -> Column:
        between = F.slice("lines", k["end"] + 2, F.greatest(m["paragraph"] - k["end"] - 1, F.lit(0)))
        return ~F.exists(between, blank)

    def noted(kept: Column, m: Column) -> Column:
        """kept with one match more; k: the last of its family."""

        def with_last(k: Column) -> Column:
            goes_on = (F.size(F.array_intersect(k["held"], m["held"])) == 0) & one_paragraph(k, m)
            longer = F.struct(k["paragraph"].alias("paragraph"), k["family"].alias("family"), k["probability"].alias("probability"), m["end"].alias("end"), F.concat(k["held"], m["held"]).alias("held"))
            grown = F.transform(kept, lambda x: F.when((x["paragraph"] == k["paragraph"]) & (x["family"] == k["family"]), longer).otherwise(x))
            return F.when(k.isNull() | (k["end"] < m["paragraph"]) & ~goes_on, F.concat(kept, F.array(m))).when(k["end"] >= m["paragraph"], kept).otherwise(grown)

        return _let(F.try_element_at(F.filter(kept, lambda k: k["family"] == m["family"]), F.lit(-1)), with_last)

    none = F.array().cast("array<struct<paragraph:int,family:string,probability:double,end:int,held:array<int>>>")
    notices = F.transform(F.aggregate("wrapped", none, noted), lambda m: F.struct(m["paragraph"].alias("paragraph"), m["family"].alias("family"), m["probability"].alias("probability")))
    return wrapped.select(id_col, "n_paragraphs", F.size("candidates").cast("long").alias("n_candidates"), F.array_sort(F.concat("alone", notices)).alias("matches"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """scan() as flat columns: families and paragraphs of the matches as comma-separated strings, and the least probability."""
    got = scan(docs, id_col, text_col)
    return got.select(
        id_col,
        "n_paragraphs",
        "n_candidates",
        F.size("matches").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.family"))), ",").alias("families"),
        F.array_join(F.col("matches.paragraph").cast("array<string>"), ",").alias("paragraphs"),
        F.round(F.array_min(F.col("matches.probability")), 4).alias("least_probability"),
    )
