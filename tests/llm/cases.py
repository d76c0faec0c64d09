"""A small table with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, node string, spans string, unit string, score string, key string"


def passage(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 6))) for _ in range(n))


def rows(seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    shared, base = passage(rnd, 60), passage(rnd, 120)
    texts = [None, "", "   \n\t ", "one", "The Cat sat", "ünïcode  wörds\r\nand, signs! 😀", base, base, base.upper()]
    words = base.split()
    for k in range(8):
        w = list(words)
        for i in rnd.sample(range(len(w)), k):
            w[i] = f"edit{k}x{i}"
        texts.append(" ".join(w))
    texts += [f"{passage(rnd, 30)} {shared} {passage(rnd, 30)}" for _ in range(4)]
    texts += [shared, " ".join(["same"] * 90), passage(rnd, 12_000), passage(rnd, 40) + "\nLicensed under the Apache License, Version 2.0."]
    out = [(i * 3, t, "en", "s", None if t is None else len(t), "x", "y", None, "u", "1", None) for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, texts[7], None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return out


def table(spark, seed: int = 1):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
