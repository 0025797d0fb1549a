"""Small frames with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside must not clash
    "digest string, start long, shard int, block long, row string, fp long, kept string, ids string, component_id long"
)
WORDS = "the of and erat thion wher edly haer onth rear sten tion ein und der les que".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ed", "ing"]) for _ in range(n))


def texts(seed: int = 3, n: int = 40) -> list[str | None]:
    """Nulls, blanks, copies that differ in white space, near copies, shared passages and a long text."""
    rng = random.Random(seed)
    passage, base = sentence(rng, 60), sentence(rng, 200)
    out: list[str | None] = [None, "", " ", "\t\n", "one", "a b c", "äöü ß 中文 😀  x", "12 34 !!", base, base, base.replace(" ", "  ")]
    out += [base + " " + rng.choice(WORDS) for _ in range(5)]
    out += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 30) for _ in range(6)]
    out += ["ab" * 300, "x" * 5000, sentence(rng, 6000), "one", None]
    out += [sentence(rng, rng.randint(1, 120)) for _ in range(n)]
    return out


def frame(spark, rows: list[tuple], partitions: int = 3):
    """A frame of (doc_id, text) with other columns, some of them NULL throughout."""
    full = [(i, t, [None, "en", "de"][k % 3], f"s{k % 4}" if k % 5 else None, k, "d", k, k, k, "r", k, "k", "i", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def messy(spark, seed: int = 3):
    rows = [(10 * k + 3, t) for k, t in enumerate(texts(seed))]
    random.Random(seed).shuffle(rows)
    return rows, frame(spark, rows)


def classes(ids, links) -> dict:
    """The smallest id that links reach, by plain union."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
