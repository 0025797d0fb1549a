"""Periodic runs against a comparison of every word with every later one."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import frame, messy

from snapledger.llm import queries, words
from snapledger.llm.periodic import find_runs, periodic_runs


def plain_runs(seq, minimum=12):
    """(start, length, period) of every run."""
    n, found = len(seq), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x < n - q:
            if seq[x] != seq[x + q]:
                x += 1
                continue
            begin = x
            while x < n - q and seq[x] == seq[x + q]:
                x += 1
            if x - begin >= q and x - begin + q >= minimum:
                found.setdefault((begin, x + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_collapsed(seq, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(seq) if i not in gone)


def sequence(rng, kind):
    n, letters = rng.randint(0, 400), rng.choice([1, 2, 2, 3, 5])
    some = lambda k, m: [rng.randrange(k) for _ in range(m)]
    if kind == "random":
        return some(letters, n)
    if kind == "one period":
        return (some(letters, rng.randint(1, 60)) * 400)[:n]
    if kind == "periods in a period":
        return ((some(3, rng.randint(1, 4)) * 70)[: rng.randint(10, 70)] * 40)[:n]
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == "overlap free":
        return [bin(i).count("1") & 1 for i in range(n)]
    if kind == "several":
        out = []
        while len(out) < n:
            out += some(4, rng.randint(1, 40)) * rng.randint(1, 5)
        return out[:n]
    if kind == "square among others":
        u = some(50, rng.randint(16, 150))
        return some(50, 9) + u + u + u[: rng.randint(0, 10)] + some(50, 9)
    u = (some(3, rng.randint(1, 3)) * 130)[: rng.randint(17, 130)]  # a square of a word that is periodic itself
    return u + u + u[: rng.randint(0, 5)]


KINDS = ["random", "one period", "periods in a period", "fibonacci", "overlap free", "several", "square among others", "square of a periodic word"]


@pytest.mark.parametrize("first_scale", [4, 5, 6])
@pytest.mark.parametrize("kind", KINDS)
def test_all_runs_are_found(kind, first_scale):
    rng = random.Random(f"{kind}{first_scale}")
    docs = [sequence(rng, kind) for _ in range(40)] + [[], [7], [7, 7]]
    sizes, numbers = np.array([len(d) for d in docs]), np.array(sum(docs, []), np.int64)
    for minimum in (12, 4):
        want = [(i, *r) for i, d in enumerate(docs) for r in plain_runs(d, minimum)]
        assert list(zip(*(c.tolist() for c in find_runs(numbers, sizes, minimum, first_scale)))) == want


def test_no_texts():
    assert [c.tolist() for c in find_runs(np.empty(0, np.int64), np.empty(0, np.int64))] == [[], [], [], []]


def test_minimizers_seed_few_pairs_where_everything_repeats():
    """A text of one word has its run from the direct scan and pairs no minimizers."""
    numbers = np.zeros(200_000, np.int64)
    assert [c.tolist() for c in find_runs(numbers, np.array([200_000]))] == [[0], [0], [200_000], [1]]


def test_word_numbers_are_exact_for_long_words_and_shared_hashes(monkeypatch):
    texts = ["a", "b", "a", "x" * 300, "x" * 300, "x" * 301, "abcdefgh", "abcdefgh1", "abcdefgh", "abcdefgh2"]
    text = " ".join(texts).encode()
    data = np.frombuffer(text + bytes(words.PAD), np.uint8)
    cut = lambda: words.word_numbers(data, *words.cut_words(data, np.array([0, len(text)]), queries.periodic.INSIDE)[:2])
    numbers = cut().tolist()
    assert [[a == b for b in texts] for a in texts] == [[a == b for b in numbers] for a in numbers]
    real = words.word_hashes
    monkeypatch.setattr(words, "word_hashes", lambda d, s, n, seed=0: real(d, s, n, seed) % np.uint64(3) if seed < 2 else real(d, s, n, seed))
    numbers = cut().tolist()
    assert [[a == b for b in texts] for a in texts] == [[a == b for b in numbers] for a in numbers]


def test_a_word_ends_with_its_text():
    data, offsets = np.frombuffer(b"abab c" + bytes(words.PAD), np.uint8), np.array([0, 0, 2, 4, 4, 6, 6])
    starts, sizes, texts = words.cut_words(data, offsets, queries.periodic.INSIDE)
    assert (starts.tolist(), sizes.tolist(), texts.tolist()) == ([0, 2, 5], [2, 2, 1], [1, 2, 4])


def planted(doc_id, seq):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(seq)
    if h % 10 or not n:
        return seq
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else seq[a + (i - a) % p] for i, w in enumerate(seq)]


def test_operator_on_messy_rows(spark):
    rows, docs = messy(spark)
    rows += [(rows[0][0], "z " * 40), (None, "u v w " * 9 + "  x"), (5, "ä" * 400 + " " + "ä" * 400)]
    docs = frame(spark, rows)
    found = periodic_runs(docs, carried=tuple(docs.columns)).collect()
    got = sorted((str(r.rest.doc_id), r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in found)
    want = []
    for i, t in rows:
        seq = plain_words(t)
        runs = plain_runs(seq) if len(seq) < 3000 else plain_runs(seq, 12)
        want.append((str(i), len(seq), tuple(runs), plain_collapsed(seq, runs)))
    assert got == sorted(want)
    assert set(found[0].rest.asDict()) == set(docs.columns)
    assert periodic_runs(docs.filter("false")).collect() == []


def test_query_is_the_plain_version(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 200)))) for k in range(120)]
    rows += [(None, "a b " * 20), (7, None), (30, ""), (31, " \t "), (32, "one")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(repr, (tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect())))
    want = []
    for i, t in rows:
        seq = plain_words(t) if i is None else planted(i, plain_words(t))
        runs = plain_runs(seq)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapsed(seq, runs)))
        want.append(repr((i, len(runs), *shown, *digests)))
    assert got == sorted(want)
