"""Benchmark passages against a comparison of every window with every place."""

import random
import re

import pytest
from helpers import WORDS, frame, messy, sentence

from snapledger.llm import decontaminate
from snapledger.llm.decontaminate import contamination, longest_matches, remove_contaminated

ITEMS = "item_id long, text string, start long, items string"


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_windows(items, window=10):
    """{window: item ids as texts} and the windows by size."""
    found = {}
    for i, t in items:
        w = plain_words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[k : k + n]), set()).add(i)
    return found


def plain(text, windows):
    w = plain_words(text)
    hit, items = set(), set()
    for n in {len(x) for x in windows}:
        for p in range(len(w) - n + 1):
            of = windows.get(tuple(w[p : p + n]))
            if of:
                hit |= set(range(p, p + n))
                items |= of
    begins = sorted(x for x in hit if x - 1 not in hit)
    spans = [(b, next(e for e in range(b, len(w) + 1) if e not in hit) - b) for b in begins]
    listed = sorted(str(i) for i in items if i is not None) + [None] * (None in items)
    return len(w), len(hit), tuple(spans), tuple(listed), bool(hit)


def passages(seed=1):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.randint(1, 40))) for k in range(25)]
    items += [(100, "The"), (101, "rear sten"), (102, items[3][1]), (3, items[4][1]), (None, sentence(rng, 14)), (103, None), (104, " .,! "), (105, "ä" * 300 + " q")]
    items += [(200, " ".join([WORDS[0]] * 30)), (201, sentence(rng, 400)), (5, items[5][1])]
    rows = []
    for k in range(60):
        parts = [sentence(rng, rng.randint(0, 60))]
        for i, t in rng.sample(items, rng.randint(0, 3)):
            w = (t or "").split()
            a = rng.randint(0, max(0, len(w) - 3))
            parts += [", ".join(w[a : a + rng.randint(1, 40)]).upper() if rng.random() < 0.5 else " ".join(w), sentence(rng, rng.randint(0, 20))]
        rows.append((k, " ".join(parts)))
    rows += [(7, "the " * 50), (None, items[6][1]), (61, None), (62, ""), (63, "ä" * 300 + " Q"), (64, "ä" * 300), (65, items[0][1])]
    return rows, items


def bench_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)


@pytest.mark.parametrize("slab_bytes", [1 << 20, 1500])
def test_every_window_is_found(spark, monkeypatch, slab_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 4000)
    rows, items = passages()
    rows += messy(spark)[0]
    docs = frame(spark, rows)
    found = contamination(docs, bench_of(spark, items), carried=tuple(docs.columns), slab_bytes=slab_bytes).collect()
    windows = plain_windows(items)
    got = sorted(repr((r.rest.doc_id, r.n_words, r.n_hit, tuple(map(tuple, r.spans)), tuple(r["items"]), r.contaminated)) for r in found)
    assert got == sorted(repr((i, *plain(t, windows))) for i, t in rows)
    assert set(found[0].rest.asDict()) == set(docs.columns)


def test_windows_of_other_sizes(spark):
    rows, items = passages(2)
    for window in (1, 3):
        windows = plain_windows(items, window)
        found = contamination(frame(spark, rows), bench_of(spark, items), window=window).collect()
        got = sorted(repr((r.rest.doc_id, r.n_words, r.n_hit, tuple(map(tuple, r.spans)), tuple(r["items"]), r.contaminated)) for r in found)
        assert got == sorted(repr((i, *plain(t, windows))) for i, t in rows)


def test_empty_tables(spark):
    rows, items = passages()
    docs, bench = frame(spark, rows), bench_of(spark, items)
    assert contamination(docs.filter("false"), bench).collect() == []
    clean = contamination(docs, bench.filter("false"))
    assert clean.filter("contaminated or n_hit > 0 or size(items) > 0").count() == 0 and clean.count() == len(rows)
    assert longest_matches(docs, bench.filter("false")).collect() == []


def test_affected_documents_go(spark):
    rows, items = passages()
    windows = plain_windows(items)
    docs = frame(spark, rows)
    left = remove_contaminated(docs, bench_of(spark, items))
    assert left.columns == docs.columns
    assert sorted(repr((r.doc_id, r.text)) for r in left.collect()) == sorted(repr(r) for r in rows if not plain(r[1], windows)[-1])


@pytest.mark.parametrize("slab_bytes", [1 << 20, 1500])
def test_longest_matches(spark, slab_bytes):
    rows, items = passages(4)
    found = longest_matches(frame(spark, rows), bench_of(spark, items), slab_bytes=slab_bytes).collect()
    docs = [(i, plain_words(t)) for i, t in rows]
    want = []
    for item, text in set(items):
        w = plain_words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            best = None
            for i, d in docs:
                for p in range(len(d)):
                    k = 0
                    while s + k < len(w) and p + k < len(d) and w[s + k] == d[p + k]:
                        k += 1
                    rank = (-k, i is None, i or 0, p)
                    if k >= n and (best is None or rank < best[0]):
                        best = rank, (k, i, p)
            if best:
                want.append(repr((None if item is None else str(item), s, *best[1])))
    assert sorted(repr((r.item_id, r.item_start, r.length, r.doc_id, r.doc_start)) for r in found) == sorted(want)
