import hashlib
import random

import numpy as np
import pytest
from helpers import frame, messy

from snapledger.llm import suffix_dedup as sd


def brute(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - sd.LENGTH + 1):
            string = data[p : p + sd.LENGTH]
            if string in seen:
                gone[p : p + sd.LENGTH] = b"\1" * sd.LENGTH
            seen.add(string)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_removed_bytes_are_those_of_a_set_of_all_strings(spark, seed):
    rows, docs = messy(spark, seed)
    got = {r.doc_id: r for r in sd.remove_repeats(docs, carried=("lang", "kept", "rest_of")[:2]).collect()}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute(rows)
    for i, t in rows:
        data = (t or "").encode()
        for s in reversed(got[i].spans):
            data = data[: s.start] + data[s.start + s.length :]
        assert bytes(got[i].kept) == data and got[i].kept_text == data.decode("utf-8", "ignore")
        assert got[i].rest.kept == "k"


def random_documents(rng):
    alphabet = rng.choice([b"ab", b"abcdefgh \n", bytes(range(256)), b"a"])
    draw = lambda n: bytes(rng.choice(alphabet) for _ in range(n))
    pool = [draw(rng.randint(1, 400)) for _ in range(6)]
    docs = [b"".join(rng.choice(pool) if rng.random() < 0.7 else draw(rng.randint(0, 150)) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 12))]
    return docs + [draw(7) * 60] if rng.random() < 0.4 else docs


@pytest.mark.parametrize("seed", range(12))
def test_segments_and_classes_on_any_bytes(monkeypatch, seed):
    """Short chunks, periodic texts and common grams included."""
    rng = random.Random(seed)
    monkeypatch.setattr(sd, "CHUNK", 257 if seed % 2 else 1 << 12)
    monkeypatch.setattr(sd, "_powers", [])
    for _ in range(10):
        docs = random_documents(rng)
        ends = np.cumsum([len(d) for d in docs])
        starts = ends - [len(d) for d in docs]
        data = np.frombuffer(bytes(sd.PAD) + b"".join(docs) + bytes(2 * sd.PAD), np.uint8)
        common = np.unique(sd.segments(data[sd.PAD :], starts, ends)[2][::3]) if rng.random() < 0.5 else None
        start, count, _, digest, anchor, _ = sd.segments(data[sd.PAD :], starts, ends, common)
        order = np.lexsort((start + anchor, np.searchsorted(ends, start, "right")))
        flags = np.ones((len(start), sd.SPAN), bool)
        kept = order[sd.first_of_equal(digest[order], count[order], anchor[order])]
        flags[kept] = sd.repeats(data, start[kept] + sd.PAD, count[kept], anchor[kept])
        got, want, seen = np.zeros(len(data), bool), np.zeros(len(data), bool), set()
        for s, n, f in zip(start, count, flags):
            got[s : s + n] = f[:n]
        for at, d in zip(starts, docs):
            for p in range(len(d) - sd.LENGTH + 1):
                want[at + p] = d[p : p + sd.LENGTH] in seen
                seen.add(d[p : p + sd.LENGTH])
        assert (got == want).all()


def test_multikey_sort_sorts_and_measures_common_prefixes():
    rng = random.Random(1)
    strings = sorted(bytes(rng.choice(b"ab") for _ in range(24)) for _ in range(300))
    shuffled = strings[:]
    rng.shuffle(shuffled)
    rows = np.frombuffer(b"".join(shuffled), ">u8").reshape(-1, 3).astype(np.uint64)
    order, common = sd.multikey_sort(lambda i, t: rows[i, t], len(shuffled), 3)
    assert [shuffled[i] for i in order] == strings
    for a, b, n in zip(strings, strings[1:], common[1:]):
        assert n == next((k for k in range(24) if a[k] != b[k]), 24)


def test_order_of_repeated_and_missing_ids(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    got = sorted(((r.doc_id or -1, r.n_removed) for r in sd.remove_repeats(frame(spark, [(None, text), (7, text), (7, text), (2, text[:150])])).collect()))
    assert got == [(-1, 300), (2, 0), (7, 150), (7, 300)]
    assert sd.remove_repeats(frame(spark, [(1, "a")]).filter("false")).collect() == []
