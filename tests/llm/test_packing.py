import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from helpers import frame, messy
from tokenizers import Tokenizer

from snapledger.llm import common, packing

SPEC = P.path("word_bpe_49k.json")


def library():
    tokenizer = Tokenizer.from_file(SPEC)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_pieces_cover_every_document_and_fill_every_sequence(spark):
    rows, docs = messy(spark)
    pieces = packing.pack(docs, SPEC, length=512).collect()
    tokenizer, by_doc, by_sequence = library(), defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, t in rows:
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert {p.doc_tokens for p in own} == {sum(p.length for p in own)}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) == 512 or s == len(by_sequence) - 1


def test_word_by_word_is_text_by_text():
    tokenizer, own, rng = library(), packing.WordTokenizer(open(SPEC, encoding="utf-8").read()), random.Random(1)
    pool = ["a", "B", "é", "́", " ", " ", "\n", "\x0b", " ", "\x1c", "\x85", "1", "!", "'s", "<|endoftext|>", "ß", "İ", "Σ", "中", "😀", "\x00", "ﬁ", "가"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["word" * 40, "Don't stop.", "a.b", "x--", "--x", "1st,2nd", "it's'S", "...", None]
    latin = [chr(c) for c in range(1, 0x260)]
    texts += [t for c in latin for t in (c, f"a{c}b", f"{c}{c}.", f"x.{c}", f"{c.upper()}'S{c}")]
    for at in (0, 3):
        some = pa.array(texts).slice(at)
        for text, ids in zip(texts[at:], own.ids(some)):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_like_documents_lie_near_each_other(spark):
    rng = random.Random(4)
    groups = [[f"w{g}x{k}" for k in range(30)] for g in range(6)]
    rows = [(100 * g + k, " ".join(rng.choice(groups[g]) for _ in range(80))) for g in range(6) for k in range(10)]
    order = sorted(packing.pack(frame(spark, rows), SPEC).collect(), key=lambda p: (p.sequence_id, p.offset))
    firsts = [p.doc_id // 100 for p in order if p.start == 0]
    assert sum(a != b for a, b in zip(firsts, firsts[1:])) < 30  # 50 of 59 for a random order


def test_repeated_and_missing_ids_and_an_empty_table(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (None, None), (2, "")])
    pieces = packing.pack(docs, SPEC, with_ids=False).collect()
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces) == [("1", 3), ("1", 3), ("2", 1), ("None", 1)]
    assert all(p.ids is None for p in pieces)
    assert packing.pack(docs.filter("false"), SPEC).collect() == []


def held_mb():
    with open("/proc/self/smaps_rollup") as lines:
        return next(int(line.split()[1]) for line in lines if line.startswith("Rss")) / 1024


def test_a_worker_returns_what_its_groups_have_needed():
    """What lies below an object that is kept stays with the process until it is given back."""

    def answer(own: pa.Table) -> pa.Table:
        held = [bytes(2000) for _ in range(100_000)]
        kept.append(bytes(2000))
        return own.slice(0, len(held))

    kept, table = [], pa.table({"x": [1]})
    wrapped = common.giving_back(answer)
    answer(table)
    before = held_mb()
    assert wrapped(table).equals(table)
    assert held_mb() < before - 100
