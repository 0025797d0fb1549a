"""The whole pipeline against a plain version of each of its stages."""

import re
from itertools import combinations

import public_tokenizers as P
from helpers import classes, frame, texts
from test_near_copies import similar
from test_simhash import plain
from tokenizers import Tokenizer

import corpus_pipeline
from snapledger.llm import pipeline

LENGTH = 100


def expected(rows):
    """Documents and their token counts after the first four stages."""
    docs = {i: t for i, t in rows if any(c.isalpha() for c in t or "")}
    first = {}
    for i in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", docs[i]), i)
    docs = {i: docs[i] for i in first.values()}
    marks = {i: plain(t) for i, t in docs.items()}
    near = [(a, b) for a, b in combinations(docs, 2) if bin(marks[a] ^ marks[b]).count("1") <= 4]
    found = classes(docs, near + similar(docs))
    docs = {i: t for i, t in docs.items() if found[i] == i}
    seen, out = set(), {}
    for i in sorted(docs):
        data = docs[i].encode()
        gone = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            if data[p : p + LENGTH] in seen:
                gone[p : p + LENGTH] = b"\1" * LENGTH
            seen.add(data[p : p + LENGTH])
        kept = bytes(x for x, g in zip(data, gone) if not g).decode("utf-8", "ignore")
        if not data or sum(gone) < len(data):
            out[i] = kept
    return out


def check(pieces, rows):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in expected(rows).items()}
    got = {}
    for p in sorted(pieces, key=lambda p: p.start):
        got.setdefault(p.doc_id, []).extend(p.ids)
    assert got == want
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))


def test_stages_on_awkward_rows(spark):
    rows = [(10 * k + 3, t) for k, t in enumerate(texts(9))]
    docs = frame(spark, rows)
    columns = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        assert docs.columns == columns
    check(pipeline.STAGES[-1][1](spark, docs, "").collect(), rows)


def test_run_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    pieces = corpus_pipeline.run(spark, sf).collect()
    check(pieces, rows)


def test_stages_on_an_empty_table(spark):
    docs = frame(spark, [(1, "a")]).filter("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_every_stage_has_a_name():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(set(names)) == 5
