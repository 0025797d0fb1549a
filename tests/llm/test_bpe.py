import base64
import hashlib
import random

import public_tokenizers as P
import regex
import tiktoken
from helpers import frame, messy

from snapledger.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library_and_decode_to_the_text(spark):
    rows, docs = messy(spark)
    encoder = library()
    got = {r.doc_id: r for r in bpe.encode_corpus(docs, RANKS, P.PATTERN).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        ids, r = encoder.encode_ordinary(t or ""), got[i]
        assert r.ids == ids and bytes(r.decoded) == (t or "").encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_words_are_those_of_the_pattern():
    rng = random.Random(2)
    pool = ["a", "Bc", "é", "1", "２", " ", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "!", "'s", "'", "'LL", "中", "😀", "-", "\r\n"]
    words = bpe.Words(P.PATTERN)
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 16)))
        numbers = words.of(text).tolist()
        names = list(words.numbers)
        assert [names[n] for n in numbers] == regex.findall(P.PATTERN, text), repr(text)


def test_repeated_and_missing_ids_and_an_empty_table(spark):
    docs = frame(spark, [(1, "same text"), (1, "same text"), (None, None)])
    got = bpe.encode_corpus(docs, RANKS, P.PATTERN, with_ids=False).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("1", len(library().encode_ordinary("same text")))] * 2 + [("None", 0)]
    assert all(r.ids is None and r.decoded is None for r in got)
    assert bpe.encode_corpus(docs.filter("false"), RANKS, P.PATTERN).collect() == []


def test_buckets_follow_the_data(spark):
    from snapledger.llm.common import bucket_count

    assert bucket_count(spark, 0) == 2 and bucket_count(spark, 10 << 30) == 160 and bucket_count(spark, 1, 1) == 2
