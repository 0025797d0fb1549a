"""Byte-level BPE of a corpus by one shuffle of its distinct words, and back.

Texts are cut to pre-tokens ("words"). A block of documents keeps its words as numbers in their
order, and sends each distinct word once, with its number, to the bucket of the word's hash. A
bucket encodes each of its words once, however many blocks have sent it, and answers every block.
The block joins the ids back by number and reassembles its documents by position; decoding looks
the ids up in the table of token bytes.

Words and answers travel packed, one row per block and bucket, not one row per word.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import bucket_count, written

#: Words after which a block ends, which bounds what a task holds.
BLOCK_WORDS = 8_000_000
#: Characters of the longest run between spaces that is remembered, and how many are.
RUN_CHARS, RUNS = 40, 300_000
LEVEL = 9
#: Numbers below it are written as one byte.
SHORT = 255

_encodings: dict[bytes, tuple[tiktoken.Encoding, list[bytes]]] = {}


def encoding(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The encoding of a rank file, and its table of token bytes."""
    key = xxhash.xxh128_digest(ranks + pattern.encode())
    if key not in _encodings:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        tokens = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}), tokens
    return _encodings[key]


class Words:
    """Cuts texts to words and numbers them.

    The pattern never joins a word with anything before a single space that stands between two
    characters that are not white space. So a text falls apart there, and what lies between is cut
    by the pattern once as long as it is remembered.
    """

    def __init__(self, pattern: str):
        self.cut = regex.compile(pattern).findall
        self.numbers: dict[str, int] = {}
        self.first: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}

    def numbered(self, text: str) -> bytes:
        numbers = self.numbers
        return np.array([numbers.setdefault(w, len(numbers)) for w in self.cut(text)], np.uint32).tobytes()

    def of(self, text: str) -> np.ndarray:
        """The numbers of the words of a text, in order."""
        if not text:
            return np.empty(0, np.uint32)
        head, *rest = text.split(" ")
        try:
            return np.frombuffer(b"".join([self.first[head], *[self.inner[r] for r in rest]]), np.uint32)
        except KeyError:
            pass
        if len(self.inner) > RUNS:
            self.inner.clear()
        out, open_run, known = [], head, self.first
        for part in rest:
            if part and open_run and not open_run[-1].isspace() and not part[0].isspace():
                out.append(self.run(open_run, known))
                open_run, known = part, self.inner
            else:
                open_run += " " + part
        out.append(self.run(open_run, known))
        return np.frombuffer(b"".join(out), np.uint32)

    def run(self, run: str, known: dict[str, bytes]) -> bytes:
        """Numbers of a run: at the beginning of the text, or after a space that belongs to it."""
        found = known.get(run)
        if found is None:
            found = self.numbered(run if known is self.first else " " + run)
            # Only runs that never join with their neighbours may be looked up part by part.
            if len(run) <= RUN_CHARS and " " not in run and run and not run[0].isspace() and not run[-1].isspace():
                if known is self.inner or len(known) < RUNS:
                    known[run] = found
        return found


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers byte by byte, lowest bytes of all first: it leaves long runs of zeros."""
    planes = [np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(planes))


def unpacked(data: bytes, sizes: list[int]) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), 0, []
    for size in sizes:
        out.append(np.ascontiguousarray(raw[at : at + 4 * size].reshape(4, size).T).view("<u4").ravel())
        at += 4 * size
    return out


def packed_order(order: np.ndarray) -> bytes:
    """Numbers of words, of which frequent ones are small: a byte each, and the rest of those above apart."""
    planes = np.ascontiguousarray((order[order >= SHORT] - np.uint32(SHORT)).astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.minimum(order, SHORT).astype(np.uint8).tobytes() + planes.tobytes())


def unpacked_order(data: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    order = raw[:size].astype(np.uint32)
    order[order == SHORT] += np.ascontiguousarray(raw[size:].reshape(4, -1).T).view("<u4").ravel()
    return order


def blocks(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Rows of two kinds: a block (documents, counts, words in order), or words that it sends to a bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        doc_kind = None

        def block(ids: list, orders: list[np.ndarray], words: Words) -> Iterator[pa.RecordBatch]:
            order = np.concatenate(orders) if orders else np.empty(0, np.uint32)
            # Frequent words get small numbers.
            by_count = np.argsort(-np.bincount(order, minlength=len(words.numbers)), kind="stable")
            renumbered = np.empty(len(by_count), np.uint32)
            renumbered[by_count] = np.arange(len(by_count), dtype=np.uint32)
            this, counts = part << 32 | number, [len(o) for o in orders]
            rows = [(this, None, len(order), packed_order(renumbered[order]), None, ids, counts)]
            names = np.array(list(words.numbers), object)[by_count] if len(by_count) else []
            data = [w.encode("utf-8", "replace") for w in names]
            where = np.array([xxhash.xxh64_intdigest(d) % buckets for d in data], np.int64)
            for bucket in np.unique(where):
                mine = np.flatnonzero(where == bucket)
                text = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([data[i] for i in mine]))
                sizes = np.array([len(data[i]) for i in mine], np.uint32)
                rows.append((this, int(bucket), len(mine), packed(np.diff(mine, prepend=0), sizes), text, None, None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(doc_kind), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["block", "bucket", "size", "numbers", "words", "ids", "counts"]
            )

        ids, orders, held, words = [], [], 0, Words(pattern)
        for batch in batches:
            doc_kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                orders.append(words.of(text.as_py()))
                held += len(orders[-1]) + 1
                if held >= BLOCK_WORDS:
                    yield from block(ids, orders, words)
                    ids, orders, held, words, number = [], [], 0, Words(pattern), number + 1
        if ids:
            yield from block(ids, orders, words)

    return docs.mapInArrow(
        cut, f"block long, bucket int, size long, numbers binary, words binary, ids array<{kind}>, counts array<long>"
    )


def encode_words(rows: DataFrame, ranks, pattern: str) -> DataFrame:
    """Answers (block, size, numbers, tokens, total) to rows of words: each distinct word of a bucket is encoded once."""

    def encode(table: pa.Table) -> pa.Table:
        encoder, _ = encoding(ranks.value, pattern)
        known: dict[bytes, list[int]] = {}
        out = []
        for row in table.to_pylist():
            steps, sizes = unpacked(row["numbers"], [row["size"]] * 2)
            text, ends = zstandard.ZstdDecompressor().decompress(row["words"]), np.cumsum(sizes).tolist()
            words = [text[a:b] for a, b in zip([0, *ends], ends)]
            for word in words:
                if word not in known:
                    known[word] = encoder.encode_ordinary(word.decode())
            found = [known[w] for w in words]
            lengths = np.array([len(f) for f in found], np.uint32)
            tokens = np.array([t for f in found for t in f], np.uint32)
            out.append((row["block"], row["size"], packed(steps, lengths, tokens), len(tokens)))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["block", "size", "numbers", "total"])

    return rows.groupBy("bucket").applyInArrow(encode, "block long, size long, numbers binary, total long")


def encode_corpus(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded; one row per input row.

    Ids are those that the rank file's encoding gives a whole text, special tokens being ordinary
    text; ``decoded`` is their bytes put together again. Digests are of the decimal ids with commas
    between, and of the decoded bytes. NULL is the empty text, which has no ids. Rows that repeat
    an id and rows without one are rows like any other. Without ``with_ids`` the last two columns
    are NULL.
    """
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # The words of a bucket go into one call: their number must follow the data, not the session alone.
    buckets = bucket_count(docs.sparkSession, docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)
    rows = written(blocks(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")), pattern, buckets), "words")
    kind = rows.schema["ids"].dataType.elementType.simpleString()
    sent = rows.filter("bucket is not null").select("block", "bucket", "size", "numbers", "words")
    answers = encode_words(sent, ranks, pattern)
    kept = rows.filter("bucket is null").select("block", "size", "numbers", "ids", "counts")

    def reassemble(own: pa.Table, found: pa.Table) -> pa.Table:
        _, token_bytes = encoding(ranks.value, pattern)
        words = sum(found.column("size").to_pylist())
        digits, data, lengths, tokens_of = [b""] * words, [b""] * words, np.zeros(words, np.int64), [None] * words
        for answer in found.to_pylist():
            steps, sizes, tokens = unpacked(answer["numbers"], [answer["size"], answer["size"], answer["total"]])
            numbers, tokens, ends = np.cumsum(steps).tolist(), tokens.tolist(), np.cumsum(sizes).tolist()
            lengths[numbers] = sizes
            for word, a, b in zip(numbers, [0, *ends], ends):
                some = tokens[a:b]
                digits[word] = b",".join([b"%d" % t for t in some])
                data[word] = b"".join([token_bytes[t] for t in some])
                if with_ids:
                    tokens_of[word] = some
        columns = [[] for _ in range(6)]
        for row in own.to_pylist():
            order, at = unpacked_order(row["numbers"], row["size"]), 0
            for doc, count in zip(row["ids"], row["counts"]):
                some = order[at : at + count]
                numbers, at = some.tolist(), at + count
                decoded = b"".join([data[i] for i in numbers])
                columns[0].append(doc)
                columns[1].append(int(lengths[some].sum()))
                columns[2].append(hashlib.sha256(b",".join([digits[i] for i in numbers])).hexdigest())
                columns[3].append(hashlib.sha256(decoded).hexdigest())
                columns[4].append([t for i in numbers for t in tokens_of[i]] if with_ids else None)
                columns[5].append(decoded if with_ids else None)
        kinds = [own.schema.field("ids").type.value_type, pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
        )

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded binary"
    return kept.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(reassemble, schema)
