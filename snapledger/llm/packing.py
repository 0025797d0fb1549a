"""Packing documents into sequences along a Hilbert curve.

Documents are tokenised, their token counts hashed to a vector with signs, and the vector projected
to a few dimensions, whose position on a Hilbert curve puts like documents next to each other. The
documents follow one another in that order, and every 4096 tokens a new sequence begins: a document
is cut wherever a sequence ends, so only the last sequence needs padding.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from snapledger.llm.common import give_back, running_total, written
from snapledger.llm.hilbert_shards import curve_index

LENGTH = 4096
END = 2
DIMS = 3
BITS = 10
HASHED = 256
SEED = 7
#: Words, and pieces of words, whose ids a task remembers, and the longest that it remembers.
WORDS, PIECE_COUNT, WORD_CHARS = 100_000, 400_000, 64
#: Ids that a task holds before it passes their pieces on.
HELD = 1 << 20
PIECE = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

#: Characters before it are Latin, and the pattern below cuts them as the tokenizer does.
LATIN = "\u0250"
#: What the tokenizer cuts words to after lower-casing (a fixed pattern of its file).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
#: Marks of ASCII, which the pattern leaves together at the end of a word.
MARKS = string.punctuation
#: Words of characters before LATIN, but for the one that two characters are the lower case of.
LATIN_WORD = r"^[\x{0}-\x{12f}\x{131}-\x{24f}]+$"
#: Pieces that are encoded in one call, and documents whose words are looked up together.
CALL, TOGETHER = 2000, 1000

_tokenizers: dict[int, "WordTokenizer"] = {}


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space and never joins across it.

    Then the ids of a text are those of its words one after another, and each different word of many
    texts is looked up once. A word in Latin letters is cut to the pieces that the tokenizer encodes
    one by one; a piece that is not remembered is encoded with many others in one call, by the same
    merges without the steps that lower-case and cut. Other words are given to the tokenizer as they
    are.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(spec)
        # The names of special tokens are ordinary text when they occur in a document.
        self.tokenizer.encode_special_tokens = True
        self.merges = Tokenizer.from_str(spec)
        self.merges.encode_special_tokens = True
        self.merges.normalizer = None
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True

    @classmethod
    def of(cls, spec: str) -> "WordTokenizer":
        """The tokenizer of this process."""
        key = hash(spec)
        if key not in _tokenizers:
            _tokenizers[key] = cls(spec)
        return _tokenizers[key]

    @staticmethod
    def encode(tokenizer: Tokenizer, texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces. Each ends with a token that marks the end of a word."""
        for at in range(0, len(pieces), CALL):
            some = pieces[at : at + CALL]
            (raw,) = self.encode(self.merges, [" ".join(some)])
            ends = (4 * (np.flatnonzero(self.is_end[np.frombuffer(raw, np.uint32)]) + 1)).tolist()
            parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
            self.pieces.update(zip(some, parts if len(parts) == len(some) else self.encode(self.tokenizer, some)))

    def forget(self) -> None:
        """Give the memory back: a process outlives its tasks and may have nothing to do for long."""
        self.words, self.pieces = {}, {}
        give_back()

    def others(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not letters with marks after them."""
        known, new, cut = self.words, [], {}
        for word in words:
            if word in known:
                continue
            if word.isascii() or max(word) < LATIN:
                # No character before LATIN has another composed form, so composing changes nothing.
                cut[word] = PIECES.findall(word.lower())
            else:
                new.append(word)
        self.learn(list({p for own in cut.values() for p in own if p not in self.pieces}))
        for word, own in cut.items():
            known[word] = b"".join([self.pieces[p] for p in own])
        known.update(zip(new, self.encode(self.tokenizer, new)))
        return [known[w] for w in words]

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text.

        Different words, and of these the different pieces, are found by dictionary encoding, so what
        is done one by one grows with the vocabulary and not with the text.
        """
        for memory, most in ((self.words, WORDS), (self.pieces, PIECE_COUNT)):
            if len(memory) > most:
                memory.clear()
        lists = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        words, place = coded.dictionary, coded.indices.to_numpy()
        lower = pc.utf8_lower(words)
        core = pc.utf8_rtrim(lower, characters=MARKS)
        plain = pc.and_(pc.match_substring_regex(words, LATIN_WORD), pc.match_substring_regex(core, r"^\p{L}+$"))
        tail = pc.replace_substring_regex(lower.filter(plain), r"^\p{L}+", "")
        pieces = pa.concat_arrays([core.filter(plain), tail]).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.pieces[""] = b""
        self.learn([p for p in names if p not in self.pieces])
        odd = words.filter(pc.invert(plain)).to_numpy(zero_copy_only=False).tolist()
        parts = [self.pieces[p] for p in names] + self.others(odd) + [b""]
        # Each word is two parts, of which the second is empty more often than not.
        mask, numbers = plain.to_numpy(zero_copy_only=False), pieces.indices.to_numpy()
        two = np.full((len(words), 2), len(parts) - 1, np.int64)
        two[mask, 0], two[mask, 1] = numbers[: mask.sum()], numbers[mask.sum() :]
        two[~mask, 0] = np.arange(len(names), len(names) + len(odd))
        place = two[place].ravel()
        flat = np.frombuffer(b"".join(parts), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        begins = np.cumsum(lengths) - lengths
        long = lengths[place]
        ends = np.cumsum(long)
        total = int(ends[-1]) if len(ends) else 0
        out = flat[np.repeat(begins[place] - ends + long, long) + np.arange(total)]
        starts = np.concatenate(([0], ends))[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())].tolist()
        for memory, some in ((self.words, odd), (self.pieces, names)):
            for name in some:
                if len(name) > WORD_CHARS:
                    memory.pop(name, None)
        return [out[a:b] for a, b in zip(starts, starts[1:])]


class Projection:
    """Coordinates of a document: its hashed token counts, scaled to length one, on a few random axes."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.multiplier = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
        self.axes = rng.standard_normal((HASHED, DIMS))

    def steps(self, ids: np.ndarray) -> np.ndarray:
        mixed = ids.astype(np.uint64) * self.multiplier >> np.uint64(48)
        signs = np.where(mixed & np.uint64(1), 1.0, -1.0)
        counts = np.bincount((mixed >> np.uint64(1)).astype(np.int64) % HASHED, signs, HASHED)
        size = np.sqrt((counts * counts).sum())
        place = counts @ self.axes / size if size else np.zeros(DIMS)
        return ((place.clip(-4, 4) + 4) / 8 * ((1 << BITS) - 1)).astype(np.int64)


def tokenised(docs: DataFrame, spec_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """doc_id, tokens (with the end id), ids (compressed 32-bit ids), curve, row, one row per input row; written."""
    with open(spec_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, projection, pack = WordTokenizer.of(spec.value), Projection(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            counts, steps, packed = [], [], []
            for at in range(0, batch.num_rows, TOGETHER):
                for ids in tokenizer.ids(batch.column(1).slice(at, TOGETHER)):
                    steps.append(projection.steps(ids))
                    ids = np.append(ids, np.uint32(end))
                    counts.append(len(ids))
                    packed.append(pack.compress(ids.tobytes()))
            steps = np.array(steps, np.int64).reshape(-1, DIMS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), *(pa.array(steps[:, d]) for d in range(DIMS))],
                ["doc_id", "tokens", "ids", *(f"s{d}" for d in range(DIMS))],
            )
        tokenizer.forget()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    steps = ", ".join(f"s{d} long" for d in range(DIMS))
    out = rows.mapInArrow(encode, f"doc_id {kind}, tokens long, ids binary, {steps}")
    curve = curve_index([F.col(f"s{d}") for d in range(DIMS)], BITS)
    return written(out.select("doc_id", "tokens", "ids", curve.alias("curve"), F.monotonically_increasing_id().alias("row")), "tokens")


def pack(
    docs: DataFrame,
    spec_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end: int = END,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (array), ids_crc32, doc_tokens, sequence_id, offset.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's. Every document
    has at least its end id, so NULL and empty texts make a piece too. Documents at the same place
    of the curve follow by id, NULL first; rows that repeat an id are documents of their own. All
    sequences but the last are full. An empty table gives no pieces. Without
    ``with_ids`` that column is NULL.
    """
    rows = tokenised(docs, spec_path, id_col, text_col, end)
    kind = rows.schema["doc_id"].dataType.simpleString()
    order = running_total(rows.select("curve", "doc_id", "row", "tokens"), ["curve", "doc_id", "row"], "tokens")
    placed = rows.select("doc_id", "tokens", "ids", "row").join(order.select("row", F.col("start").alias("first")), "row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def table(out: list[tuple], doc_kind: pa.DataType) -> pa.RecordBatch:
            kinds = [doc_kind, pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.int64()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], PIECE)

        for batch in batches:
            out, held = [], 0
            for doc, packed, first in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = np.frombuffer(unpack.decompress(packed.as_buffer()), np.uint32)
                at = 0
                while at < len(ids):
                    sequence, offset = divmod(first + at, length)
                    some = ids[at : at + length - offset]
                    shown = some.astype(np.int64) if with_ids else None
                    out.append((doc, at, len(some), shown, zlib.crc32(some.tobytes()), len(ids), sequence, offset))
                    at += len(some)
                    held += len(some)
                if held > HELD:
                    yield table(out, batch.schema.field(0).type)
                    out, held = [], 0
            if out:
                yield table(out, batch.schema.field(0).type)

    schema = f"doc_id {kind}, start long, length long, ids array<long>, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.select("doc_id", "ids", "first").mapInArrow(cut, schema)
