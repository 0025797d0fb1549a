"""Near copies as a stage of the pipeline: SimHash candidates from BK-trees, and an exact check of similarity.

:mod:`snapledger.llm.simhash` links by at most four bits of one fingerprint, which finds few of the
documents that share four fifths of their shingles. Here the radius is wide, the shards are chosen so
that similar documents meet, and every link is checked on the whole sets of shingles:

1. Each document gets a SimHash of its set of five-word shingles and ``BANDS`` keys of ``ROWS`` least
   hash values each. Documents with equal sets count as one.
2. Documents that share a key meet in a shard. It builds BK-trees of their fingerprints and follows
   only the edges within ``RADIUS``. What this joins are loose groups.
3. Only the documents of loose groups send their sets. In a group, the trees are searched again, and a
   pair is linked if its sets have a Jaccard similarity of 0.8 or more.

A pair at 0.8 shares no key with chance 0.0004 and exceeds the radius with chance 0.0002, a closer
pair less. A link that is made is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm import simhash
from snapledger.llm.common import give_back, small_side, written
from snapledger.llm.components import Forest, components, paired_chunks, runs

SHINGLE = 5
#: The similarity of a link, as a fraction.
LEAST, OF = 4, 5
BANDS, ROWS = 20, 5
RADIUS = 20
#: Fingerprints of one key, and documents of one loose group, that are searched together at most.
TREE, GROUP = 4096, 1024
ROWS_PER_TASK, SETS_PER_TASK = 32_768, 1024
#: Shingles that are hashed together.
HELD = 4096
_RANDOM = np.random.default_rng(2024)
SALTS = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
FACTORS = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """The hashes of the different shingles of a text, in order. A text of fewer words has one, the whole of
    its words; all texts without a word, NULL among them, have the same one."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    last = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[k : k + SHINGLE])) for k in range(last)], np.uint64))


def fingerprint(found: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed number."""
    counts = np.zeros(simhash.BITS, np.int64)
    for at in range(0, len(found), HELD):
        some = found[at : at + HELD].astype("<u8").view(np.uint8)
        counts += np.unpackbits(some, bitorder="little").reshape(-1, simhash.BITS).sum(0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(found)).astype(np.uint8), bitorder="little").view("<i8")[0])


def band_keys(found: np.ndarray) -> np.ndarray:
    """One number per band, from the least of its hash values under ``ROWS`` orders."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), HELD):
        least = np.minimum(least, ((found[at : at + HELD] ^ SALTS) * FACTORS).min(1))
    keys = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest of the set of shingles, fp, keys: one row per document; whole texts."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, marks, keys = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                marks.append(fingerprint(found))
                keys.append(band_keys(found))
            lists = pa.ListArray.from_arrays(np.arange(0, BANDS * len(keys) + 1, BANDS, np.int32), np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(marks, pa.int64()), lists], ["id", "digest", "fp", "keys"])
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(mark, "id long, digest binary, fp long, keys array<long>")


def loose_links(marks: DataFrame) -> DataFrame:
    """Links (a, b) that join all documents that share a key and lie within the radius of each other."""
    keyed = written(marks.select("id", "fp", F.posexplode("keys").alias("which", "key")), "keyed")
    dealt = paired_chunks(keyed, ["which", "key"], "id", TREE, ROWS_PER_TASK)

    def link(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("id", "fp", "which", "key", "low", "high", "in_low", "in_high")}
        fps, forest = col["fp"].view(np.uint64), Forest(table.num_rows)
        for group in runs(col["which"], col["key"], col["low"], col["high"]):
            if len(group) > 1:
                simhash.link_tree(fps, group[col["in_low"][group]], group[col["in_high"][group]], RADIUS, forest)
        a, b = forest.pairs()
        give_back()
        return pa.table({"a": col["id"][a], "b": col["id"][b]})

    found = dealt.select("shard", "id", "fp", "which", "key", "low", "high", "in_low", "in_high")
    return found.groupBy("shard").applyInArrow(link, "a long, b long").distinct()


class CheckedForest(Forest):
    """Joins only places whose sets are similar enough. Places that are joined already are not compared."""

    def __init__(self, sets: list[np.ndarray]):
        super().__init__(len(sets))
        self.sizes = np.array([len(s) for s in sets], np.int64)
        different, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        self.numbers = np.split(numbers, np.cumsum(self.sizes)[:-1])
        self.mine = np.zeros(len(different), bool)

    def join(self, places: np.ndarray) -> None:
        """Join the last place with those of the others that are similar to it."""
        place, others = places[-1], places[:-1]
        size, sizes = self.sizes[place], self.sizes[others]
        others = others[OF * np.minimum(size, sizes) >= LEAST * np.maximum(size, sizes)]
        others = others[self.roots(others) != self.roots(places[-1:])[0]]
        if not len(others):
            return
        self.mine[self.numbers[place]] = True
        similar = []
        for some in np.array_split(others, -(-int(self.sizes[others].sum()) // (1 << 22))):
            if len(some):
                both = self.mine[np.concatenate([self.numbers[o] for o in some.tolist()])]
                starts = np.cumsum(self.sizes[some]) - self.sizes[some]
                common = np.add.reduceat(both.astype(np.int64), starts)
                similar.append(some[OF * common >= LEAST * (size + self.sizes[some] - common)])
        self.mine[self.numbers[place]] = False
        super().join(np.append(np.concatenate(similar), place))


def checked_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that join, in each loose group of ``sets`` (id, loose, fp, shingles), all similar pairs."""
    dealt = paired_chunks(sets, ["loose"], "id", GROUP, SETS_PER_TASK)

    def link(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("id", "fp", "loose", "low", "high", "in_low", "in_high")}
        forest = CheckedForest([np.frombuffer(s.as_buffer(), "<u8") for s in table.column("shingles")])
        for group in runs(col["loose"], col["low"], col["high"]):
            if len(group) > 1:
                simhash.link_tree(col["fp"].view(np.uint64), group[col["in_low"][group]], group[col["in_high"][group]], RADIUS, forest)
        a, b = forest.pairs()
        give_back()
        return pa.table({"a": col["id"][a], "b": col["id"][b]})

    found = dealt.select("shard", "id", "fp", "loose", "shingles", "low", "high", "in_low", "in_high")
    return found.groupBy("shard").applyInArrow(link, "a long, b long").distinct()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component): the documents that are linked with another one, and the smallest id that links reach.

    A link is a Jaccard similarity of 0.8 or more between the sets of five-word shingles, A-Z lower-cased; a
    text of fewer words is one shingle, and texts without a word (NULL, empty) are equal. Ids are whole
    numbers that are neither NULL nor repeated. Other columns are not read. An empty table gives no rows.
    """
    rows = written(signatures(docs, id_col, text_col), "signatures")
    marks = rows.groupBy("digest").agg(F.min(F.struct("id", "fp", "keys")).alias("m"))
    marks = written(marks.select("digest", "m.*"), "marks")
    loose = written(components(loose_links(marks.drop("digest"))), "loose")
    chosen = marks.select("id", "fp").join(small_side(loose, loose.count()), F.col("id") == F.col("node"))
    chosen = written(chosen.select("id", "fp", F.col("component").alias("loose")), "chosen")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([shingles(t.as_py()).astype("<u8").tobytes() for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["id", "loose", "fp", "shingles"])
        give_back()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(small_side(chosen, chosen.count()), "id").select("id", "loose", "fp", "text")
    links = checked_links(written(texts.mapInArrow(hashed, "id long, loose long, fp long, shingles binary"), "sets"))
    # Written, so that a digest that very many rows have can be split where they meet.
    copies = rows.select("id", "digest").join(marks.select("digest", F.col("id").alias("first")), "digest").filter("id <> first")
    return components(links.unionByName(copies.select(F.col("id").alias("a"), F.col("first").alias("b"))))


def near_copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id per input row: what :func:`simhash.near_duplicates` and :func:`similar_groups` link together."""
    close = written(simhash.near_duplicates(docs, id_col, text_col).select("doc_id", "component_id"), "close")
    links = close.filter("doc_id <> component_id").select(F.col("doc_id").cast("long").alias("a"), F.col("component_id").alias("b"))
    links = links.unionByName(similar_groups(docs, id_col, text_col).filter("node <> component").toDF("a", "b"))
    found = written(components(links), "components")
    joined = close.join(small_side(found, found.count()), F.col("doc_id") == F.col("node"), "left")
    return joined.select("doc_id", F.coalesce("component", F.col("doc_id").cast("long")).alias("component_id"))
