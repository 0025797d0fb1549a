"""Near duplicates by SimHash fingerprints, searched with BK-trees.

Distinct fingerprints are dealt to shards by parts of their bits: of r + k parts at least k agree
between fingerprints with at most r differing bits, so every linked pair meets in a shard. A shard
builds BK-trees, whose children are keyed by their integer Hamming distance to the parent, and a
search follows only the edges whose key lies within the radius of its own distance. The trees travel
with their shards: all trees together grow with the corpus and are too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import small_side, written
from snapledger.llm.components import Forest, components, paired_chunks, runs

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Distinct fingerprints that a tree holds at most; a larger group is searched tree by tree.
TREE = 16_384
#: Below this many fingerprints a node compares them all instead of branching.
LEAF = 12
ROWS_PER_TASK = 32_768
#: Fingerprints that agree in a key by chance, on average, before keys of more parts are taken.
CHANCE = 512
HELD = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits that over half of the word shingles' hashes have; zero for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    data = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    starts, ends = starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, last, HELD):
        some = [digest(data[a:b], SEED) for a, b in zip(starts[at : at + HELD], ends[at : at + HELD])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(0, dtype=np.int32)
    ones = (2 * counts > last).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number), one row per input row; whole texts."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(mark, f"doc_id {kind}, fp long")


def shard_keys(column: str, rows: int, radius: int) -> list[Column]:
    """Keys of which two fingerprints within the radius share at least one."""
    equal = 1
    while rows >> (BITS * equal // (radius + equal)) > CHANCE and equal < 4:
        equal += 1
    parts = radius + equal
    edges = [BITS * i // parts for i in range(parts + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    keys = []
    for chosen in combinations(masks, equal):
        mask = sum(chosen)
        keys.append(F.col(column).bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask)))
    return keys


def link_tree(marks: np.ndarray, members: np.ndarray, asking: np.ndarray, radius: int, forest: Forest) -> None:
    """Join in ``forest`` every place in ``asking`` with the places of ``members`` within the radius.

    The first member is the root, and the others go below it by their distance. A search goes on
    only below distances that differ from its own by the radius at most.
    """
    waiting = [(members, asking)]
    while waiting:
        members, asking = waiting.pop()
        if len(members) <= LEAF:
            near = np.bitwise_count(marks[members][:, None] ^ marks[asking]) <= radius
            for place, row in zip(members, near):
                if row.any():
                    forest.join(np.append(asking[row], place))
            continue
        root, rest = members[0], members[1:]
        asked = np.bitwise_count(marks[asking] ^ marks[root]).astype(np.int16)
        near = asked <= radius
        if near.any():
            forest.join(np.append(asking[near], root))
        below = np.bitwise_count(marks[rest] ^ marks[root]).astype(np.int16)
        for distance in np.unique(below):
            follow = asking[np.abs(asked - distance) <= radius]
            if len(follow):
                waiting.append((rest[below == distance], follow))


def near_links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the ids of ``marks`` (id, fp; fp distinct): enough to join all that are linked."""
    total = marks.count()
    keys = shard_keys("fp", total, radius)
    keyed = marks.select("id", "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("which"), k.alias("key")) for i, k in enumerate(keys)])))
    keyed = written(keyed.select("id", "fp", "col.which", "col.key"), "keyed")
    dealt = paired_chunks(keyed, ["which", "key"], "fp", TREE, ROWS_PER_TASK)

    def link(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("id", "fp", "which", "key", "low", "high", "in_low", "in_high")}
        fps, forest = col["fp"].view(np.uint64), Forest(table.num_rows)
        for group in runs(col["which"], col["key"], col["low"], col["high"]):
            if len(group) > 1:
                link_tree(fps, group[col["in_low"][group]], group[col["in_high"][group]], radius, forest)
        a, b = forest.pairs()
        return pa.table({"a": col["id"][a], "b": col["id"][b]})

    found = dealt.select("shard", "id", "fp", "which", "key", "low", "high", "in_low", "in_high")
    return found.groupBy("shard").applyInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id per input row; ids are whole numbers.

    A component is all documents that links reach, a link being at most ``radius`` differing bits;
    its id is its smallest doc_id. Equal fingerprints are searched once. Texts that are NULL, empty
    or without words have fingerprint zero and are linked like any other. Rows that repeat an id
    share their component; rows with a NULL id get a component id as any row, but never name one,
    unless their fingerprint links with no row that has an id: then it is NULL. Other columns are
    not read. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    marks = rows.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").cast("long").alias("id"))
    marks = written(marks, "marks")
    found = written(components(near_links(marks, radius)), "components")
    by_mark = marks.join(small_side(found, found.count()), F.col("id") == F.col("node"), "left")
    by_mark = by_mark.select("fp", F.coalesce("component", "id").alias("component_id"))
    # Fingerprints that very many rows share make a skewed partition, which is split at run time.
    return rows.join(by_mark, "fp", "left").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", find=near_duplicates) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; all columns as they were.
    ``find`` gives the components, as :func:`near_duplicates` does.

    A NULL id counts as larger than any other. Where ids are repeated or NULL, rows count one by one:
    each is numbered in a written copy of the table, and of rows that share the smallest id of their
    component one stays. Unlike texts that share an id both stay.
    """
    if not _names_rows(docs, id_col):
        return _one_row_of_each(docs, id_col, text_col, find)
    groups = find(docs, id_col, text_col)
    gone = written(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near")
    return docs.join(small_side(gone, gone.count()), F.col(id_col) == F.col("_gone"), "left_anti")


def _names_rows(docs: DataFrame, id_col: str) -> bool:
    """Whether no id is NULL or repeated. Copies of an id are folded before they are exchanged."""
    counted = docs.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1 or id is null").isEmpty()


def _one_row_of_each(docs: DataFrame, id_col: str, text_col: str, find) -> DataFrame:
    row = "_row"
    while row in docs.columns:
        row += "_"
    table = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = find(table, row, text_col).select(F.col("doc_id").alias(row), "component_id")
    ids = table.select(row, F.col(id_col).alias("_id"))
    first = ids.join(groups, row).groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", row)).alias("m"))
    kept = written(first.select(F.col(f"m.{row}").alias("_kept")), "near")
    return table.join(small_side(kept, kept.count()), F.col(row) == F.col("_kept"), "left_semi").drop(row)
