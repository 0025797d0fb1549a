"""Exact duplicates by two passes of a Bloom filter; DataFrame functions only.

The first pass counts, per cell of a filter of ``BITS_PER_ROW`` cells a row, how many rows fall into
it. The second tests each row: only if all its cells were hit by two rows or more can its hash be
repeated. Those rows alone, without their texts, are grouped and joined by hash; all others pass
straight through as groups of one. The test has no false negatives, so the result is exact.

The filter is broadcast in slices of bounded size, one after another, so rows never shuffle for the
test, whatever their number. A slice costs a broadcast join, and ``SLICES_PER_PASS`` of them a pass
over the short rows. What is exchanged for the filter are its cells, two numbers per document.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import BROADCAST_ROWS, as_text, small_side, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BITS_PER_ROW = 16
HASHES = 2
WORD_BITS = 6
#: Slices of the filter that one plan joins; the rows are written before the next ones.
SLICES_PER_PASS = 8


def normalised(text: str) -> Column:
    """The text with every run of ASCII white space as one space; NULL is the empty text."""
    return F.regexp_replace(as_text(text), WHITE_SPACE, " ")


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One short row per document: id, digest of the normalised text, and a number that no other row has."""
    digest = F.unhex(F.sha2(F.encode(normalised(text_col), "UTF-8"), 256))
    return docs.select(
        F.col(id_col).alias("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row")
    )


def cells(cells_in_all: int) -> list[Column]:
    return [F.pmod(F.xxhash64("digest", F.lit(i)), F.lit(cells_in_all)) for i in range(HASHES)]


def repeat_filter(rows: DataFrame, cells_in_all: int) -> DataFrame:
    """First pass: (word, bits) of the cells that two rows or more have hit, 64 cells a word."""
    hit = rows.select(F.explode(F.array_distinct(F.array(*cells(cells_in_all)))).alias("cell"))
    repeated = hit.groupBy("cell").count().filter("count > 1")
    bit = F.expr(f"shiftleft(1L, cast(cell & {(1 << WORD_BITS) - 1} as int))")
    return repeated.groupBy(F.shiftright("cell", WORD_BITS).alias("word")).agg(F.bit_or(bit).alias("bits"))


def possibly_repeated(rows: DataFrame, words_per_slice: int = BROADCAST_ROWS) -> DataFrame:
    """Second pass: ``rows`` with ``possible``, false only for rows whose digest occurs once.

    Words are dealt to slices by hash, so a slice has about ``words_per_slice`` of them at most.
    """
    cells_in_all = max(1 << WORD_BITS, BITS_PER_ROW * rows.count())
    table = written(repeat_filter(rows, cells_in_all), "bloom")
    slices = max(1, math.ceil(table.count() / words_per_slice))
    for i, cell in enumerate(cells(cells_in_all)):
        rows = rows.withColumn(f"cell{i}", cell).withColumn(f"set{i}", F.lit(False))
    for number in range(slices):
        part = table.filter(F.pmod(F.xxhash64("word"), F.lit(slices)) == number)
        for i in range(HASHES):
            side = part.select(F.col("word").alias(f"word{i}"), F.col("bits").alias(f"bits{i}"))
            rows = rows.join(F.broadcast(side), F.shiftright(f"cell{i}", WORD_BITS) == F.col(f"word{i}"), "left")
            set_here = F.expr(f"shiftright(bits{i}, cast(cell{i} & {(1 << WORD_BITS) - 1} as int)) & 1L = 1L")
            rows = rows.withColumn(f"set{i}", F.col(f"set{i}") | F.coalesce(set_here, F.lit(False))).drop(f"word{i}", f"bits{i}")
        if number + 1 < slices and (number + 1) % SLICES_PER_PASS == 0:
            rows = written(rows, "probed")
    tests = [F.col(f"set{i}") for i in range(HASHES)]
    return rows.select("doc_id", "digest", "row", reduce(Column.__and__, tests).alias("possible"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after replacing each run of ASCII white space by one space; NULL
    and the empty text are equal. The row with the smallest id is kept. A NULL id counts as larger
    than any other. Rows that repeat an id with an equal text count as copies: exactly one row of
    a group is kept, and ``keep_id`` is its id. Other columns, whatever their names, are not read.
    An empty table gives an empty result.
    """
    rows = written(fingerprints(docs, id_col, text_col), "digests")
    tested = possibly_repeated(rows)
    possible = written(tested.filter("possible").drop("possible"), "repeats")
    # Partial aggregation takes a digest that a third of the rows have down to a row per task.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    groups = written(possible.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    # Both sides are plain tables, so a partition that a digest of very many rows makes too large is split at run time.
    grouped = possible.join(groups, "digest").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
    )
    alone = tested.filter(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return alone.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its exact copies, all columns as they were.

    Dropped rows are found by id and digest, so texts travel only if the dropped rows are too many
    to broadcast. Rows that share both id and text with the kept row are one document given twice
    and stay.
    """
    dropped = exact_groups(docs, id_col, text_col).filter("not kept and not (doc_id <=> keep_id)")
    dropped = written(dropped.select(F.col("doc_id").alias("_gone"), F.unhex("text_sha256").alias("_digest")).distinct(), "copies")
    digest = F.unhex(F.sha2(F.encode(normalised(text_col), "UTF-8"), 256))
    side = small_side(dropped, dropped.count())
    return docs.join(side, F.col(id_col).eqNullSafe(F.col("_gone")) & (digest == F.col("_digest")), "left_anti")
