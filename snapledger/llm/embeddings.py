"""Near-duplicate vectors by randomly rotated binary codes with correction factors.

A unit vector is rotated and kept as the signs of its coordinates, with the factor by which the sign
vector falls short of the vector itself. The product of one vector's signs with another's rotated
coordinates, divided by the factor, estimates their cosine without bias, and the factor bounds the
error. Pairs come from further rotations, whose signs are cut into bands: vectors that agree in a
band meet. Only pairs whose upper bounds reach the threshold both ways go on. They join vectors to
candidate groups, and inside these every pair is computed exactly in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import written
from snapledger.llm.components import Forest, components, paired_chunks, runs

THRESHOLD = 0.9
#: Chance that a pair just at the threshold shares a band; pairs above it share one more likely.
RECALL = 0.999
#: Standard errors by which an estimate may be too low.
ERRORS = 4.0
#: Vectors that agree in a band by chance, on average.
CHANCE = 8
SEED = 20_240
GROUP = 4096
ROWS_PER_TASK = 16_384
CODE_SCHEMA = "id long, dim int, band int, key long, code binary, factor float, coords binary, scale float"


def rotation(dim: int, which: int) -> np.ndarray:
    """A random rotation, the same wherever it is asked for."""
    drawn, r = np.linalg.qr(np.random.default_rng((SEED, dim, which)).standard_normal((dim, dim)))
    return drawn * np.sign(np.diag(r))


def band_plan(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits per band and the number of bands that reach the recall at the threshold."""
    bits = max(1, math.ceil(math.log2(max(2, rows / CHANCE))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-agree))


def units(vectors: list, dim: int) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares stay finite."""
    rows = np.array(vectors, np.float64).reshape(len(vectors), dim)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector has only finite components, not all zero."""
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.filter(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0))


def codes(reps: DataFrame, bits: int, bands: int) -> DataFrame:
    """One row per vector and band: the band's key, the code with its factor, and the coordinates as small numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[tuple[int, int], np.ndarray] = {}

        def turn(rows: np.ndarray, which: int) -> np.ndarray:
            at = rows.shape[1], which
            if at not in turned:
                turned[at] = rotation(*at)
            return rows @ turned[at].T

        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vectors])
            rng = np.random.default_rng(SEED)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                rows = units([vectors[i] for i in own], int(dim))
                main = turn(rows, 0)
                code = np.packbits(main >= 0, axis=1)
                factor = np.abs(main).sum(1) / math.sqrt(dim)
                scale = np.abs(main).max(1) / 127
                # Rounded up or down at random, so that the rounding adds no bias.
                coords = np.floor(main / scale[:, None] + rng.random(main.shape)).clip(-127, 127).astype(np.int8)
                signs = np.hstack([turn(rows, 1 + r) >= 0 for r in range(math.ceil(bits * bands / dim))])
                weights = np.int64(1) << np.arange(bits, dtype=np.int64)
                for band in range(bands):
                    key = signs[:, band * bits : (band + 1) * bits] @ weights
                    n = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[own]), pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, band, np.int32)),
                            pa.array(key), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor.astype(np.float32)),
                            pa.array([c.tobytes() for c in coords], pa.binary()), pa.array(scale.astype(np.float32)),
                        ],
                        ["id", "dim", "band", "key", "code", "factor", "coords", "scale"],
                    )

    return reps.select("id", "vec").mapInArrow(encode, CODE_SCHEMA)


def upper_bounds(signs, factor, coords, other_signs, other_factor, other_coords) -> np.ndarray:
    """For all pairs of two sets, the lesser of the upper bounds that either side's code gives."""
    dim = signs.shape[1]

    def bound(s, f, q):
        slack = ERRORS * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(1, dim - 1))
        return (s @ q.T) / (math.sqrt(dim) * f)[:, None] + slack[:, None]

    return np.minimum(bound(signs, factor, other_coords), bound(other_signs, other_factor, coords).T)


def candidate_links(reps: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Links (a, b) that join all vectors that share a band and whose bounds reach the threshold."""
    bits, bands = band_plan(reps.count(), threshold, recall)
    coded = written(codes(reps, bits, bands), "codes")
    dealt = paired_chunks(coded, ["dim", "band", "key"], "id", GROUP, ROWS_PER_TASK)

    def link(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("id", "dim", "band", "key", "low", "high", "in_low", "in_high", "factor", "scale")}
        code, coords = table.column("code").combine_chunks(), table.column("coords").combine_chunks()
        forest = Forest(table.num_rows)
        for group in runs(col["dim"], col["band"], col["key"], col["low"], col["high"]):
            if len(group) < 2:
                continue
            dim, at = int(col["dim"][group[0]]), pa.array(group)
            raw = np.frombuffer(b"".join(code.take(at).to_pylist()), np.uint8).reshape(len(group), -1)
            signs = np.unpackbits(raw, axis=1)[:, :dim].astype(np.float32) * 2 - 1
            small = np.frombuffer(b"".join(coords.take(at).to_pylist()), np.int8).reshape(len(group), dim).astype(np.float32)
            small *= col["scale"][group][:, None]
            factor = col["factor"][group]
            low, high = np.flatnonzero(col["in_low"][group]), np.flatnonzero(col["in_high"][group])
            for some in np.array_split(low, max(1, len(low) * len(high) >> 20)):
                if not len(some) or not len(high):
                    continue
                near = upper_bounds(signs[some], factor[some], small[some], signs[high], factor[high], small[high]) >= threshold
                near &= some[:, None] != high
                for i in np.flatnonzero(near.any(1)):
                    forest.join(group[np.append(high[near[i]], some[i])])
        a, b = forest.pairs()
        return pa.table({"a": col["id"][a], "b": col["id"][b]})

    return dealt.groupBy("shard").applyInArrow(link, "a long, b long").distinct()


def exact_links(reps: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Inside each candidate group: (a, b, n) where b and n are either a joining link or the vectors linked with a."""
    rows = reps.join(groups.select(F.col("node").alias("id"), "component"), "id").withColumn("dim", F.size("vec"))
    dealt = paired_chunks(written(rows, "groups"), ["component", "dim"], "id", GROUP, GROUP)

    def compute(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("id", "n", "component", "dim", "low", "high", "in_low", "in_high")}
        vec, forest, linked = table.column("vec").combine_chunks(), Forest(table.num_rows), np.zeros(table.num_rows, np.int64)
        for group in runs(col["component"], col["dim"], col["low"], col["high"]):
            rows = units(vec.take(pa.array(group)).to_pylist(), int(col["dim"][group[0]]))
            low, high = np.flatnonzero(col["in_low"][group]), np.flatnonzero(col["in_high"][group])
            same_chunk = col["low"][group[0]] == col["high"][group[0]]
            for some in np.array_split(low, max(1, len(low) * len(high) >> 20)):
                if not len(some) or not len(high):
                    continue
                near = (rows[some] @ rows[high].T >= threshold) & (some[:, None] != high)
                linked[group[some]] += near @ col["n"][group[high]]
                if not same_chunk:
                    linked[group[high]] += col["n"][group[some]] @ near
                for i in np.flatnonzero(near.any(1)):
                    forest.join(group[np.append(high[near[i]], some[i])])
        a, b = forest.pairs()
        some = np.flatnonzero(linked)
        ids = np.concatenate((col["id"][a], col["id"][some]))
        others = pa.array(np.concatenate((col["id"][b], np.zeros(len(some), np.int64))), mask=np.arange(len(ids)) >= len(a))
        return pa.table({"a": ids, "b": others, "n": np.concatenate((np.zeros(len(a), np.int64), linked[some]))})

    return dealt.groupBy("shard").applyInArrow(compute, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """vec_id, n_links, component_id, kept per input row; ids are whole numbers.

    Equal vectors are searched once and count as linked. Vectors that are NULL, empty, all zero or
    have a NULL or non-finite component link with nothing, and vectors of unlike length don't link.
    Rows that repeat an id count each as a vector. A row with a NULL id shares the links of its
    vector but names no component and isn't kept, if another row has the same vector; alone it
    links with nothing. Links are exact cosines in double precision: none is wrong, and one is
    missed only if a pair shares no band and no chain of candidates, or lies beyond the bound.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    # Partial aggregation takes a vector that a third of the rows have down to a row per task.
    reps = usable(rows, "vec").groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")).filter("id is not null")
    reps = written(reps.select("id", "n", "vec"), "vectors")
    groups = components(candidate_links(reps, threshold, recall))
    found = written(exact_links(reps, groups, threshold), "exact")
    joined = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("linked")).withColumnRenamed("a", "id")
    by_rep = reps.join(links, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
    by_vec = by_rep.select(
        "vec", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    out = rows.join(by_vec, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
