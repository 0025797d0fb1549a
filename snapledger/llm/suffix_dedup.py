"""Removal of repeated byte strings by a sparse suffix array that is sorted in ranges.

Every string of ``LENGTH`` bytes has an anchor: the leftmost of its ``GRAM``-byte grams with the
least hash. Equal strings have their anchors at the same place, so it is enough to sort the suffixes
that begin at anchors, about one position in 35. Neighbouring strings with one anchor make a
segment.

1. Documents are gathered to blocks, and each block sends the distinct hashes of its anchors. Only
   segments whose hash another block or another place of the block has go on.
2. Grams of sampled anchors are splitters. They deal the segments to buckets by the leading bytes
   of the suffix at the anchor; a gram never lies on both sides of a splitter.
3. A bucket sorts the suffixes by multikey quicksort, eight bytes at a time, and the bytes before
   the anchors likewise. Common lengths of neighbours give, for every distance between the begin of
   a string and its anchor, the classes of equal strings; all but the first string of a class are
   answered to their blocks as repeats.
4. Blocks take the bytes that repeats cover out of their documents.

Equal segments count once per block before they travel, so a passage that very many documents share
makes one row per block. A gram that very many different segments share is passed over in favour of
the next one, as far as a string has others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import bucket_count, giving_back, written

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1
BLOCK_BYTES = 8 << 20
#: String begins that are hashed at a time, so that the arrays stay in the processor's cache.
CHUNK = 1 << 17
PAD = 128
#: Blocks whose anchors are sampled for splitters, and anchors taken of each.
SAMPLE_BLOCKS, SAMPLE_ANCHORS = 16, 4096
TOKEN = 8
#: Different segments with one gram from which the gram is passed over.
COMMON = 10_000
C1, C2, C3, C4, C5, BASE = (
    np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0x5851F42D4C957F2D)
)
LAST = np.iinfo(np.int64).max

_powers: list[np.ndarray] = []


def powers() -> list[np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2^64."""
    if not _powers:
        size, inverse = CHUNK + 2 * LENGTH, pow(int(BASE), -1, 1 << 64)
        for base in (int(BASE), inverse):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers.append(np.multiply.accumulate(factors))
    return _powers


def tokens(data: np.ndarray, start: int, size: int, order: str = "<u8") -> np.ndarray:
    """The eight bytes that begin at each of ``size`` places, as numbers."""
    return np.array(np.ndarray((size,), order, data, start, (1,)), np.uint64)


def among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Whether each value is one of a few chosen ones."""
    low = np.uint64((1 << 16) - 1)
    table = np.zeros(1 << 16, bool)
    table[chosen & low] = True
    out = table[values & low]
    maybe = np.flatnonzero(out)
    out[maybe] = np.isin(values[maybe], chosen)
    return out


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Segments of all documents [starts, ends) in ``data``, which has ``PAD`` more bytes, in order.

    Returns the begin of the first string, the number of strings, the hash of the anchor's gram, a
    hash of the segment's bytes, the anchor's distance from the begin, and whether it has one of the
    ``common`` grams. Those are anchors only of strings that have no other gram.
    """
    total = int(ends[-1]) if len(ends) else 0
    edges = np.zeros(total + 1, np.int8)
    full = ends - starts >= LENGTH
    np.add.at(edges, starts[full], 1)
    np.add.at(edges, ends[full] - LENGTH + 1, -1)
    valid = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    forward, back = powers()
    out = []
    for at in range(0, total, CHUNK):
        begins = min(CHUNK, total - at)
        good = valid[at : at + begins]
        if not good.any():
            continue
        grams = begins + SPAN
        x = tokens(data, at, grams + GRAM - TOKEN)
        y = (x[:-8] * C1) ^ (x[8:] * C2)
        y ^= y >> np.uint64(32)
        h = y[: grams] * C3 + y[16 : 16 + grams] * C4
        h ^= h >> np.uint64(31)
        h *= C5
        h >>= np.uint64(1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(h * forward[:grams], dtype=np.uint64)))
        passed = np.zeros(grams + 1, np.int32)
        if common is not None and len(common):
            often = among(h, common)
            passed[1:] = np.cumsum(often)
            h[often] |= np.uint64(1 << 63)
        least, width = h, 1
        while 2 * width <= SPAN:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < SPAN:
            least = np.minimum(least[: -(SPAN - width)], least[SPAN - width :])
        least = least[:begins]
        new = np.empty(begins, bool)
        new[0] = True
        # A new segment begins where the least hash changes or its leftmost place falls out in front.
        new[1:] = (least[1:] != least[:-1]) | (h[: begins - 1] == least[:-1]) | ~good[:-1]
        first = np.flatnonzero(new & good)
        stop = np.flatnonzero(new | ~good)
        nearest = np.searchsorted(stop, first, "right")
        stop = np.append(stop, begins)[nearest]
        count = stop - first
        key = least[first]
        digest = (sums[stop + SPAN - 1] - sums[first]) * back[first]
        anchor = (h[first[:, None] + np.arange(SPAN)] == key[:, None]).argmax(1)
        out.append((first + at, count, key, digest, anchor, passed[stop + SPAN - 1] > passed[first]))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none, none.astype(bool)
    return tuple(np.concatenate(c) for c in zip(*out))


def squeeze(*arrays: np.ndarray) -> bytes:
    planes = [np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def expand(data: bytes, size: int, kinds: list) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(len(kinds), 8, size)
    return [np.ascontiguousarray(part.T).view("<u8").ravel().astype(kind) for part, kind in zip(raw, kinds)]


class Block:
    """The documents of one row of the table of blocks, their bytes in order of id."""

    def __init__(self, row: dict):
        self.block, self.ids, self.sizes = row["block"], row["ids"], np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.bytes = zstandard.ZstdDecompressor().decompress(row["text"])
        self.data = np.frombuffer(self.bytes + bytes(PAD), np.uint8)

    def segments(self, common: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        return segments(self.data, self.starts, self.ends, common)


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, of which only one at a time is taken out: a row is a whole block."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def one_row(table: pa.Table) -> dict:
    return table.select([n for n in table.column_names if n != "rest"]).to_pylist()[0]


def first_of_equal(*columns: np.ndarray) -> np.ndarray:
    """For each row, whether no row before it agrees in all columns."""
    order = np.lexsort(columns)
    repeats = np.ones(max(0, len(order) - 1), bool)
    for column in columns:
        repeats &= column[order][1:] == column[order][:-1]
    out = np.ones(len(order), bool)
    out[order[1:][repeats]] = False
    return out


def gather_blocks(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """Rows of (block, ids, sizes, text, rest): documents in order of id, NULL last, and their bytes, compressed."""
    rest = F.struct(*[F.col(c) for c in carried]) if carried else F.lit(None).cast("int")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("text"), rest.alias("rest")
    )
    kind = rows.schema["rest"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.Table] = []

        def block() -> pa.RecordBatch:
            table = pa.concat_tables(held).combine_chunks()
            table = table.sort_by([("doc_id", "ascending")])
            texts = [t.as_buffer() for t in table.column("text")]
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            rest = table.column("rest").combine_chunks()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | number], pa.int64()),
                    pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([[t.size for t in texts]], pa.list_(pa.int64())),
                    pa.array([packed], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), rest),
                ],
                ["block", "ids", "sizes", "text", "rest"],
            )

        size = 0
        for batch in batches:
            lengths = np.array([t.as_buffer().size for t in batch.column(1)], np.int64)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(lengths[at:]), BLOCK_BYTES - size, "right"))
                fits = max(fits, 0 if size else 1)
                if fits:
                    held.append(pa.Table.from_batches([batch.slice(at, fits)]))
                    size += int(lengths[at : at + fits].sum())
                    at += fits
                if at < batch.num_rows:
                    yield block()
                    held.clear()
                    size, number = 0, number + 1
        if held:
            yield block()

    schema = f"block long, ids array<long>, sizes array<long>, text binary, rest array<{kind}>"
    return written(rows.mapInArrow(gather, schema), "blocks")


def anchor_hashes(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, size, keys): each block's distinct hashes, in order, with how many different segments have each."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                block = Block(row)
                _, _, key, digest, _, _ = block.segments()
                keys, times = np.unique(key[first_of_equal(digest, key)], return_counts=True)
                where = keys * C1 % np.uint64(buckets)
                rows = []
                for bucket in np.unique(where):
                    some = np.flatnonzero(where == bucket)
                    rows.append((int(bucket), block.block, len(some), squeeze(np.diff(keys[some], prepend=np.uint64(0)), times[some])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                        ["bucket", "block", "size", "keys"],
                    )

    return blocks.select("block", "ids", "sizes", "text").mapInArrow(send, "bucket int, block long, size long, keys binary")


def shared_hashes(sent: DataFrame) -> DataFrame:
    """(block, size, keys): those of a block's hashes that another block has sent too; without a block, the common ones."""

    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [expand(r["keys"], r["size"], [np.uint64, np.int64]) for r in rows]
        sets = [np.cumsum(keys, dtype=np.uint64) for keys, _ in parts]
        keys, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        different = np.bincount(where, np.concatenate([times for _, times in parts]), len(keys))
        found = [(None, keys[different >= COMMON])]
        found += [(row["block"], np.intersect1d(mine, keys[counts > 1], assume_unique=True)) for row, mine in zip(rows, sets)]
        out = [(block, len(some), squeeze(np.diff(some, prepend=np.uint64(0)))) for block, some in found if len(some)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], names=["block", "size", "keys"])

    return written(sent.groupBy("bucket").applyInArrow(giving_back(compare), "block long, size long, keys binary"), "shared")


def hashes_of(rows: list[dict]) -> np.ndarray:
    """The hashes of packed rows, in order."""
    parts = [np.cumsum(expand(r["keys"], r["size"], [np.uint64])[0], dtype=np.uint64) for r in rows]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def grams_at(block: Block, places: np.ndarray) -> np.ndarray:
    """The grams that begin at the places, as fixed-width byte strings."""
    rows = block.data[places[:, None] + np.arange(GRAM)] if len(places) else np.empty((0, GRAM), np.uint8)
    return np.ascontiguousarray(rows).view(f"S{GRAM}").ravel()


def splitters(blocks: DataFrame, buckets: int) -> np.ndarray:
    """Grams that cut the anchors of a bounded sample of blocks to ``buckets`` parts of like size."""
    some = [r.block for r in blocks.select("block").orderBy(F.xxhash64("block")).limit(SAMPLE_BLOCKS).collect()]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                block = Block(row)
                start, _, _, _, anchor, _ = block.segments()
                places = (start + anchor)[:: max(1, len(start) // SAMPLE_ANCHORS)]
                yield pa.RecordBatch.from_arrays([pa.array([g.ljust(GRAM, b"\0") for g in grams_at(block, places).tolist()], pa.binary())], ["gram"])

    picked = blocks.filter(F.col("block").isin(some)).select("block", "ids", "sizes", "text") if some else blocks.select("block", "ids", "sizes", "text")
    grams = np.sort(np.array([bytes(r.gram) for r in picked.mapInArrow(sample, "gram binary").collect()], f"S{GRAM}"))
    return np.unique(grams[np.arange(1, buckets) * len(grams) // buckets]) if len(grams) else grams


def send_segments(blocks: DataFrame, shared: DataFrame, common: np.ndarray, cuts: np.ndarray) -> DataFrame:
    """(bucket, block, size, numbers, text): the distinct segments of a block that may be repeated elsewhere."""

    def send(own: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(one_row(own))
        start, count, key, digest, anchor, touched = block.segments(common)
        keys, times = np.unique(key, return_counts=True)
        keys = np.union1d(hashes_of(found.to_pylist()), keys[times > 1])
        # Hashes were sent before any gram was passed over, so they say nothing of touched segments.
        take = np.flatnonzero(np.isin(key, keys) | touched)
        take = take[first_of_equal(digest[take], key[take])]
        start, count, digest, anchor = start[take], count[take], digest[take], anchor[take]
        doc = np.searchsorted(block.ends, start, "right")
        ids = np.array([LAST if i is None else i for i in block.ids], np.int64)[doc]
        bucket = np.searchsorted(cuts, grams_at(block, start + anchor), "right")
        view, rows = memoryview(block.bytes), []
        for b in np.unique(bucket):
            mine = np.flatnonzero(bucket == b)
            text = b"".join([view[s : s + n] for s, n in zip(start[mine].tolist(), (count[mine] + LENGTH - 1).tolist())])
            numbers = squeeze(start[mine], count[mine], anchor[mine], digest[mine], ids[mine], doc[mine], (start - block.starts[doc])[mine])
            rows.append((int(b), block.block, len(mine), numbers, zstandard.ZstdCompressor(level=1).compress(text)))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "block", "size", "numbers", "text"])

    own = blocks.select("block", "ids", "sizes", "text")
    return own.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        giving_back(send), "bucket int, block long, size long, numbers binary, text binary"
    )


def multikey_sort(read, size: int, depth: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``size`` strings, and the bytes that each has in common with the one before it.

    ``read(i, t)`` gives token ``t`` of the strings ``i``. Strings are parted by one token; those
    that agree in it, and they alone, are parted by the next. Strings of unlike ``group`` have
    nothing in common.
    """
    order = np.arange(size)
    run = np.zeros(size, np.int64) if group is None else group
    if group is not None:
        order = np.argsort(run, kind="stable")
        run = run[order]
    common = np.zeros(size, np.int64)
    places = np.arange(size)
    for t in range(depth):
        here = read(order[places], t)
        by = np.lexsort((here, run[places]))
        here, order[places] = here[by], order[places][by]
        runs = run[places]
        same_run = runs[1:] == runs[:-1]
        apart = here[1:] ^ here[:-1]
        equal = same_run & (apart == 0)
        same = np.zeros(len(apart), np.int64)
        for byte in range(1, TOKEN + 1):
            same += apart < np.uint64(1 << (64 - 8 * byte)) if byte < TOKEN else apart == 0
        common[places[1:][same_run]] += same[same_run]
        # Runs are renumbered by the place they begin at.
        fresh = np.concatenate(([True], ~equal))
        begin = places[fresh][np.cumsum(fresh) - 1]
        run[places] = begin
        alone = fresh & np.append(fresh[1:], True)
        places = places[~alone]
        if not len(places):
            break
    return order, common


def repeats(data: np.ndarray, at: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whether each string of the segments equals one of a segment before; rows are segments, columns strings.

    Segments lie at ``at`` in ``data``, in the order in which their strings count as earlier.
    """
    size = len(at)
    out = np.zeros((size, SPAN), bool)
    if size < 2:
        return out
    place = at + anchor
    big, little = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,)), np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    order, common = multikey_sort(lambda i, t: big[place[i] + TOKEN * t].astype(np.uint64), size, -(-LENGTH // TOKEN))
    new = common < GRAM
    group = np.empty(size, np.int64)
    group[order] = np.cumsum(new)
    several = np.bincount(group)[group] > 1
    right = np.empty(size, np.int64)
    right[order] = common
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    some = np.flatnonzero(several)
    if not len(some):
        return out
    # From here on numbers are places in ``some``, which is in the order of the segments.
    sorted_right = np.argsort(rank[some])
    right = right[some][sorted_right]
    before = lambda i, t: little[place[some[i]] - TOKEN * (t + 1)].astype(np.uint64)
    sorted_left, left = multikey_sort(before, len(some), -(-(SPAN - 1) // TOKEN), group[some])
    left_new = np.concatenate(([True], np.diff(group[some][sorted_left]) != 0))
    r_class, l_class = np.empty(len(some), np.int64), np.empty(len(some), np.int64)
    for distance in range(SPAN):
        string = anchor[some] - distance
        mine = np.flatnonzero((string >= 0) & (string < count[some]))
        if len(mine) < 2:
            continue
        r_class[sorted_right] = np.cumsum(right < LENGTH - distance)
        l_class[sorted_left] = np.cumsum((left < distance) | left_new)
        later = ~first_of_equal(r_class[mine], l_class[mine])
        out[some[mine[later]], string[mine[later]]] = True
    return out


def find_repeats(sent: DataFrame) -> DataFrame:
    """(block, size, numbers, flags): for each segment sent, which of its strings occur earlier."""

    def compare(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "size", "numbers"]).to_pylist()
        parts = [expand(r["numbers"], r["size"], [np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64, np.int64]) for r in rows]
        start, count, anchor, digest, doc, index, inside = (np.concatenate(c) for c in zip(*parts))
        blocks = np.repeat([r["block"] for r in rows], [r["size"] for r in rows])
        unpack = zstandard.ZstdDecompressor()
        lead = bytes(PAD)
        data = np.frombuffer(lead + b"".join([unpack.decompress(t.as_buffer()) for t in table.column("text")]) + lead, np.uint8)
        ends = np.cumsum(count + LENGTH - 1) + len(lead)
        at = ends - (count + LENGTH - 1)
        order = np.lexsort((inside + anchor, index, blocks, doc))
        flags = np.ones((len(order), SPAN), bool)
        # Of equal segments the first is compared; all strings of the others occur earlier.
        kept = order[first_of_equal(digest[order], count[order], anchor[order])]
        flags[kept] = repeats(data, at[kept], count[kept], anchor[kept])
        out, begin = [], 0
        for row in rows:
            mine = slice(begin, begin + row["size"])
            inside_flags = flags[mine] & (np.arange(SPAN) < count[mine][:, None])
            hit = np.flatnonzero(inside_flags.any(1))
            if len(hit):
                bits = np.packbits(inside_flags[hit], axis=1)
                packed = zstandard.ZstdCompressor(level=1).compress(bits.tobytes())
                out.append((row["block"], len(hit), squeeze(start[mine][hit]), packed))
            begin += row["size"]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "size", "starts", "flags"])

    return sent.groupBy("bucket").applyInArrow(giving_back(compare), "block long, size long, starts binary, flags binary")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = (), with_kept: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept, kept_text, rest; one row per input row.

    A byte is removed if a string of 100 bytes that covers it also begins earlier: in a document
    with a smaller id, or earlier in the same document. Strings are those of the input, as UTF-8,
    and may overlap; they never cross documents. ``spans`` are the maximal removed runs as
    (start, length), ``kept`` the remaining bytes, ``kept_text``
    the same without the bytes of characters that were cut in part, ``rest`` the columns named in ``carried``, whatever
    their names. NULL text is empty. A NULL id counts as larger than any other; rows that repeat an
    id count one after the other. Without ``with_kept`` spans and both kept are NULL.
    """
    blocks = gather_blocks(docs, id_col, text_col, list(carried))
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size)
    buckets = bucket_count(docs.sparkSession, blocks.agg(F.sum(sizes)).first()[0] or 0)
    rest_kind = blocks.schema["rest"].dataType.elementType.simpleString()
    cuts = splitters(blocks, buckets)
    shared = shared_hashes(anchor_hashes(blocks, buckets))
    # Each common gram stands for COMMON segments or more, so there are few of them.
    common = hashes_of([r.asDict() for r in shared.filter("block is null").collect()])
    answers = find_repeats(send_segments(blocks, shared.filter("block is not null"), common, cuts))

    def remove(own: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(one_row(own))
        start, count, key, digest, _, _ = block.segments(common)
        begins = np.zeros(len(block.data) + 1, np.int16)
        again = ~first_of_equal(digest, key)
        repeated = [np.repeat(start[again], count[again]) + np.arange(count[again].sum()) - np.repeat(np.cumsum(count[again]) - count[again], count[again])]
        for row in found.to_pylist():
            places = expand(row["starts"], row["size"], [np.int64])[0]
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["flags"]), np.uint8).reshape(row["size"], -1)
            segment, string = np.nonzero(np.unpackbits(raw, axis=1)[:, :SPAN])
            repeated.append(places[segment] + string)
        strings = np.unique(np.concatenate(repeated))
        begins[strings] += 1
        begins[strings + LENGTH] -= 1
        gone = np.cumsum(begins, dtype=np.int16)[: len(block.data)] > 0
        columns = [[] for _ in range(8)]
        for doc, a, b in zip(block.ids, block.starts.tolist(), block.ends.tolist()):
            mine = gone[a:b]
            turns = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            kept = block.data[a:b][~mine].tobytes() if len(turns) else block.bytes[a:b]
            spans = [{"start": s, "length": e - s} for s, e in turns.reshape(-1, 2).tolist()] if with_kept else None
            shown = (spans, kept, kept.decode("utf-8", "ignore")) if with_kept else (None, None, None)
            row = doc, b - a, int(mine.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(), *shown
            for column, value in zip(columns, row):
                column.append(value)
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary(), pa.string())
        rest = own.column("rest").combine_chunks().flatten()
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "kept_text", "rest"]
        return pa.table([*(pa.array(c, k) for c, k in zip(columns, kinds)), rest], names=names)

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        f"spans array<struct<start:long,length:long>>, kept binary, kept_text string, rest {rest_kind}"
    )
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(giving_back(remove), schema)
