"""Documents that hold passages of a benchmark, found by suffix arrays over the documents.

The benchmark is taken in slabs of bounded size, which are broadcast one after the other. A task
cuts its documents to shards of some megabytes. Per shard:

1. Words get the numbers that they have in the slab, by exact comparison; other words are breaks. Only
   stretches without a break that are as long as the shortest window can match.
2. The suffixes of these stretches are sorted by prefix doubling, as deep as the longest item.
3. Each suffix of the slab is sought by binary search. The range of suffixes that agree in a window
   gives all its places; the neighbours of the place it belongs at give its longest verbatim match.

Documents are not shuffled and nothing is left out: windows that very many documents share make one
range each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import running_total, written
from snapledger.llm.periodic import spread
from snapledger.llm.words import LONG, cut_words, same_words, text_blocks, text_bytes, word_hashes, word_numbers

#: Words of a window; a shorter item is one window as a whole.
WINDOW = 10
#: Bytes of benchmark texts that are broadcast at a time; one longer item is a slab of its own.
SLAB_BYTES = 8 << 20
SHARD_BYTES = 4 << 20

#: Digits, letters and all that is not ASCII are parts of words.
INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def lower_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of all texts, and begin, length and text of each word."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    return data, *cut_words(data, offsets, INSIDE)


def separated(numbers: np.ndarray, texts: np.ndarray, n: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """``numbers`` with a 0 after each of ``n`` texts and ``pad`` more, and the place of each."""
    places = np.arange(len(numbers)) + texts
    out = np.zeros(len(numbers) + n + pad, np.int64)
    out[places] = numbers
    return out, places


class Slab:
    """The words of some benchmark items, their windows, and the vocabulary by which documents are read."""

    def __init__(self, items: list[str | None], texts: list[str | None], window: int):
        self.items = items
        data, starts, sizes, owner = lower_words(pa.array(texts, pa.large_string()))
        numbers = word_numbers(data, starts, sizes) + 1
        lengths = np.bincount(owner, minlength=len(items))
        self.depth = int(lengths.max(initial=0))
        self.words, places = separated(numbers, owner, len(items), self.depth + 1)

        _, first = np.unique(numbers, return_index=True)
        self.data, self.starts, self.sizes = data, starts[first], sizes[first]
        short = np.flatnonzero(self.sizes <= LONG)
        self.seed = 0
        while True:  # until all words of the vocabulary have hashes of their own
            hashes = word_hashes(data, self.starts[short], self.sizes[short], self.seed)
            order = np.argsort(hashes)
            if (np.diff(hashes[order]) != 0).all():
                break
            self.seed += 1
        self.hashes, self.known = hashes[order], short[order]
        self.table = np.zeros(1 << 16, bool)
        self.table[self.hashes & np.uint64(0xFFFF)] = True
        far = np.flatnonzero(self.sizes > LONG)
        self.long = {data[a : a + n].tobytes(): i + 1 for i, a, n in zip(far.tolist(), self.starts[far].tolist(), self.sizes[far].tolist())}

        # The suffixes that begin with a window, and the equal windows among them as one class each.
        begin = np.cumsum(lengths) - lengths
        offset = np.arange(len(numbers)) - begin[owner]
        size = np.minimum(lengths, window)[owner]
        opens = offset + size <= lengths[owner]
        self.suffix, self.suffix_item, self.suffix_offset = places[opens], owner[opens], offset[opens]
        self.rest = (lengths[owner] - offset)[opens]
        classes: dict[bytes, int] = {}
        words = self.words.astype(np.int32)
        of = np.array([classes.setdefault(words[s : s + n].tobytes(), len(classes)) for s, n in zip(self.suffix.tolist(), size[opens].tolist())], np.int64)
        _, first = np.unique(of, return_index=True)
        self.windows, self.window_sizes = self.suffix[first], size[opens][first]
        # Items of each class, in order of class.
        pairs = np.unique(np.stack([of, self.suffix_item], 1).reshape(-1, 2), axis=0)
        self.class_items = pairs[:, 1]
        self.class_counts = np.bincount(pairs[:, 0], minlength=len(first))
        self.class_first = np.cumsum(self.class_counts) - self.class_counts
        self.shortest = int(self.window_sizes.min(initial=window))

    def numbers(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, from 1; 0 if it has none."""
        out = np.zeros(len(starts), np.int64)
        hashes = word_hashes(data, starts, sizes, self.seed)
        maybe = np.flatnonzero(self.table[hashes & np.uint64(0xFFFF)] & (sizes <= LONG)) if len(self.hashes) else np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), max(0, len(self.hashes) - 1))
        agree = self.hashes[at] == hashes[maybe]
        maybe, word = maybe[agree], self.known[at[agree]]
        exact = same_words(data, starts[maybe], sizes[maybe], self.data, self.starts[word], self.sizes[word])
        out[maybe[exact]] = word[exact] + 1
        if self.long:
            for i in np.flatnonzero(sizes > LONG).tolist():
                out[i] = self.long.get(data[starts[i] : starts[i] + sizes[i]].tobytes(), 0)
        return out


class Shard:
    """The suffixes of some documents that may match a slab, in order."""

    def __init__(self, slab: Slab, column: pa.Array):
        data, starts, sizes, texts = lower_words(column)
        self.texts, self.n_words = texts, np.bincount(texts, minlength=len(column))
        sequence, places = separated(slab.numbers(data, starts, sizes), texts, len(column), 1)
        # Stretches without a break, and of them those that are long enough for a window.
        turns = np.flatnonzero(np.diff((sequence > 0).astype(np.int8), prepend=0))
        begin, end = turns[::2], turns[1::2]
        long = end - begin >= slab.shortest
        begin, count = begin[long], (end - begin)[long]
        self.words = np.zeros(int(count.sum()) + len(count) + slab.depth + 1, np.int64)
        to = spread(np.cumsum(count + 1) - count - 1, count)
        origin = spread(begin, count)
        self.words[to] = sequence[origin]
        #: The word of the documents that stands at each place.
        self.origin = np.zeros(len(self.words), np.int64)
        self.origin[to] = np.searchsorted(places, origin)
        self.suffixes = to[self._order(to, slab.depth)]

    def _order(self, to: np.ndarray, depth: int) -> np.ndarray:
        """Order of the suffixes that begin at ``to``, by as many words as ``depth`` at least."""
        rank, done = self.words.copy(), 1
        order = np.argsort(rank[to], kind="stable")
        while done < depth and len(to):
            after = np.zeros(len(rank), np.int64)
            after[:-done] = rank[done:]
            key = rank[to] * (len(to) + int(rank.max()) + 1) + after[to]
            order = np.argsort(key, kind="stable")
            fresh = np.ones(len(to), np.int64)
            fresh[1:] = key[order][1:] != key[order][:-1]
            rank = np.zeros(len(rank), np.int64)
            rank[to[order]] = np.cumsum(fresh)
            done *= 2
            if fresh.all():
                break
        return order

    def compare(self, slab: Slab, suffix: np.ndarray, size: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common words, up to ``size``, of slab suffixes and those at ``place``, and the sign of the first difference."""
        common, sign = np.zeros(len(suffix), np.int64), np.zeros(len(suffix), np.int8)
        some, t = np.flatnonzero(size > 0), 0
        while len(some):
            mine, theirs = slab.words[suffix[some] + t], self.words[place[some] + t]
            equal = mine == theirs
            sign[some] = np.sign(mine - theirs)
            t += 1
            some = some[equal]
            common[some] = t
            some = some[size[some] > t]
        return common, sign

    def bound(self, slab: Slab, suffix: np.ndarray, size: np.ndarray, after_equal: bool) -> np.ndarray:
        """The first suffix of the shard that is not before (or that is after) each slab suffix in its first ``size`` words."""
        low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(self.suffixes))
        some = np.flatnonzero(low < high)
        while len(some):
            middle = (low[some] + high[some]) // 2
            _, sign = self.compare(slab, suffix[some], size[some], self.suffixes[middle])
            right = sign >= 0 if after_equal else sign > 0
            low[some[right]], high[some[~right]] = middle[right] + 1, middle[~right]
            some = some[low[some] < high[some]]
        return low

    def hits(self, slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word of the documents is hit, and pairs of text and item, once each."""
        first = self.bound(slab, slab.windows, slab.window_sizes, False)
        count = self.bound(slab, slab.windows, slab.window_sizes, True) - first
        found = np.flatnonzero(count)
        place = self.suffixes[spread(first[found], count[found])]
        of = np.repeat(found, count[found])
        marks = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(marks, place, 1)
        np.add.at(marks, place + slab.window_sizes[of], -1)
        hit = np.zeros(len(self.texts), bool)
        hit[self.origin[np.flatnonzero(np.cumsum(marks[:-1]) > 0)]] = True
        pairs = np.unique(self.texts[self.origin[place]] * len(slab.windows) + of) if len(place) else np.empty(0, np.int64)
        text, of = pairs // max(1, len(slab.windows)), pairs % max(1, len(slab.windows))
        item = slab.class_items[spread(slab.class_first[of], slab.class_counts[of])]
        pairs = np.unique(np.repeat(text, slab.class_counts[of]) * len(slab.items) + item) if len(item) else np.empty(0, np.int64)
        return hit, pairs // max(1, len(slab.items)), pairs % max(1, len(slab.items))

    def longest(self, slab: Slab) -> tuple[np.ndarray, np.ndarray]:
        """For each slab suffix that begins with a window the words of its longest match, and the first place of it."""
        at = self.bound(slab, slab.suffix, slab.rest, False)
        best = np.zeros(len(at), np.int64)
        for near in (at, at - 1):
            some = np.flatnonzero((near >= 0) & (near < len(self.suffixes)))
            common, _ = self.compare(slab, slab.suffix[some], slab.rest[some], self.suffixes[near[some]])
            best[some] = np.maximum(best[some], common)
        where = np.zeros(len(at), np.int64)
        some = np.flatnonzero(best)
        if len(some):
            ranges = np.stack([self.bound(slab, slab.suffix[some], best[some], after) for after in (False, True)], 1).ravel()
            where[some] = np.minimum.reduceat(np.append(self.suffixes, 0), ranges)[::2]
        return best, where


def slabs(bench: DataFrame, item_col: str, text_col: str, slab_bytes: int, window: int) -> Iterator[Slab]:
    """The benchmark in slabs of bounded size, one at a time; rows that repeat id and text count once."""
    items = bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("text is not null").distinct()
    placed = running_total(written(items.withColumn("bytes", F.octet_length("text") + 1), "items"), ["text", "item"], "bytes")
    placed = written(placed.withColumn("slab", F.floor(F.col("start") / slab_bytes)), "slabs")
    # One row per slab: some megabytes of texts stand behind each.
    for row in placed.select("slab").distinct().orderBy("slab").toLocalIterator():
        part = placed.filter(F.col("slab") == row.slab).select("item", "text").collect()
        yield Slab([r.item for r in part], [r.text for r in part], window)


def _pass(rows: DataFrame, slab, last: bool) -> DataFrame:
    """Add what one slab hits to ``spans`` and ``items`` of the rows. The text goes on unless this is the last slab."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = ["n_words", "spans", "items", "rest", *([] if last else ["text"])]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: Slab = slab.value
        for batch in batches:
            for low, high in text_blocks(batch.column("text"), SHARD_BYTES):
                part = batch.slice(low, high - low)
                shard = Shard(mine, part.column("text"))
                hit, text, item = shard.hits(mine)
                n, first = part.num_rows, np.cumsum(shard.n_words) - shard.n_words
                spans, items = part.column("spans"), part.column("items")
                if len(earlier := spans.flatten()):
                    owner = np.repeat(np.arange(n), spans.value_lengths().to_numpy(False))
                    start, length = (np.array(earlier.field(f), np.int64) for f in (0, 1))
                    hit[spread(first[owner] + start, length)] = True
                # A span ends with its text, even if the next one goes on.
                opens = hit & (np.diff(shard.texts, prepend=-1).astype(bool) | ~np.concatenate([[False], hit[:-1]]))
                span = np.cumsum(opens)[hit] - 1
                begin = np.flatnonzero(opens)
                of = shard.texts[begin]
                fields = [pa.array(begin - first[of], pa.int64()), pa.array(np.bincount(span, minlength=len(begin)), pa.int64())]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
                new_spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length"]))
                listed = items.to_pylist()
                for t, i in zip(text.tolist(), item.tolist()):
                    listed[t].append(mine.items[i])
                out = [pa.array(shard.n_words, pa.int64()), new_spans, pa.array(listed, pa.list_(pa.string())), part.column("rest")]
                yield pa.RecordBatch.from_arrays(out if last else [*out, part.column("text")], names)

    schema = f"n_words long, spans array<struct<start:long,length:long>>, items array<string>, rest {kinds['rest']}"
    return rows.select("text", "spans", "items", "rest").mapInArrow(search, schema if last else f"{schema}, text string")


def _rows(docs: DataFrame, text_col: str, carried: tuple[str, ...]) -> DataFrame:
    rest = F.struct(*[F.col(c) for c in carried]) if carried else F.lit(None).cast("int")
    return docs.select(F.col(text_col).cast("string").alias("text"), rest.alias("rest"))


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    carried: tuple[str, ...] = ("doc_id",),
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slab_bytes: int = SLAB_BYTES,
) -> DataFrame:
    """n_words, n_hit, spans, items, contaminated, rest; one row per row of ``docs``, in its partition.

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. A window is ``window``
    consecutive words of an item, or a shorter item as a whole. ``spans`` are the maximal stretches of
    words inside windows of any item, as (start, length), ``n_hit`` their words, ``items`` the ids of the items that occur, in
    order as texts. ``rest`` holds the columns named in ``carried``, whatever their names.

    NULL texts have no words. Document rows count one by one, so ids may be NULL or repeated. Rows of
    the benchmark that share an id are one item, and windows never span rows; those without an id
    are one item, listed last as NULL. Without items nothing is hit. A benchmark of more than
    ``slab_bytes`` is broadcast in several slabs, each with a pass over the documents.
    """
    rows = _rows(docs, text_col, carried)
    empty = rows.withColumn("spans", F.expr("cast(array() as array<struct<start:long,length:long>>)")).withColumn("items", F.expr("cast(array() as array<string>)"))
    broadcast: Callable = docs.sparkSession.sparkContext.broadcast
    waiting, done = Slab([], [], window), empty
    for number, slab in enumerate(slabs(bench, item_col, item_text_col, slab_bytes, window)):
        if number:
            done = written(_pass(done, broadcast(waiting), last=False).drop("n_words"), "hits")
        waiting = slab
    found = _pass(done, broadcast(waiting), last=True)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["length"])
    return found.select(
        "n_words", n_hit.alias("n_hit"), "spans", F.array_sort(F.array_distinct("items")).alias("items"), (F.size("spans") > 0).alias("contaminated"), "rest"
    )


def longest_matches(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slab_bytes: int = SLAB_BYTES,
) -> DataFrame:
    """item_id (as text), item_text, item_start, length, doc_id, doc_start: the longest verbatim match of each suffix of the benchmark.

    A suffix begins at ``item_start`` with a window and counts if that occurs. Of equally long matches
    the one in the smallest id (NULL last) counts, then the earliest; numbers are in words. Rows of the
    benchmark that repeat id and text count once. A shard answers at most one row per suffix.
    """
    rows = _rows(docs, text_col, (id_col,))
    session, out = docs.sparkSession, None
    kind = docs.schema[id_col].dataType.simpleString()

    def answers(slab) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine: Slab = slab.value
            for batch in batches:
                # Ties go to the smallest id, so the rows of a shard stand in its order.
                batch = batch.take(pc.array_sort_indices(batch.column("id")))
                for low, high in text_blocks(batch.column("text"), SHARD_BYTES):
                    part = batch.slice(low, high - low)
                    shard = Shard(mine, part.column("text"))
                    size, where = shard.longest(mine)
                    some = np.flatnonzero(size >= np.minimum(window, mine.rest + mine.suffix_offset))
                    word = shard.origin[where[some]]
                    text = shard.texts[word]
                    first = np.cumsum(shard.n_words) - shard.n_words
                    item = mine.suffix_item[some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(item, pa.int64()),
                            pa.array(mine.suffix_offset[some], pa.int64()),
                            pa.array(size[some], pa.int64()),
                            part.column("id").take(pa.array(text, pa.int64())),
                            pa.array(word - first[text], pa.int64()),
                        ],
                        ["item", "item_start", "length", "doc_id", "doc_start"],
                    )

        found = rows.select("text", F.col(f"rest.{id_col}").alias("id")).mapInArrow(
            search, f"item long, item_start long, length long, doc_id {kind}, doc_start long"
        )
        return found

    for slab in slabs(bench, item_col, item_text_col, slab_bytes, window):
        order = F.struct(-F.col("length"), F.col("doc_id").isNull(), "doc_id", "doc_start")
        best = answers(session.sparkContext.broadcast(slab)).groupBy("item", "item_start").agg(F.min_by(F.struct("length", "doc_id", "doc_start"), order).alias("m"))
        # The items of one slab: bounded as the slab is.
        names = session.createDataFrame(list(enumerate(slab.items)), "item long, item_id string")
        part = best.join(F.broadcast(names), "item").select("item_id", "item_start", "m.length", "m.doc_id", "m.doc_start")
        out = written(part, "longest") if out is None else out.unionByName(written(part, "longest"))
    if out is None:
        schema = f"item_id string, item_start long, length long, doc_id {kind}, doc_start long"
        return session.createDataFrame([], schema)
    return out


def remove_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no window of the benchmark occurs in, with their columns and partitions."""
    found = contamination(docs, bench, text_col, tuple(docs.columns), **options)
    return found.filter("not contaminated").select(*[F.col("rest").getField(c).alias(c) for c in docs.columns])
