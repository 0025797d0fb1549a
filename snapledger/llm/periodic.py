"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words whose smallest period ``q`` fits in it twice and that no neighbouring
word extends. Words ``q`` apart are equal inside, so a run shows as a stretch of at least ``q``
places at which the text equals itself ``q`` words later.

* Periods under ``2**first_scale``: direct scans, one for each lag.
* Scale ``k`` takes the periods from ``2**k`` to ``2**(k+1) - 1``. Grams of ``g = 2**k / 4`` words are
  hashed, and the least of each window of ``g`` grams is a minimizer. A window and the one a period
  later hold the same words, so minima come again at period distance. Pairs of equal minimizers at
  a distance of the scale are seeds, and each seed is extended by comparing words.
* Grams with a period of at most ``g / 2`` are no minimizers: they would pair all over their stretch.
  Occurrences of the others are more than ``g / 2`` apart, so each pairs with at most 15 later ones.
  If all grams in the first ``q`` words of a run are such, these words belong to one run of that short
  period and the next ``q`` words to another one that touches it. Both are known by then, and the
  seeds are the lags that both have room for.

Everything is exact: hashes only choose seeds, and equal grams always have equal hashes. Work is done
on blocks of whole texts, with a separator between texts that equals nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.words import C1, C2, SHIFT, cut_words, text_blocks, text_bytes, word_numbers

#: Least words of a run that is reported.
MINIMUM = 12
#: Periods from two to this power are sought by minimizers, shorter ones by direct scans.
FIRST_SCALE = 6
BLOCK_BYTES = 4 << 20
#: Cells of a matrix in which seeds are compared with the text a lag later.
CELLS = 1 << 21
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

INSIDE = np.ones(256, bool)
INSIDE[[0x20, *range(0x09, 0x0E)]] = False

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left * C1) ^ (right + C2)
    out ^= out >> SHIFT
    out *= C2
    out ^= out >> SHIFT
    return out


def sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or greatest) of each ``width`` neighbours; ``width`` is a power of two."""
    done = 1
    while done < width:
        values, done = least(values[:-done], values[done:]), 2 * done
    return values


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from ``first`` on, ``count`` of each, one after the other."""
    before = np.cumsum(count) - count
    return np.repeat(first - before, count) + np.arange(int(count.sum()))


def reach(words: np.ndarray, at: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in the direction of ``step``, equal those ``lag`` later."""
    found = np.zeros(len(at), np.int64)
    some, width, last = np.arange(len(at)), 16, len(words) - 1
    while len(some):
        rest = []
        rows = max(1, CELLS // width)
        for low in range(0, len(some), rows):
            part = some[low : low + rows]
            here = (at[part] + step * found[part])[:, None] + step * np.arange(width)
            there = here + lag[part][:, None]
            differ = words[np.clip(here, 0, last)] != words[np.clip(there, 0, last)]
            first = differ.argmax(1)
            through = ~differ[np.arange(len(part)), first]
            found[part] += np.where(through, width, first)
            rest.append(part[through])
        some, width = np.concatenate(rest), min(2 * width, CELLS)
    return found


def extended(words: np.ndarray, at: np.ndarray, lag: np.ndarray) -> Runs:
    """Begin, end and lag of the longest stretch around each seed in which words equal those a lag
    later, once each; only those at least as long as the lag.

    Seeds that lie near one another mostly belong to one stretch. Only the first of such a group is
    extended, then those that its stretch covers are passed over.
    """
    begins, ends, lags = [], [], []
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    while len(at):
        lead = np.ones(len(at), bool)
        lead[1:] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] > lag[1:])
        x, q = at[lead], lag[lead]
        end = x + reach(words, x, q, 1)
        begin = x - reach(words, x - 1, q, -1)
        begins.append(begin)
        ends.append(end)
        lags.append(q)
        covered = (at < end[np.cumsum(lead) - 1]) | lead
        at, lag = at[~covered], lag[~covered]
    begin, end, q = (np.concatenate(p) if p else np.empty(0, np.int64) for p in (begins, ends, lags))
    long = end - begin >= q
    return begin[long], end[long], q[long]


def smallest(runs: list[Runs]) -> Runs:
    """Runs in order of period and begin, each stretch once with its smallest period.

    A stretch with a period that is not its smallest is, from begin to end, also the stretch of the
    smallest, which divides it.
    """
    begin, end, period = (np.concatenate(p) for p in zip(*runs))
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, period = begin[new], end[new], period[new]
    order = np.lexsort((begin, period))
    return begin[order], end[order], period[order]


def direct_scan(words: np.ndarray, lag: int, shortest: int) -> Runs:
    """All stretches of one period by comparing the words with those ``lag`` later."""
    equal = np.flatnonzero(words[:-lag] == words[lag:])
    first = np.ones(len(equal), bool)
    first[1:] = np.diff(equal) != 1
    begin = equal[first]
    end = equal[np.append(first[1:], True)] + 1 if len(equal) else equal
    long = end - begin >= max(lag, shortest - lag)
    return begin[long], end[long] + lag, np.full(int(long.sum()), lag, np.int64)


def minimizer_seeds(grams: np.ndarray, scale: int, known: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of pairs of equal minimizers at a distance of the scale."""
    g = 1 << (scale - 2)
    begin, end, period = known
    dense = (period <= g // 2) & (end - begin >= g) & (begin < len(grams))
    marks = np.zeros(len(grams) + 1, np.int64)
    np.add.at(marks, begin[dense], 1)
    np.add.at(marks, np.minimum(end[dense] - g + 1, len(grams)), -1)
    hashes = np.minimum(grams, NEVER - np.uint64(1))
    hashes[np.cumsum(marks[:-1]) > 0] = NEVER
    if len(hashes) < g:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = sliding(hashes, g, np.minimum)
    none = np.zeros(g - 1, np.uint64)
    # A gram is a minimizer if the greatest of the minima of its windows is its own hash.
    chosen = sliding(np.concatenate([none, least, none]), g, np.maximum)
    places = np.flatnonzero((hashes == chosen) & (hashes != NEVER))
    order = np.argsort(hashes[places], kind="stable")
    places, values = places[order], hashes[places[order]]
    at, lag, t = [], [], 1
    while t < len(places):
        near = (values[t:] == values[:-t]) & (places[t:] - places[:-t] < 2 << scale)
        if not near.any():
            break
        distance = (places[t:] - places[:-t])[near]
        wide = distance >= 1 << scale
        at.append(places[:-t][near][wide])
        lag.append(distance[wide])
        t += 1
    return (np.concatenate(at), np.concatenate(lag)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))


def touching_seeds(scale: int, known: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which two touching runs of one short period may make a run of the scale."""
    begin, end, period = known
    fit = (period <= 1 << (scale - 3)) & (end - begin >= 1 << scale)
    begin, end, period = begin[fit], end[fit], period[fit]
    touch = np.flatnonzero((period[1:] == period[:-1]) & (begin[1:] <= end[:-1]))
    b1, e1, b2, e2 = begin[touch], end[touch], begin[touch + 1], end[touch + 1]
    most = np.minimum.reduce([np.full(len(touch), (2 << scale) - 1), e1 - b1, e2 - b2, (e2 - b1) // 2])
    count = np.maximum(most - (1 << scale) + 1, 0)
    lag = spread(np.full(len(touch), 1 << scale), count)
    return np.maximum(np.repeat(b1, count), np.repeat(b2, count) - lag), lag


def find_runs(numbers: np.ndarray, sizes: np.ndarray, minimum: int = MINIMUM, first_scale: int = FIRST_SCALE) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of all runs, in this order. ``numbers`` are the words of all texts,
    one text after the other, as numbers from 0; ``sizes`` the words of each. ``first_scale`` is at least 4."""
    order = np.argsort(-sizes, kind="stable")
    begins = np.cumsum(sizes) - sizes
    long_first = sizes[order]
    # Longest texts first, so that each scale looks at the front only. A separator equals nothing.
    places = np.cumsum(long_first + 1) - long_first
    words = np.empty(int(long_first.sum()) + len(sizes) + 1, np.int32)
    words[0] = -1
    words[places + long_first] = -2 - np.arange(len(sizes))
    words[spread(places, long_first)] = numbers[spread(begins[order], long_first)]

    def front(least: int) -> np.ndarray:
        texts = int(np.searchsorted(-long_first, -least, "right"))
        return words[: places[texts - 1] + long_first[texts - 1] + 1] if texts else words[:0]

    shortest = min(minimum, 1 << (first_scale - 2))
    found = [(np.empty(0, np.int64),) * 3]
    for lag in range(1, 1 << first_scale):
        some = front(max(2 * lag, shortest))
        if len(some) <= lag:
            break
        found.append(direct_scan(some, lag, shortest))
    grams, width, scale = words.astype(np.uint64), 1, first_scale
    while len(some := front(2 << scale)):
        known = smallest(found)
        grams = grams[: len(some)]
        while width < 1 << (scale - 2):
            grams, width = mixed(grams[:-width], grams[width:]), 2 * width
        seeds = [minimizer_seeds(grams, scale, known), touching_seeds(scale, known)]
        begin, end, lag = extended(words, *(np.concatenate(s) for s in zip(*seeds)))
        found = [known, (begin, end + lag, lag)]
        scale += 1
    begin, end, period = smallest(found)
    keep = end - begin >= minimum
    begin, end, period = begin[keep], end[keep], period[keep]
    where = np.searchsorted(places, begin, "right") - 1
    text, start = order[where], begin - places[where]
    by = np.lexsort((period, start, text))
    return text[by], start[by], (end - begin)[by], period[by]


def collapsed_texts(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, texts: np.ndarray, kept: np.ndarray, n: int) -> pa.Array:
    """The kept words of each of ``n`` texts, joined by one space."""
    starts, sizes, texts = starts[kept], sizes[kept], texts[kept]
    last = np.ones(len(texts), bool)
    last[:-1] = texts[1:] != texts[:-1]
    spans = sizes + ~last
    ends = np.cumsum(spans)
    out = data[spread(starts, spans)]
    out[ends[~last] - 1] = 0x20
    offsets = np.zeros(n + 1, np.int64)
    np.add.at(offsets, texts + 1, spans)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.cumsum(offsets)), pa.py_buffer(out)).cast(pa.string())


def block_runs(column: pa.Array, minimum: int, first_scale: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text of a block."""
    data, offsets = text_bytes(column)
    starts, sizes, texts = cut_words(data, offsets, INSIDE)
    n = len(column)
    n_words = np.bincount(texts, minlength=n)
    text, start, length, period = find_runs(word_numbers(data, starts, sizes), n_words, minimum, first_scale)
    first = np.cumsum(n_words) - n_words
    marks = np.zeros(len(starts) + 1, np.int64)
    np.add.at(marks, first[text] + start + period, 1)
    np.add.at(marks, first[text] + start + length, -1)
    kept = np.cumsum(marks[:-1]) == 0
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    places = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
    return [
        pa.array(n_words, pa.int64()),
        pa.ListArray.from_arrays(pa.array(places, pa.int32()), runs),
        collapsed_texts(data, starts, sizes, texts, kept, n),
    ]


def periodic_runs(
    docs: DataFrame, text_col: str = "text", carried: tuple[str, ...] = ("doc_id",), minimum: int = MINIMUM, first_scale: int = FIRST_SCALE
) -> DataFrame:
    """n_words, runs, collapsed, rest; one row per input row, in its partition.

    Words are what white space ([\\x20\\x09-\\x0D]) parts. ``runs`` are all maximal stretches of
    ``minimum`` words or more in which the smallest period fits twice, as (start, length, period) in
    words, in order of start and period. ``collapsed`` has the words but those that a run contains
    after its first period, joined by one space. ``rest`` holds the columns named in ``carried``,
    whatever their names. NULL and blank texts have no words, no runs and an empty collapsed text.
    Rows count one by one: ids may be NULL or repeated. Nothing is shuffled; a task holds a block of
    4 MB, or one text if that is longer, since a run may span a text as a whole.
    """
    rest = F.struct(*[F.col(c) for c in carried]) if carried else F.lit(None).cast("int")
    rows = docs.select(F.col(text_col).cast("string").alias("text"), rest.alias("rest"))
    names = ["n_words", "runs", "collapsed", "rest"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_blocks(batch.column(0), BLOCK_BYTES):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*block_runs(part.column(0), minimum, first_scale), part.column(1)], names)

    kind = rows.schema["rest"].dataType.simpleString()
    schema = f"n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string, rest {kind}"
    return rows.mapInArrow(find, schema)
