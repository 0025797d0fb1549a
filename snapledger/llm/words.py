"""Words of many texts at once, as arrays: where they lie in the bytes, and numbers that stand for them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Zero bytes after the text of a block, so that eight bytes can be read at any place.
PAD = 16
#: Words of more bytes are compared by Python; they are rare.
LONG = 256
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(32)
#: The bytes of a word that are read: the lowest n of eight.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def text_blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows, in order, each of at most ``limit`` bytes of text or of one row."""
    sizes = np.array(pc.fill_null(pc.binary_length(column), 0), np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, stop
        at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts with ``PAD`` more, and the places where each text begins and the last ends. NULL is empty."""
    if not len(column):
        return np.zeros(PAD, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, values = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(places[0]), int(places[-1])
    data = np.zeros(last - first + PAD, np.uint8)
    if last > first:
        data[: last - first] = np.frombuffer(values, np.uint8)[first:last]
    return data, places - first


def cut_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and text of each word, in order. ``inside`` says for each byte value whether it is part of a word."""
    flags = inside[data[: len(data) - PAD]]
    turns = np.empty(len(flags) + 1, bool)
    turns[0], turns[-1] = (flags[0], flags[-1]) if len(flags) else (False, False)
    np.not_equal(flags[1:], flags[:-1], out=turns[1:-1])
    # A word ends with its text, even if the next text goes on with another.
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(flags))]
    joined = edges[flags[edges] & flags[edges - 1]]
    if len(joined):
        places = np.sort(np.concatenate([np.flatnonzero(turns), joined, joined]))
    else:
        places = np.flatnonzero(turns)
    starts, ends = places[::2], places[1::2]
    return starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1


def load(data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to eight bytes at each place as one number; bytes after ``sizes`` count as zero."""
    view = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    return view[places] & MASKS[np.clip(sizes, 0, 8)]


def word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """A number per word of at most ``LONG`` bytes; that of a longer word says nothing. Equal words have equal ones."""
    out = (sizes.astype(np.uint64) + np.uint64(seed)) * C2
    some, at = np.arange(len(starts)), 0
    while len(some):
        if at:
            mixed = out[some] ^ load(data, starts[some] + at, sizes[some] - at)
        else:
            mixed = out ^ load(data, starts, sizes)
        mixed *= C1
        mixed ^= mixed >> SHIFT
        mixed *= C2
        mixed ^= mixed >> SHIFT
        out[some] = mixed
        at += 8
        some = some[(sizes[some] > at) & (sizes[some] <= LONG)]
    return out


def same_words(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_at: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Whether the words at ``at`` are those at ``other_at`` in ``other``, byte by byte."""
    same = sizes == other_sizes
    some, done = np.flatnonzero(same), 0
    while len(some):
        equal = load(data, at[some] + done, sizes[some] - done) == load(other, other_at[some] + done, sizes[some] - done)
        same[some[~equal]] = False
        done += 8
        some = some[equal & (sizes[some] > done)]
    return same


def word_numbers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal exactly where the words are. Hashes are compared with bytes; if
    two words share one, another seed is tried."""
    short = np.flatnonzero(sizes <= LONG)
    at, size = starts[short], sizes[short]
    seed = 0
    while True:
        _, first, numbers = np.unique(word_hashes(data, at, size, seed), return_index=True, return_inverse=True)
        likened = first[numbers]
        if same_words(data, at, size, data, at[likened], size[likened]).all():
            break
        seed += 1
    out = np.empty(len(starts), np.int64)
    out[short] = numbers
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(sizes > LONG).tolist():
        word = data[starts[i] : starts[i] + sizes[i]].tobytes()
        out[i] = len(first) + known.setdefault(word, len(known))
    return out
