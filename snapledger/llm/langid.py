"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters, words padded by a space) in
order of frequency. A text gets the language whose profile has the least out-of-place distance to
the text's own: the sum, over the n-grams of the text, of how far their ranks lie apart, with the
greatest distance for an n-gram that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import written

TOP = 400
CHAR_BITS = 21
SPACE = 32
#: N-grams that a task adds up before it passes them on.
HELD = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers in ascending order, and how often each occurs."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    chars = np.where(letters()[chars], chars, SPACE)
    if not (chars != SPACE).any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    chars = np.concatenate(([SPACE], chars, [SPACE])).astype(np.uint64)
    chars = chars[np.concatenate(([True], (chars[1:] != SPACE) | (chars[:-1] != SPACE)))]
    two = chars[:-1] << np.uint64(CHAR_BITS) | chars[1:]
    three = (two[:-1] << np.uint64(CHAR_BITS) | chars[2:])[chars[1:-1] != SPACE]
    return np.unique(np.concatenate((chars[chars != SPACE], two, three)), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams first; equal counts in the order of the n-grams."""
    return keys[np.argsort(-counts, kind="stable")[:top]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, gram, place) from all rows with a language: the ``top`` most frequent n-grams of each.

    N-grams are counted over whole texts: added up per task first, then by (language, n-gram), so a
    language that has most of the rows makes no large group.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        parts: dict[str, list] = {}
        waiting = 0

        def merge() -> None:
            for lang, found in parts.items():
                found = found + [held[lang]] if lang in held else found
                keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                sums = np.bincount(where, np.concatenate([c for _, c in found]).astype(float), len(keys)).astype(np.int64)
                held[lang] = keys, sums
            parts.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (keys, sums) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(sums)], ["lang", "gram", "n"]
                )
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                found = grams(text.as_py())
                if len(found[0]):
                    parts.setdefault(lang.as_py(), []).append(found)
                    waiting += len(found[0])
                if waiting > HELD:
                    merge()
                    waiting = 0
                    if sum(len(k) for k, _ in held.values()) > HELD:
                        yield from out()
        merge()
        yield from out()

    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top).select("lang", "gram", "place")


class Profiles:
    """Ranks of all profiles, ready to compare texts with. It holds ``top`` n-grams per language."""

    def __init__(self, rows: list, top: int):
        self.top = top
        self.langs = sorted({r.lang for r in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.keys = np.unique(np.array([r.gram for r in rows], np.int64).astype(np.uint64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int32)
        at = np.searchsorted(self.keys, np.array([r.gram for r in rows], np.int64).astype(np.uint64))
        for i, r in zip(at, rows):
            self.ranks[i, place[r.lang]] = r.place - 1

    def best(self, text: str | None) -> tuple[str, float]:
        """The nearest language, the first by name among equals, and one minus its share of the greatest distance."""
        keys, counts = grams(text)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        mine = ranked(keys, counts, self.top)
        at = np.searchsorted(self.keys, mine)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != mine)] = len(self.keys)
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(len(mine))[:, None])).sum(0)
        lang = int(np.argmin(apart))
        return self.langs[lang], 1.0 - float(apart[lang]) / (self.top * len(mine))


def without_unknown(docs: DataFrame, profiles: DataFrame, text_col: str = "text", top: int = TOP) -> DataFrame:
    """``docs``, all columns as they were, without the rows whose language is not known (``und``).

    Without any profile nothing tells languages apart, and only rows without a letter go.
    """
    known = Profiles(written(profiles, "profiles").collect(), top)
    at = docs.columns.index(text_col)

    def stays(text: str | None) -> bool:
        return known.best(text)[0] != UNKNOWN if known.langs else len(grams(text)[0]) > 0

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([stays(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score per input row. Text that is NULL or has no letter: ``und``, score 0.

    Without any profile every row is ``und``. The profiles are fetched once: ``top`` rows per
    language, whatever the number of documents.
    """
    known = Profiles(written(profiles, "profiles").collect(), top)
    schema = docs.select(F.col(id_col).alias("doc_id")).schema
    kind = schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.best(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
