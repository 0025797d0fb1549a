"""Leases of runs: who is at work, and which commits the work goes out from.

Files of the folder ``leases`` in the root of a store::

    <run id>-<milliseconds>.live    held by a driver, which touches it four times in that time
    <run id>-<milliseconds>.lost    taken from a driver that did not
    <run id>.bases/<entity>@<n>     the run has started an entity from commit n

A lease is taken over by a rename that fails if it was taken before. The former holder finds its file
gone before it commits, and publishes nothing more. One that stands still between that look and its
commit is stopped by the number of the commit: before files of a run that was taken over are removed,
a record is published under the number that this run would use. The clocks of drivers must agree
better than half the time of a lease.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from snapledger.sources import fs

log = logging.getLogger(__name__)

#: Seconds after which a lease that was not touched may be taken over.
LEASE_SECONDS = 120.0


class LeaseLost(RuntimeError):
    """The run was taken for dead and taken over."""


@dataclass(frozen=True)
class Held:
    """A lease as others see it."""

    run_id: int
    stem: str
    #: Seconds since it was last touched, and after how many it may be taken over.
    age: float
    seconds: float
    lost: bool

    @property
    def dead(self) -> bool:
        return self.age > self.seconds


@dataclass(frozen=True)
class Note:
    """Work of a run on an entity: the commit it goes out from, the seconds since, and whether the run has a lease."""

    run_id: int
    number: int
    age: float
    live: bool


def leases(spark: SparkSession, folder: str) -> list[Held]:
    """All leases in order of their runs, those that were taken over included."""
    found = []
    for name, age in fs.ages(spark, folder).items():
        stem, _, state = name.rpartition(".")
        if state in ("live", "lost"):
            run_id, _, milliseconds = stem.partition("-")
            found.append(Held(int(run_id), stem, age, int(milliseconds) / 1000, state == "lost"))
    return sorted(found, key=lambda h: h.run_id)


def take_over(spark: SparkSession, folder: str, failed: Callable[[int], None]) -> list[int]:
    """Take the leases of dead drivers, call ``failed`` with the id of each of these runs, and return the ids.

    Of several that try, one gets a lease. If it dies in its turn before it is done, the lease is
    found lost and no longer touched, and ``failed`` is called again.
    """
    settled = []
    for held in leases(spark, folder):
        if not held.dead:
            continue
        live, lost = f"{folder}/{held.stem}.live", f"{folder}/{held.stem}.lost"
        if not held.lost:
            try:
                if not fs.rename_new(spark, live, lost):
                    continue
            except Exception:
                if fs.exists(spark, live):
                    raise
                continue  # its holder has finished meanwhile
        fs.touch(spark, lost)
        log.warning("run %s is taken over: its driver was last seen %.0f s ago", held.run_id, held.age)
        failed(held.run_id)
        fs.remove(spark, lost)
        settled.append(held.run_id)
    return settled


def notes(spark: SparkSession, folder: str, entity: str) -> list[Note]:
    """What runs have noted on an entity. A note without a lease is of a run that was taken over."""
    live = {h.run_id for h in leases(spark, folder) if not h.lost}
    found = []
    for name in fs.list_names(spark, folder):
        run_id, _, kind = name.partition(".")
        if kind == "bases":
            for note, age in fs.ages(spark, f"{folder}/{name}").items():
                noted, _, number = note.rpartition("@")
                if unquote(noted) == entity:
                    found.append(Note(int(run_id), int(number), age, int(run_id) in live))
    return found


def forget(spark: SparkSession, folder: str, entity: str, note: Note) -> None:
    """Remove a note, and the folder of the run with its last one."""
    path = f"{folder}/{note.run_id}.bases"
    fs.remove(spark, f"{path}/{quote(entity, safe='')}@{note.number}")
    if not fs.list_names(spark, path):
        fs.remove(spark, path)


class Lease:
    """The lease of a run, to be used as a context; a thread of the driver touches it.

    If the context is left by an exception the lease stays and is taken over once it has run out.
    """

    def __init__(self, spark: SparkSession, folder: str, run_id: int, seconds: float = LEASE_SECONDS):
        self.spark, self.folder, self.run_id, self.seconds = spark, folder, run_id, seconds
        self.path = f"{folder}/{run_id}-{int(seconds * 1000)}.live"
        self._done = threading.Event()
        self._beat = threading.Thread(target=self._beats, name=f"lease-{run_id}", daemon=True)

    def __enter__(self) -> "Lease":
        if not fs.create_new(self.spark, self.path):
            raise LeaseLost(f"run {self.run_id} has a lease already")
        self._beat.start()
        return self

    def __exit__(self, failure, *_) -> None:
        self._done.set()
        self._beat.join()
        if failure is None and fs.exists(self.spark, self.path):
            # The notes first: without the lease they would be those of a lost run.
            fs.remove(self.spark, f"{self.folder}/{self.run_id}.bases")
            fs.remove(self.spark, self.path)

    def _beats(self) -> None:
        while not self._done.wait(self.seconds / 4):
            try:
                fs.touch(self.spark, self.path)
            except Exception as failure:  # check() finds out whether the file is gone
                log.warning("lease of run %s was not touched: %s", self.run_id, failure)

    def note(self, entity: str, number: int) -> None:
        """Say that work on an entity goes out from a commit; what it lists is kept until the run has ended."""
        self.check()
        fs.create_new(self.spark, f"{self.folder}/{self.run_id}.bases/{quote(entity, safe='')}@{number}")

    def check(self) -> None:
        """Raise :class:`LeaseLost` if the lease was taken over."""
        if not fs.exists(self.spark, self.path):
            raise LeaseLost(f"run {self.run_id} was taken over")
