"""Versioned targets and logs on plain parquet.

Layout below the root::

    targets/<target table>/opened/version=V    rows that a run, a load or a compaction has opened
    targets/<target table>/ended/version=V     (key, version that opened it, how it ended)
    targets/<target table>/closed/version=V    closed rows, put together by a compaction
    targets/<target table>/before/version=V    rows as they were before a run ended them, if wanted
    targets/<target table>/digests/version=V   what a run has added to the digests of the key buckets
    commits/<entity>/<number>.json             one record per commit, numbered without gaps
    changes/<entity>/run_id=N                  keys that are not unchanged, with their class
    logs/error_log/N/<entity>
    logs/run_events/N-<seq>
    runs/N                                     claim of a run id
    leases/N-<milliseconds>.live               lease of a run that is at work

A run writes the rows that it opens and the keys that it ends, nothing else, so it costs as much as
has changed. The last commit record lists the versions that make up the target: its active rows are
the opened ones that have not ended. What has ended is named by file and place, so a reader of the
active rows skips it at the scan. :meth:`VersionStore.maintain` merges versions of like size, and
:meth:`VersionStore.compact` puts everything together.

A commit record gets its number by a rename that fails if the number is taken. A run numbers its
record after the one that it started from, so of two runs that overlap one fails. Files that no
record lists are never read; there is nothing to undo after a failure.
"""

from __future__ import annotations

import json
import logging
import secrets
from collections import defaultdict
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.columns import CONTROL_COLUMNS
from snapledger.functions.hashing import ENCODING_VERSION, canonical_row
from snapledger.operators import digests as dg
from snapledger.operators.quality import ERROR_SCHEMA
from snapledger.sources import fs, leases
from snapledger.sources.rows import no_rows, one_row

COUNTERS = [
    "rows_inserted",
    "rows_updated",
    "rows_deleted",
    "rows_unchanged",
    "duplicate_inserts",
    "duplicate_updates",
    "key_errors",
]
ENTITY_LOG_SCHEMA = (
    "run_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, entity_name string, "
    + ", ".join(f"{c} bigint" for c in COUNTERS)
)
# A stored error row is an object whose fields are read by path; one that is no object stays text, as in older logs.
STORED_ERROR_SCHEMA = f"{ERROR_SCHEMA}, error_object variant"
RUN_EVENT_SCHEMA = "run_id bigint, seq int, status string, ts timestamp_ntz"

log = logging.getLogger(__name__)

# Kinds of commits. Only runs are shown in the entity log.
RUN, ADOPT, COMPACT, RESET, CARRY, REHASH, FENCE = "run", "adopt", "compact", "reset", "carry", "rehash", "fence"

# Where an active row lies: its version, the number of its file there, and its place in the file.
PLACE = ["opened_version", "opened_file", "opened_row"]

# Most ended rows, and most words of 64 bits, of deletion vectors that are sent to every task.
VECTOR_ROWS, VECTOR_WORDS = 1_000_000, 4_000_000

# So many versions of like size are merged to one; a size class reaches to so many times its least.
FANOUT = 8


class CommitConflict(RuntimeError):
    """Another commit of the entity came first."""


@dataclass(frozen=True)
class Commit:
    """One commit of an entity and the state of its target after it."""

    entity_name: str
    location: str
    number: int = 0
    kind: str = RUN
    schema: str | None = None
    hash_nulls: str = "keep"
    encoding_version: int = ENCODING_VERSION
    primary_key: str | None = None
    opened: list[int] = field(default_factory=list)
    ended: list[int] = field(default_factory=list)
    closed: list[int] = field(default_factory=list)
    active_rows: int = 0
    run_id: int | None = None
    snapshot_id: int | None = None
    start_ts: str | None = None
    end_ts: str | None = None
    counters: dict[str, int] = field(default_factory=dict)
    #: Rows of each version, and of the opened ones those that have ended. Older records lack some.
    sizes: dict[str, int] = field(default_factory=dict)
    dead: dict[str, int] = field(default_factory=dict)
    #: Versions of bucket digests, to be added up, and the sums of groups of buckets. None if not known.
    digests: list[int] | None = None
    digest_sums: dict[str, list[int]] = field(default_factory=dict)
    #: Columns that the hashes are of; older records do not know them.
    hashed_columns: list[str] | None = None
    #: The rows before they ended, if this commit has kept them.
    before: int | None = None

    def following(self, **changed) -> "Commit":
        """The record after this one, with the same target unless told otherwise."""
        own = {"run_id": None, "snapshot_id": None, "start_ts": None, "end_ts": None, "counters": {}, "before": None}
        return replace(self, **{**own, "number": self.number + 1, **changed})

    def columns(self) -> T.StructType | None:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else None

    def size(self, versions: list[int]) -> int | None:
        """Rows of some versions together; None if one of them is not known."""
        known = [self.sizes.get(str(v)) for v in versions]
        return None if None in known else sum(known)

    def live(self, version: int) -> int | None:
        """Rows of an opened version that have not ended."""
        size = self.sizes.get(str(version))
        return None if size is None else size - self.dead.get(str(version), 0)

    def counted(self, sizes: dict[int, int] | None = None, dead: dict[int, int] | None = None) -> "Commit":
        """This record with more counts, and without those of versions that it does not list."""
        listed = {str(v) for v in [*self.opened, *self.ended, *self.closed]}
        every = {**self.sizes, **{str(v): n for v, n in (sizes or {}).items()}}
        gone = defaultdict(int, self.dead)
        for v, n in (dead or {}).items():
            gone[str(v)] += n
        return replace(self, sizes={v: n for v, n in every.items() if v in listed}, dead={v: n for v, n in gone.items() if v in listed and n})


def size_class(rows: int) -> int:
    """Versions of one class differ in size by less than ``FANOUT`` times."""
    return int(np.emath.logn(FANOUT, max(1, rows)) + 1e-9)


def due(record: Commit) -> dict[str, list[int]]:
    """Versions that should be merged, by part: those of a size class that has ``FANOUT`` of them, and
    opened ones more than half of whose rows have ended. Versions whose size is not known stay."""
    out: dict[str, list[int]] = {}
    for part in ("opened", "ended", "closed"):
        classes: dict[int, list[int]] = defaultdict(list)
        chosen: set[int] = set()
        for v in getattr(record, part):
            rows = record.live(v) if part == "opened" else record.sizes.get(str(v))
            if rows is None:
                continue
            classes[size_class(rows)].append(v)
            if part == "opened" and 2 * record.dead.get(str(v), 0) > record.sizes[str(v)]:
                chosen.add(v)
        for versions in classes.values():
            if len(versions) >= FANOUT:
                chosen.update(versions)
        if chosen:
            out[part] = [v for v in getattr(record, part) if v in chosen]
    if len(record.digests or []) >= 2 * FANOUT:
        out["digests"] = list(record.digests)
    return out


class VersionStore:
    """Targets and logs of all entities below one root path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known_vectors: dict[tuple, pa.Table] = {}

    # paths

    @staticmethod
    def _name(name: str) -> str:
        if name in ("", ".", ".."):
            raise ValueError(f"{name!r} cannot name an entity or a target")
        return quote(name, safe="")

    def location(self, target_table: str) -> str:
        """The place of a target below the root."""
        return f"targets/{self._name(target_table)}"

    def _part(self, location: str, part: str, version: int | None = None) -> str:
        path = f"{self.root}/{location}/{part}"
        return path if version is None else f"{path}/version={version}"

    def _commits(self, entity: str) -> str:
        return f"{self.root}/commits/{self._name(entity)}"

    def _changes(self, entity: str) -> str:
        return f"{self.root}/changes/{self._name(entity)}"

    def leases_path(self) -> str:
        return f"{self.root}/leases"

    def _log(self, name: str) -> str:
        return f"{self.root}/logs/{name}"

    def _read_log(self, name: str, schema: str) -> DataFrame:
        path = self._log(name)
        if not fs.exists(self.spark, path):
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    # commits

    def _numbers(self, entity: str) -> list[str]:
        """Names of the commit records in order: one listing of one folder."""
        return [n for n in fs.list_names(self.spark, self._commits(entity)) if n.endswith(".json") and n[0] != "."]

    def latest(self, entity: str) -> Commit | None:
        names = self._numbers(entity)
        if not names:
            return None
        return Commit(**json.loads(fs.read_text(self.spark, f"{self._commits(entity)}/{names[-1]}")))

    def records(self, entity: str, after: int, upto: int | None = None) -> list[Commit]:
        """The records with a number above ``after``, and up to ``upto``, in order."""
        names = [n for n in self._numbers(entity) if after < int(n.partition(".")[0]) <= (upto or int(n.partition(".")[0]))]
        return [Commit(**json.loads(fs.read_text(self.spark, f"{self._commits(entity)}/{n}"))) for n in names]

    def commit(self, record: Commit) -> None:
        """Publish a record. Raises :class:`CommitConflict` if its number is taken."""
        folder = self._commits(record.entity_name)
        draft = f"{folder}/.{secrets.token_hex(8)}"
        fs.make_dirs(self.spark, folder)
        fs.write_text(self.spark, draft, json.dumps(asdict(record)))
        if not fs.rename_new(self.spark, draft, f"{folder}/{record.number:012d}.json"):
            fs.remove(self.spark, draft)
            raise CommitConflict(f"another run of {record.entity_name} was committed meanwhile")

    def commits(self, entity: str | None = None) -> DataFrame:
        """Records of committed runs, of one entity or of all."""
        counters = ", ".join(f"{c}: bigint" for c in COUNTERS)
        schema = (
            "kind string, entity_name string, run_id bigint, snapshot_id bigint, start_ts string, end_ts string, "
            f"counters struct<{counters}>"
        )
        path = f"{self.root}/commits" if entity is None else self._commits(entity)
        if not fs.exists(self.spark, path):
            return no_rows(self.spark, schema)
        records = self.spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
        return records.where(F.col("kind") == RUN)

    # logs

    def entity_log(self) -> DataFrame:
        stamps = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_ts", "end_ts")]
        return self.commits().select("run_id", *stamps, "entity_name", *[F.col(f"counters.{c}").alias(c) for c in COUNTERS])

    def error_objects(self) -> DataFrame:
        """The error log with each row as an object, ``error_object``, for :func:`variant_get`. Only rows that
        were stored as text (in older logs, or because they are too large for an object) are parsed."""
        rows = self._read_log("error_log", STORED_ERROR_SCHEMA)
        return rows.withColumn("error_object", F.coalesce("error_object", F.try_parse_json("error_row"))).drop("error_row")

    def error_log(self) -> DataFrame:
        """The error log with each row as JSON text."""
        return self._as_text(self._read_log("error_log", STORED_ERROR_SCHEMA))

    @staticmethod
    def _as_text(rows: DataFrame) -> DataFrame:
        text = F.coalesce("error_row", F.to_json("error_object"))
        return rows.withColumn("error_row", text).drop("error_object")

    def run_events(self) -> DataFrame:
        return self._read_log("run_events", RUN_EVENT_SCHEMA)

    def claim_run(self, run_id: int) -> bool:
        """False if another run took this id."""
        return fs.create_new(self.spark, f"{self.root}/runs/{run_id}")

    def claimed_runs(self) -> list[int]:
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/runs"))

    def append_event(self, run_id: int, seq: int, status: str, ts: datetime) -> None:
        row = one_row(self.spark, RUN_EVENT_SCHEMA, (run_id, seq, status, ts))
        row.write.mode("overwrite").parquet(f"{self._log('run_events')}/{run_id}-{seq}")

    def append_errors(self, run_id: int, entity: str, errors: DataFrame, part: str = "rows") -> DataFrame:
        """Write the error rows of one run and entity and return them as stored. A retry replaces
        its own rows and no others."""
        path = f"{self._log('error_log')}/{run_id}/{self._name(entity)}/{part}"
        whole = errors.withColumn("error_object", F.try_parse_json("error_row"))
        whole = whole.withColumn("error_row", F.when(F.col("error_object").isNull(), F.col("error_row")))
        whole.write.mode("overwrite").parquet(path)
        return self._as_text(self.spark.read.schema(STORED_ERROR_SCHEMA).parquet(path))

    # targets

    def schema(self, entity: str) -> T.StructType | None:
        record = self.latest(entity)
        return None if record is None else record.columns()

    def _known(self, entity: str) -> Commit:
        record = self.latest(entity)
        if record is None or record.schema is None:
            raise ValueError(f"entity {entity} has no target yet")
        return record

    def _read(self, location: str, part: str, versions: list[int], schema: T.StructType, placed: bool = False) -> DataFrame:
        """Rows of some versions with the version that they are in, and if wanted with the file and the place there."""
        full = T.StructType([*schema, T.StructField("version", T.LongType())])
        place = {"opened_file": T.IntegerType(), "opened_row": T.LongType()} if placed else {}
        if not versions:
            return no_rows(self.spark, T.StructType([*full, *[T.StructField(n, t) for n, t in place.items()]]))
        reader = self.spark.read.schema(full).option("basePath", self._part(location, part))
        rows = reader.parquet(*[self._part(location, part, v) for v in versions])
        if not placed:
            return rows
        # Files of a version are named part-<number>-<id>; each task has written one.
        number = F.substring_index(F.substring("_metadata.file_name", 6, 12), "-", 1).cast("int")
        return rows.select("*", number.alias("opened_file"), F.col("_metadata.row_index").alias("opened_row"))

    def _ended_schema(self, columns: T.StructType, pk: str) -> T.StructType:
        types = {
            "opened_version": "bigint", "end_ts": "timestamp_ntz", "cdc_operation": "string", "is_kept": "boolean",
            "opened_file": "int", "opened_row": "bigint",
        }
        return T.StructType([columns[pk], *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in types.items()))])

    def _ended(self, record: Commit) -> DataFrame:
        """What has ended in versions that the target still has."""
        rows = self._read(record.location, "ended", record.ended, self._ended_schema(record.columns(), record.primary_key)).drop("version")
        return rows.where(F.col("opened_version").isin(record.opened))

    def _vectors(self, record: Commit) -> DataFrame | None:
        """Deletion vectors, one row: for each opened version (in order of the record), for each of its
        files, a bit per row, 64 to a word. None if they are too large or some places are not known."""
        size = record.size(record.ended)
        if size is None or size > VECTOR_ROWS:
            return None
        key = (record.location, tuple(record.opened), tuple(record.ended))
        table = self._known_vectors.get(key)
        if table is None:
            ended = self._ended(record).select(*PLACE).toArrow()
            version, file, row = (ended.column(c) for c in PLACE)
            if file.null_count or row.null_count:
                return None
            index = np.array([record.opened.index(v) for v in version.to_pylist()], np.int64)
            file, row = file.to_numpy().astype(np.int64), row.to_numpy()
            order = np.lexsort((row, file, index))
            index, file, row = index[order], file[order], row[order]
            first = np.flatnonzero((np.diff(index, prepend=-1) != 0) | (np.diff(file, prepend=-1) != 0))
            last = np.append(first[1:], len(row))[: len(first)] - 1
            if int((row[last] // 64 + 1).sum()) > VECTOR_WORDS:
                return None
            vectors: list[list] = [[] for _ in record.opened]
            for a, b in zip(first.tolist(), last.tolist()):
                words = np.zeros(int(row[b]) // 64 + 1, np.uint64)
                np.bitwise_or.at(words, row[a : b + 1] // 64, np.uint64(1) << (row[a : b + 1] % 64).astype(np.uint64))
                files = vectors[int(index[a])]
                files.extend([] for _ in range(int(file[a]) - len(files)))
                files.append(words.view(np.int64).tolist())
            table = pa.table({"vectors": pa.array([vectors], pa.list_(pa.list_(pa.list_(pa.int64()))))})
            # Replaced as a whole: entities that run at the same time read it.
            self._known_vectors = {**dict(list(self._known_vectors.items())[-7:]), key: table}
        return self.spark.createDataFrame(table)

    def active_rows(self, record: Commit) -> DataFrame:
        """The active slice after a commit, each row with its ``PLACE``.

        Rows that have ended since the last compaction are told by deletion vectors while these are
        small, which is measured; the scan is filtered and nothing is joined. Larger ones, and the
        keys of records without places, are taken off by a join: an active key occurs once, so key and
        version name a row.
        """
        columns = record.columns()
        rows = self._read(record.location, "opened", record.opened, columns, placed=True).withColumnRenamed("version", "opened_version")
        if not record.ended or not record.opened:
            return rows
        vectors = self._vectors(record)
        if vectors is not None:
            return rows.where(~self._is_set(vectors.scalar(), record.opened))
        on = [record.primary_key, "opened_version"]
        return rows.join(self._ended(record).select(*on), on, "left_anti").select(*columns.fieldNames(), *PLACE)

    @staticmethod
    def _is_set(vectors: Column, versions: list[int]) -> Column:
        """Whether the deletion vectors have the bit of a row."""
        index = F.array_position(F.array(*[F.lit(v).cast("long") for v in versions]), F.col("opened_version")).cast("int") - 1
        word = F.get(F.get(F.get(vectors, index), F.col("opened_file")), (F.shiftright("opened_row", 6)).cast("int"))
        return F.getbit(F.coalesce(word, F.lit(0).cast("long")), F.col("opened_row").bitwiseAND(F.lit(63)).cast("int")) == 1

    def closed_rows(self, record: Commit) -> DataFrame:
        columns = record.columns()
        closed = self._read(record.location, "closed", record.closed, columns).drop("version")
        if not record.ended or not record.opened:
            return closed
        on = [record.primary_key, "opened_version"]
        ends = self._ended(record).where("is_kept").select(*on, F.col("end_ts").alias("_end_ts"), F.col("cdc_operation").alias("_operation"))
        rows = self._read(record.location, "opened", record.opened, columns).withColumnRenamed("version", "opened_version").join(ends, on)
        changed = {
            "end_ts": F.col("_end_ts"),
            "is_active": F.lit(False),
            "cdc_operation": F.coalesce("_operation", "cdc_operation"),
        }
        return closed.unionByName(rows.select(*[changed.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in columns]))

    def read_active(self, entity: str) -> DataFrame:
        return self.active_rows(self._known(entity)).drop(*PLACE)

    def read_closed(self, entity: str) -> DataFrame:
        return self.closed_rows(self._known(entity))

    def read_target(self, entity: str) -> DataFrame:
        record = self._known(entity)
        return self.active_rows(record).drop(*PLACE).unionByName(self.closed_rows(record))

    def write(self, location: str, part: str, rows: DataFrame) -> tuple[int | None, int]:
        """Write rows as a new version and return it with their number; no version for no rows."""
        version = secrets.randbits(62)
        path = self._part(location, part, version)
        # One file per task: the number of a file then names it.
        rows.write.option("maxRecordsPerFile", 0).parquet(path)
        count = self.spark.read.schema(rows.schema).parquet(path).count()
        return (version, count) if count else (None, 0)

    def adopt(self, entity: str, target_table: str, pk: str, rows: DataFrame, hash_nulls: str = "keep") -> None:
        """Make a versioned frame, history included, the target of an entity that has none yet."""
        record = self.latest(entity)
        if record is not None and record.schema is not None:
            raise ValueError(f"entity {entity} has a target already")
        location = self.location(target_table)
        opened, count = self.write(location, "opened", rows.where("is_active"))
        closed, ended = self.write(location, "closed", rows.where("not is_active"))
        start = record or Commit(entity, location)
        state = start.following(
            location=location, kind=ADOPT, schema=rows.schema.json(), hash_nulls=hash_nulls, primary_key=pk, encoding_version=ENCODING_VERSION,
            opened=[opened] if count else [], closed=[closed] if closed is not None else [], ended=[], active_rows=count,
        )
        self.commit(replace(state, **self._digest_anew(state)).counted({opened: count, closed: ended}))

    def compact(self, entity: str) -> None:
        """Put the active rows together in one version and the rows that ended since in another."""
        self._put_together(self._known(entity), COMPACT)

    def rehash(self, entity: str, hash_nulls: str, columns: list[str] | None = None) -> None:
        """Compute the hashes of the active rows anew, by this library's encoding and ``hash_nulls``.

        No version opens or ends: rows keep their times, and a run that hashes alike finds nothing changed. It is the way
        from one encoding, or treatment of NULL, to another. ``columns`` are those that snapshots have, if the
        target has more and no run has noted them. Values are hashed as the target holds them, so a snapshot column of another
        type must have the same text.
        """
        record = self._known(entity)
        hashed = columns or record.hashed_columns or [f.name for f in record.columns() if f.name not in CONTROL_COLUMNS]

        def anew(rows: DataFrame) -> DataFrame:
            return rows.withColumn("row_hash", F.sha2(canonical_row(rows, hashed, hash_nulls), 256)).select(*rows.columns)

        self._put_together(record, REHASH, anew, hash_nulls=hash_nulls, encoding_version=ENCODING_VERSION, hashed_columns=hashed)

    def _put_together(self, record: Commit, kind: str, change=None, **fields) -> None:
        rows = self.active_rows(record).drop(*PLACE)
        opened, count = self.write(record.location, "opened", change(rows) if change else rows)
        since = replace(record, closed=[])
        closed, ended = self.write(record.location, "closed", self.closed_rows(since))
        state = record.following(
            kind=kind, opened=[opened] if count else [], ended=[],
            closed=record.closed + ([closed] if closed is not None else []), **fields,
        )
        self.commit(replace(state, **self._digest_anew(state)).counted({opened: count, closed: ended}))

    def maintain(self, entity: str) -> dict[str, list[int]]:
        """Merge the versions that are :func:`due`, and return them; no row changes.

        A row is written again once per size class, so the rows written grow with the logarithm of the
        rows opened, and so does the number of versions. Opened versions leave their closed rows behind
        as a closed version; what had ended in them goes when its own version is merged.
        """
        record = self._known(entity)
        merge = due(record)
        if not merge:
            return merge
        opened, ended, closed, sizes = list(record.opened), list(record.ended), list(record.closed), {}
        summed = {"digests": record.digests}
        if "digests" in merge:
            summed = self.add_digests(record.location, self.digests(record), [], {})

        def put(part: str, listed: list[int], rows: DataFrame) -> None:
            version, count = self.write(record.location, part, rows)
            if version is not None:
                listed.append(version)
                sizes[version] = count

        if "opened" in merge:
            some = replace(record, opened=merge["opened"], closed=[])
            opened = [v for v in opened if v not in merge["opened"]]
            put("opened", opened, self.active_rows(some).drop(*PLACE))
            put("closed", closed, self.closed_rows(some))
        state = record.following(kind=COMPACT, opened=opened)
        if "ended" in merge:
            ended = [v for v in ended if v not in merge["ended"]]
            put("ended", ended, self._ended(replace(state, ended=merge["ended"])))
        if "closed" in merge:
            rows = self._read(record.location, "closed", merge["closed"], record.columns()).drop("version")
            closed = [v for v in closed if v not in merge["closed"]]
            put("closed", closed, rows)
        self.commit(replace(state, ended=ended, closed=closed, **summed).counted(sizes))
        return merge

    def vacuum(self, entity: str, older_than: float = 86_400.0) -> list[str]:
        """Remove versions and key tables that neither the target, nor a consumer of its feed, nor a run
        with a lease needs, if they have not been changed for so many seconds. Returns the removed paths.

        A leased run keeps what the commit lists that it goes out from, and whatever was written since,
        however long it takes. Ages protect only runs of a single entity without a lease
        (``run_entity``); where there are none, ``older_than=0`` is safe. What a run has left that was
        taken over goes too; it can no longer commit then. The key table of the last committed run stays."""
        record = self._known(entity)
        at_work, lost = [], []
        for note in leases.notes(self.spark, self.leases_path(), entity):
            (at_work if note.live else lost).append(note)
        if any(n.number >= record.number for n in lost):
            record = record.following(kind=FENCE)
            self.commit(record)
        read_from = min([*self.offsets(entity).values(), *[n.number for n in at_work]], default=record.number)
        older_than = max([older_than, *[n.age for n in at_work]])
        waiting = self.records(entity, read_from - 1, record.number)
        gone = []
        for part in ("opened", "ended", "closed", "before", "digests"):
            lists = [[r.before] if part == "before" else getattr(r, part) or [] for r in [*waiting, record]]
            needed = {f"version={v}" for versions in lists for v in versions}
            folder = self._part(record.location, part)
            gone += [f"{folder}/{n}" for n, age in fs.ages(self.spark, folder).items() if n not in needed and age >= older_than]
        runs = {n: age for n, age in fs.ages(self.spark, self._changes(entity)).items() if n.startswith("run_id=")}
        unsettled = {f"run_id={n.run_id}" for n in lost}
        last = max((int(n.partition("=")[2]) for n in runs if n not in unsettled), default=None)
        kept = {f"run_id={last}", *[f"run_id={n.run_id}" for n in at_work]}
        gone += [f"{self._changes(entity)}/{n}" for n, age in runs.items() if n not in kept and age >= older_than]
        for path in gone:
            fs.remove(self.spark, path)
        for note in lost:
            leases.forget(self.spark, self.leases_path(), entity, note)
        return gone

    # digests

    def digests(self, record: Commit) -> DataFrame:
        """The digests of all buckets of a target (at most ``BUCKETS`` rows)."""
        schema = T.StructType.fromDDL(dg.DIGEST_SCHEMA)
        return dg.added_up(self._read(record.location, "digests", record.digests or [], schema).drop("version"), F.col("bucket"))

    def add_digests(self, location: str, sums: DataFrame, digests: list[int], digest_sums: dict[str, list[int]]) -> dict:
        """Write what is to be added to the digests. Returns both fields of the next record."""
        version, _ = self.write(location, "digests", sums)
        if version is None:
            return {"digests": digests, "digest_sums": digest_sums}
        added = self._read(location, "digests", [version], T.StructType.fromDDL(dg.DIGEST_SCHEMA))
        more = dg.as_dict(dg.added_up(added, dg.group_of(F.col("bucket"))))
        none = [0] * len(dg.SUMS)
        both = {g: [a + b for a, b in zip(digest_sums.get(g, none), more.get(g, none))] for g in {*digest_sums, *more}}
        return {"digests": [*digests, version], "digest_sums": {g: v for g, v in both.items() if any(v)}}

    def _digest_anew(self, record: Commit) -> dict:
        """The digests of a target from its active rows, read narrowly."""
        pk = record.primary_key
        return self.add_digests(record.location, dg.digest(self.active_rows(record).select(pk, "row_hash"), pk), [], {})

    # what single commits have changed

    def rows_of(self, record: Commit, part: str, versions: list[int]) -> DataFrame:
        """Whole rows of some versions, with their ``version``, as they were written."""
        return self._read(record.location, part, versions, record.columns())

    def ended_rows(self, record: Commit, versions: list[int]) -> DataFrame:
        """(key, ``opened_version``, how it ended) of some versions of ended keys."""
        schema = self._ended_schema(record.columns(), record.primary_key)
        return self._read(record.location, "ended", versions, schema).drop("version")

    def rows_before(self, record: Commit) -> DataFrame:
        """The rows that a run has ended, as they were before, with ``is_deleted``."""
        schema = T.StructType([*record.columns(), T.StructField("is_deleted", T.BooleanType())])
        return self._read(record.location, "before", [record.before], schema).drop("version")

    # consumers of the feed

    def _offsets(self, entity: str) -> str:
        return f"{self.root}/offsets/{self._name(entity)}"

    def offsets(self, entity: str) -> dict[str, int]:
        """The number of the last commit that each consumer of the entity's feed has read."""
        out = {}
        for name in fs.list_names(self.spark, self._offsets(entity)):
            numbers = fs.list_names(self.spark, f"{self._offsets(entity)}/{name}")
            out[unquote(name)] = max((int(n) for n in numbers if n.isdigit()), default=0)
        return out

    def move_offset(self, entity: str, consumer: str, number: int) -> bool:
        """Note that a consumer has read up to a commit; False if that was noted before."""
        return fs.create_new(self.spark, f"{self._offsets(entity)}/{self._name(consumer)}/{number:012d}")

    def write_changes(self, entity: str, run_id: int, changes: DataFrame) -> DataFrame:
        path = f"{self._changes(entity)}/run_id={run_id}"
        changes.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(changes.schema).parquet(path)

    def read_changes(self, entity: str, run_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self._changes(entity)}/run_id={run_id}")

    def reset(self, *entities: str, logs: bool = True) -> None:
        """Empty the named targets, and the logs of the store unless told otherwise.

        Commit records carry the entity log. With the logs those of the named entities go, and those
        of the others are replaced by one that has the state of the target alone.
        """
        for entity in entities:
            record = self.latest(entity)
            if record is None:
                continue
            if logs:
                fs.remove(self.spark, self._commits(entity))
            else:
                empty = {"opened": [], "ended": [], "closed": [], "active_rows": 0, "digests": None, "digest_sums": {}}
                self.commit(record.following(kind=RESET, schema=None, **empty).counted())
            fs.remove(self.spark, f"{self.root}/{record.location}")
            fs.remove(self.spark, self._changes(entity))
            fs.remove(self.spark, self._offsets(entity))
        if not logs:
            return
        for folder in fs.list_names(self.spark, f"{self.root}/commits"):
            names = [n for n in fs.list_names(self.spark, f"{self.root}/commits/{folder}") if n.endswith(".json") and n[0] != "."]
            if not names:
                continue
            last = Commit(**json.loads(fs.read_text(self.spark, f"{self.root}/commits/{folder}/{names[-1]}")))
            self.commit(last.following(kind=CARRY))
            for name in names:
                fs.remove(self.spark, f"{self.root}/commits/{folder}/{name}")
        for name in ("error_log", "run_events"):
            fs.remove(self.spark, self._log(name))
        fs.remove(self.spark, f"{self.root}/runs")
        fs.remove(self.spark, self.leases_path())
