"""Stored runs: compare the snapshots of all configured entities with their targets and publish.

Work of one entity run:

0. Compare digests of key buckets: one row per group of buckets and task leaves the scan. Keys of
   buckets that agree are unchanged and occur once, so only the other buckets go on; without any,
   the run ends here.
1. Classify the keys with narrow columns only and write the keys that are not unchanged. This table
   gives the counters, names the repeated keys, and decides the rest.
2. Log the errors, if there can be any. They stay even if the run fails later.
3. Write the rows that the run opens and the keys that it ends, and nothing if no key changed. The
   keys that end follow from the table of keys alone. The rows that open are those of the snapshot
   whose key is to be inserted or updated: few such keys (by rows and bytes, measured on the written
   table) are broadcast; on a first load the few repeated keys are broadcast and the other rows
   pass; otherwise both sides are joined by key.
4. Add what has changed to the digests of the target, and commit under the number after the commit
   that the run started from. Versions that are due are merged then.
"""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.config import ConfigError, EntityConfig, declared_limits, find_config, load_configs, plain_schema, with_key_of
from snapledger.functions.columns import CONTROL_COLUMNS, business_columns, spelled_like, target_schema, ts_literal, valid_key
from snapledger.functions.hashing import ENCODING_VERSION, with_row_hash
from snapledger.operators import digests
from snapledger.operators.changes import BLOCKED, DELETE, INSERT, UNCHANGED, UPDATE, classify, update_ts
from snapledger.operators.quality import ERROR_COUNTERS, ERROR_SCHEMA, RUNTIME_ERROR, detect_errors, error_counts, rejected_errors
from snapledger.operators.skew import ROWS_PER_TASK
from snapledger.plans.apply import check_schema, new_version
from snapledger.plans.runlog import COMPLETED, FAILED, RUNNING, run_log
from snapledger.sources.leases import LEASE_SECONDS, Lease, take_over
from snapledger.sources.rows import no_rows, one_row
from snapledger.sources.staging import Staged, read_staging
from snapledger.sources.store import PLACE, RUN, Commit, CommitConflict, VersionStore

log = logging.getLogger(__name__)

Clock = Callable[[], datetime]
Source = Callable[[SparkSession, str], DataFrame | Staged]


class EntityFailure(RuntimeError):
    """An entity run that must not publish."""


@dataclass
class Gate:
    """What the entities of one run share: no entity commits once the run was stopped."""

    lock: threading.Lock = field(default_factory=threading.Lock)
    stopped: bool = False
    #: The tag of the Spark jobs that end when the run is stopped.
    tag: str | None = None


class RunStopped(EntityFailure):
    """The run was stopped before this entity could commit."""


@dataclass(frozen=True)
class Limits:
    """Most rows and key bytes of a key table that may be broadcast."""

    rows: int = 1_000_000
    key_bytes: int = 64 * 1024 * 1024


#: Rows of a target from which the digests of single buckets are compared even if all groups differ.
FINE_FROM = 1 << 24


@dataclass(frozen=True)
class RunResult:
    run_id: int
    status: str
    failures: dict[str, str]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class _Totals:
    rows: dict[str, int]
    key_bytes: dict[str, int]
    blocked_in_target: int
    #: Rows that end, by the version that holds them.
    ended: dict[int, int]

    def few(self, limits: Limits, *classes: str) -> bool:
        return (
            sum(self.rows.get(c, 0) for c in classes) <= limits.rows
            and sum(self.key_bytes.get(c, 0) for c in classes) <= limits.key_bytes
        )


def _totals(changes: DataFrame, pk: str) -> _Totals:
    """Row and byte counts per class in one small job. There is at most one result row per class,
    side and version of the target."""
    size = F.coalesce(F.sum(F.octet_length(F.col(pk).cast("string"))), F.lit(0)).cast("long")
    rows: dict[str, int] = {}
    key_bytes: dict[str, int] = {}
    ended: dict[int, int] = {}
    blocked = 0
    for r in changes.groupBy("cdc_class", "in_target", "opened_version").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).collect():
        rows[r.cdc_class] = rows.get(r.cdc_class, 0) + r.n
        key_bytes[r.cdc_class] = key_bytes.get(r.cdc_class, 0) + r.bytes
        if r.cdc_class == BLOCKED and r.in_target:
            blocked += r.n
        if r.cdc_class in (UPDATE, DELETE):
            ended[r.opened_version] = ended.get(r.opened_version, 0) + r.n
    return _Totals(rows, key_bytes, blocked, ended)


@dataclass(frozen=True)
class Scope:
    """The part of the snapshot and of the active slice that may differ."""

    #: Predicates on rows of the snapshot and of the active slice; None for all rows.
    source: Column | None = None
    target: Column | None = None
    #: Rows of the snapshot without a valid key; None if they were not counted.
    missing_keys: int | None = None

    def of(self, rows: DataFrame, where: Column | None) -> DataFrame:
        return rows if where is None else rows.where(where)


def find_scope(store: VersionStore, state: Commit, hashed: DataFrame, fine_from: int = FINE_FROM) -> Scope:
    """Compare the digests of the snapshot with those of the target: first those of groups of buckets,
    then, in the groups that differ, those of buckets. The second level costs another pass over the
    keys of these groups; where all groups differ it is left out for a target of fewer than ``fine_from`` rows.
    Rows are counted before any is hashed: where the counts alone tell that nothing is to be left out,
    no row is hashed for it."""
    pk = state.primary_key
    key_type = state.columns()[pk].dataType
    place = digests.bucket(pk, key_type)
    valid = valid_key(pk)
    group = F.when(valid, digests.group_of(place)).otherwise(F.lit(-1))
    counted = {r.bucket: r["count"] for r in hashed.groupBy(group.alias("bucket")).count().collect()}
    missing = counted.pop(-1, 0)
    if digests.all_counts_differ(counted, state.digest_sums) and (
        state.active_rows < fine_from or digests.counts_differ(hashed.where(valid), store.digests(state), pk, key_type) >= digests.BUCKETS // 2
    ):
        return Scope(F.lit(True), F.lit(True), missing)
    seen = digests.as_dict(digests.added_up(hashed.select(group.alias("bucket"), *digests.row_sums("row_hash")), F.col("bucket")))
    missing = seen.pop("-1", [0])[0]
    groups = digests.differing_groups(seen, state.digest_sums)
    inside = F.lit(False)
    if groups:
        every = len(groups) == digests.GROUPS
        inside = F.lit(True) if every else digests.group_of(place).isin(groups)
        if not every or state.active_rows >= fine_from:
            new = digests.digest(hashed.where(valid & inside), pk, key_type)
            old = store.digests(state).where(digests.group_of(F.col("bucket")).isin(groups))
            buckets = [r.bucket for r in digests.differing(new, old).collect()]
            if len(buckets) < digests.BUCKETS // 2:
                # A bit per bucket, 64 to a word.
                words = [0] * (digests.BUCKETS // 64)
                for b in buckets:
                    words[b // 64] |= 1 << b % 64
                signed = [w - (1 << 64) if w >> 63 else w for w in words]
                word = F.get(F.lit(signed).cast("array<bigint>"), F.shiftright(place, 6))
                inside = F.getbit(word, place.bitwiseAND(F.lit(63))) == 1
    return Scope(inside | ~valid if missing else inside, inside, missing)


def _stamped(changes: DataFrame, pk: str, run_ts, update_stamps: DataFrame | None) -> DataFrame:
    """``changes`` with ``_ts``: the run's time, or for an update the time of its own."""
    base_ts = ts_literal(run_ts)
    if update_stamps is None:
        return changes.withColumn("_ts", base_ts)
    return changes.join(update_stamps.select(pk, "update_ts"), pk, "left").withColumn("_ts", F.coalesce("update_ts", base_ts))


def ended_keys(changes: DataFrame, cfg: EntityConfig, run_ts, update_stamps: DataFrame | None = None) -> DataFrame:
    """What ends: (key, its place, ``end_ts``, ``cdc_operation`` if it changes, ``is_kept``).

    A version that is overwritten or physically deleted is not kept. ``changes`` holds the keys to
    update and delete with the place of their active row; the target is not read.
    """
    pk = cfg.primary_key_column
    is_delete = F.col("cdc_class") == DELETE
    ended = _stamped(changes.where(F.col("cdc_class").isin(UPDATE, DELETE)), pk, run_ts, update_stamps)
    return ended.select(
        pk,
        *[c for c in PLACE if c in changes.columns],
        F.when(is_delete, ts_literal(run_ts)).otherwise(F.col("_ts")).alias("end_ts"),
        F.when(is_delete, F.lit("D")).alias("cdc_operation"),
        F.when(is_delete, F.lit(cfg.delete_strategy == "SOFT")).otherwise(F.lit(cfg.update_strategy == "HISTORY")).alias("is_kept"),
    )


def opened_rows(
    src: DataFrame,
    changes: DataFrame,
    target: T.StructType,
    cfg: EntityConfig,
    run_ts,
    update_stamps: DataFrame | None = None,
    keys_fit: bool = False,
    all_new: bool = False,
    blocked_fit: bool = False,
    kept: DataFrame | None = None,
) -> DataFrame:
    """The rows that a run opens, in the columns of the target; only these are hashed.

    ``changes`` holds the keys that are not unchanged. ``keys_fit`` says that those to insert or
    update were measured and may be broadcast. ``all_new`` says that no valid key of the snapshot is
    known yet; then every row opens but those of repeated keys, which ``blocked_fit`` lets broadcast.
    ``kept``, if given, has the active rows whose other columns an overwrite keeps.
    """
    pk = cfg.primary_key_column
    business, columns = business_columns(src, pk), src.columns
    if all_new:
        blocked = changes.where(F.col("cdc_class") == BLOCKED).select(F.col(pk).alias("_key"))
        side = F.broadcast(blocked) if blocked_fit else blocked
        found = src.where(valid_key(pk)).join(side, F.col(pk) == F.col("_key"), "left_anti")
        found = found.select("*", F.lit(INSERT).alias("_class"), F.lit(None).cast("timestamp_ntz").alias("_old_end"), ts_literal(run_ts).alias("_ts"))
    else:
        wanted = _stamped(changes.where(F.col("cdc_class").isin(INSERT, UPDATE)), pk, run_ts, update_stamps)
        keys = wanted.select(F.col(pk).alias("_key"), F.col("cdc_class").alias("_class"), F.col("old_end_ts").alias("_old_end"), "_ts")
        if keys_fit:
            keys = F.broadcast(keys)
        else:
            # Rows of a repeated key are not wanted: a heavy one need not travel at all.
            heavy = changes.where((F.col("cdc_class") == BLOCKED) & (F.col("n_rows") > ROWS_PER_TASK)).select(F.col(pk).alias("_heavy"))
            src = src.join(F.broadcast(heavy), F.col(pk) == F.col("_heavy"), "left_anti")
        found = src.join(keys, F.col(pk) == F.col("_key"))
    fresh = with_row_hash(found, cfg.hash_nulls, columns=columns)
    is_update, overwrite = F.col("_class") == UPDATE, cfg.update_strategy == "OVERWRITE"
    old = None
    if kept is not None:
        others = [f.name for f in target if f.name not in (pk, *business, *CONTROL_COLUMNS)]
        fresh = fresh.join(kept.select(F.col(pk).alias("_kept_key"), F.struct(*others).alias("_kept")), F.col(pk) == F.col("_kept_key"), "left")
        old = lambda name: F.col("_kept").getField(name)
    version = new_version(
        target,
        [pk, *business],
        F.col,
        F.col("_ts"),
        F.when(is_update, "U").otherwise("I"),
        cfg.length_limits,
        end_ts=F.when(is_update, F.col("_old_end")) if overwrite else None,
        kept=old,
    )
    return fresh.select(*version)


def rows_before(slice_: DataFrame, changes: DataFrame, cfg: EntityConfig, columns: list[str], keys_fit: bool) -> DataFrame:
    """The active rows that end, as they are, with ``is_deleted``: what a reader of the feed gets to see of them."""
    pk = cfg.primary_key_column
    keys = changes.where(F.col("cdc_class").isin(UPDATE, DELETE)).select(F.col(pk).alias("_key"), (F.col("cdc_class") == DELETE).alias("is_deleted"))
    return slice_.join(F.broadcast(keys) if keys_fit else keys, F.col(pk) == F.col("_key")).select(*columns, "is_deleted")


def run_entity(
    spark: SparkSession,
    store: VersionStore,
    cfg: EntityConfig,
    src: DataFrame,
    run_id: int,
    clock: Clock = utc_now,
    limits: Limits = Limits(),
    schema: T.StructType | None = None,
    snapshot_id: int | None = None,
    maintain: bool = True,
    rejected: DataFrame | None = None,
    gate: Gate | None = None,
    lease: Lease | None = None,
) -> dict[str, int]:
    """Run one entity and commit it. Raises, and publishes nothing, if it fails.

    ``src`` is the full snapshot; it is read more than once. If the rows that were published are not
    as many as the keys that were found to change, it was exchanged meanwhile, and the run fails.
    ``schema`` declares the target before its first commit; its ``varchar(n)`` columns set lengths.
    ``maintain`` says whether versions of like size are merged after the commit. ``rejected`` are lines
    that the snapshot has lost when it was loaded; they go to the error log, and count for ``STOP``.
    ``lease`` is that of the run: it keeps what this entity reads, and without it nothing is committed.
    """
    cfg.validate()
    entity = cfg.entity_name
    start = clock()
    location = store.location(cfg.target_table)
    base = store.latest(entity) or Commit(entity, location)
    if lease:
        lease.note(entity, base.number)
    if not cfg.allow_empty_snapshot and src.isEmpty():
        raise EntityFailure(f"snapshot of {entity} is empty")
    if schema is not None:
        cfg = replace(cfg, length_limits={**declared_limits(schema), **cfg.length_limits})
        schema = plain_schema(schema)
    known = base.columns() or schema
    if base.schema is not None:
        if base.location != location:
            raise EntityFailure(f"the target of {entity} is {base.location}, not {location}")
        if (base.encoding_version, base.hash_nulls) != (ENCODING_VERSION, cfg.hash_nulls):
            raise EntityFailure(
                f"hashes of {entity} are of encoding {base.encoding_version} with NULL columns {base.hash_nulls}, "
                f"not {ENCODING_VERSION} with {cfg.hash_nulls}: every row would count as changed; "
                "VersionStore.rehash changes the hashes and nothing else"
            )
    if known is not None:
        src = spelled_like(src, known.fieldNames())
    cfg = with_key_of(cfg, src.columns)
    pk = cfg.primary_key_column
    src = src.drop("row_hash")
    target = known or target_schema(src.schema, pk)
    absent = check_schema(src, target, pk)
    state = replace(base, schema=target.json(), primary_key=pk, location=location, hash_nulls=cfg.hash_nulls, encoding_version=ENCODING_VERSION, hashed_columns=src.columns)
    slice_ = store.active_rows(state)
    scope = Scope()
    if base.schema is not None and base.digests is not None:
        scope = find_scope(store, state, with_row_hash(src, cfg.hash_nulls))
    hashed = with_row_hash(scope.of(src, scope.source), cfg.hash_nulls)

    found_keys = classify(hashed, scope.of(slice_, scope.target), pk, *PLACE, hashes=True)
    changes = store.write_changes(entity, run_id, found_keys.where(F.col("cdc_class") != UNCHANGED))
    totals = _totals(changes, pk)
    rows = totals.rows

    found = dict.fromkeys(ERROR_COUNTERS, 0)
    if rows.get(BLOCKED) or scope.missing_keys != 0:
        repeated = changes.where((F.col("cdc_class") == BLOCKED) & (F.col("n_rows") > 1))
        if not rows.get(BLOCKED):
            repeated = no_rows(spark, changes.schema)
        errors = detect_errors(
            src,
            pk,
            run_id,
            entity,
            start,
            cfg.dup_includes_empty_key,
            keys=repeated.select(pk, "n_rows", "is_conflict"),
            keys_fit=totals.few(limits, BLOCKED),
            hash_nulls=cfg.hash_nulls,
        )
        found = error_counts(store.append_errors(run_id, entity, errors)).first().asDict()
    if rejected is not None:
        lines = store.append_errors(run_id, entity, rejected_errors(rejected, run_id, entity, start), part="rejected").count()
        if cfg.error_strategy == "STOP" and lines:
            raise EntityFailure(f"entity {entity} stops on {lines} rejected lines")
    if cfg.error_strategy == "STOP" and any(found.values()):
        raise EntityFailure(f"entity {entity} stops on errors: {json.dumps(found)}")

    inserted, updated, deleted = (rows.get(c, 0) for c in (INSERT, UPDATE, DELETE))
    stamps = None
    if updated and cfg.distinct_update_ts and cfg.update_strategy == "HISTORY":
        stamps = update_ts(changes.where(F.col("cdc_class") == UPDATE), pk, start, tie_break=True)
    unchanged = base.active_rows - updated - deleted - totals.blocked_in_target
    opened, ended, sizes, before = [], [], {}, None
    if inserted or updated:
        version, written = store.write(
            location,
            "opened",
            opened_rows(
                src,
                changes,
                target,
                cfg,
                start,
                stamps,
                keys_fit=totals.few(limits, INSERT, UPDATE),
                all_new=not updated and not unchanged,
                blocked_fit=totals.few(limits, BLOCKED),
                kept=slice_ if absent and updated and cfg.update_strategy == "OVERWRITE" else None,
            ),
        )
        if written != inserted + updated:
            raise EntityFailure(f"snapshot of {entity} changed during the run: {inserted + updated} rows to write, {written} found")
        opened.append(version)
        sizes[version] = written
    if updated or deleted:
        version, written = store.write(location, "ended", ended_keys(changes, cfg, start, stamps))
        if written != updated + deleted:
            raise EntityFailure(f"{updated + deleted} versions of {entity} were to end, {written} were written")
        ended.append(version)
        sizes[version] = written
        if cfg.before_images:
            old = rows_before(slice_, changes, cfg, target.fieldNames(), totals.few(limits, UPDATE, DELETE))
            before, written = store.write(location, "before", old)
            if written != updated + deleted:
                raise EntityFailure(f"{updated + deleted} rows of {entity} were to end, {written} were found")
    summed = {"digests": base.digests, "digest_sums": base.digest_sums}
    if base.schema is None:
        summed = {"digests": [], "digest_sums": {}}
    if summed["digests"] is not None and (inserted or updated or deleted):
        summed = store.add_digests(location, digests.changed_sums(changes, pk, target[pk].dataType), **summed)

    counters = {
        "rows_inserted": inserted,
        "rows_updated": updated,
        "rows_deleted": deleted,
        "rows_unchanged": unchanged,
        **found,
    }
    after = state.following(
        kind=RUN,
        opened=state.opened + opened,
        ended=state.ended + ended,
        active_rows=base.active_rows + inserted - deleted,
        run_id=run_id,
        snapshot_id=snapshot_id,
        start_ts=str(start),
        end_ts=str(clock()),
        counters=counters,
        before=before,
        **summed,
    )
    gate = gate or Gate()
    with gate.lock:
        if gate.stopped:
            raise RunStopped(f"the run of {entity} was stopped")
        if lease:
            lease.check()
        store.commit(after.counted(sizes, totals.ended))
    log.info("entity %s run %s: %s", entity, run_id, counters)
    if maintain and (opened or ended):
        try:
            store.maintain(entity)
        except CommitConflict as other:  # what was merged is not listed anywhere; the next run merges again
            log.info("versions of %s were not merged: %s", entity, other)
    return counters


def claim_run_id(store: VersionStore) -> int:
    """Take the next free run id. Two concurrent runs cannot take the same one."""
    run_id = max(store.claimed_runs(), default=0) + 1
    while not store.claim_run(run_id):
        run_id += 1
    return run_id


def process(
    spark: SparkSession,
    store: VersionStore,
    configs: list[EntityConfig],
    config_id: int,
    run_id: int,
    source: Source = read_staging,
    clock: Clock = utc_now,
    limits: Limits = Limits(),
    schemas: dict[str, T.StructType] | None = None,
    snapshot_id: int | None = None,
    gate: Gate | None = None,
    stop: bool = False,
    lease: Lease | None = None,
) -> str | None:
    """Run the entity of one configuration id as part of a run.

    Returns None, or a message if it failed. Then the run is FAILED, the failure is in the error log,
    and errors that were found in the data stay logged. ``stop`` says that a failure stops the other
    entities behind the same ``gate``; an entity that was stopped leaves no failure of its own.
    """
    gate = gate or Gate()
    name = f"config {config_id}"
    try:
        cfg = find_config(configs, config_id)
        name = cfg.entity_name
        src = source(spark, cfg.source_table)
        rows, rejected = (src.rows, src.rejected) if isinstance(src, Staged) else (src, None)
        run_entity(spark, store, cfg, rows, run_id, clock, limits, (schemas or {}).get(name), snapshot_id, rejected=rejected, gate=gate, lease=lease)
        return None
    except Exception as failure:  # any failure of an entity ends up in the log
        with gate.lock:
            if gate.stopped:
                log.info("entity %s was stopped", name)
                return None
            gate.stopped = stop
        if gate.tag:  # what follows belongs to the log
            spark.sparkContext.removeJobTag(gate.tag)
        log.warning("entity %s failed: %s", name, failure)
        message = json.dumps({"message": str(failure), "config_id": config_id})
        error_id = f"{run_id}-{config_id}-{RUNTIME_ERROR}"
        row = one_row(spark, ERROR_SCHEMA, (error_id, run_id, name, RUNTIME_ERROR, message, clock()))
        store.append_errors(run_id, name, row, part="runtime")
        with gate.lock:
            store.append_event(run_id, 1, FAILED, clock())
        return str(failure)


def run(
    spark: SparkSession,
    store: VersionStore,
    configs: DataFrame | list[EntityConfig],
    source: Source = read_staging,
    on_entity_failure: str = "stop",
    on_no_config: str = "completed",
    clock: Clock = utc_now,
    limits: Limits = Limits(),
    schemas: dict[str, T.StructType] | None = None,
    snapshot_id: int | None = None,
    at_once: int = 1,
    lease_seconds: float = LEASE_SECONDS,
) -> RunResult:
    """Run all active entities in order of their configuration id, up to ``at_once`` at the same time.

    ``on_entity_failure="stop"`` ends the run at the first failure, ``"continue"`` tries the other
    entities; the run is FAILED either way. Entities that were committed before stay committed. Of
    entities that run at the same time, a failure that stops the run cancels the Spark jobs of the
    others, by the tag of the run, and none of them commits any more. Each entity has a scheduler pool of its
    own name; pools share executors evenly if the session's scheduler mode is FAIR.

    The run holds a lease. Runs whose driver has not touched theirs for ``lease_seconds`` (as they were
    given to it) are FAILED first; see :func:`recover`.
    """
    if on_entity_failure not in ("stop", "continue"):
        raise ValueError("on_entity_failure must be 'stop' or 'continue'")
    if on_no_config not in ("completed", "failed"):
        raise ValueError("on_no_config must be 'completed' or 'failed'")
    if isinstance(configs, DataFrame):
        configs = load_configs(configs)
    chosen = sorted((c for c in configs if c.is_active), key=lambda c: c.config_id)
    recover(store, clock)
    run_id = claim_run_id(store)
    with Lease(spark, store.leases_path(), run_id, lease_seconds) as lease:
        return _run_all(spark, store, chosen, run_id, source, on_entity_failure, on_no_config, clock, limits, schemas, snapshot_id, at_once, lease)


def recover(store: VersionStore, clock: Clock = utc_now) -> list[int]:
    """End the runs whose driver is gone: they are FAILED and can commit nothing more. What they have
    committed stays, what they have left is removed by the next ``vacuum``. Returns their ids."""
    return take_over(store.spark, store.leases_path(), lambda run_id: store.append_event(run_id, 1, FAILED, clock()))


def _run_all(
    spark: SparkSession,
    store: VersionStore,
    chosen: list[EntityConfig],
    run_id: int,
    source: Source,
    on_entity_failure: str,
    on_no_config: str,
    clock: Clock,
    limits: Limits,
    schemas: dict[str, T.StructType] | None,
    snapshot_id: int | None,
    at_once: int,
    lease: Lease,
) -> RunResult:
    store.append_event(run_id, 0, RUNNING, clock())
    stop, context, tag = on_entity_failure == "stop", spark.sparkContext, f"cdc-run-{run_id}"
    several = at_once > 1 and len(chosen) > 1
    gate = Gate(tag=tag if several else None)

    def one(cfg: EntityConfig) -> str | None:
        if gate.stopped:
            return None
        return process(spark, store, chosen, cfg.config_id, run_id, source, clock, limits, schemas, snapshot_id, gate, stop, lease)

    def tagged(cfg: EntityConfig) -> str | None:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", cfg.entity_name)
        try:
            return one(cfg)
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    if several:
        with ThreadPoolExecutor(min(at_once, len(chosen))) as pool:
            running = [pool.submit(inheritable_thread_target(spark)(tagged), cfg) for cfg in chosen]
            while wait(running, timeout=0.5).not_done:
                if gate.stopped:  # also the jobs that an entity started after the run was stopped
                    context.cancelJobsWithTag(tag)
            messages = [r.result() for r in running]
    else:
        messages = [one(cfg) for cfg in chosen]
    failures = {cfg.entity_name: message for cfg, message in zip(chosen, messages) if message is not None}
    failed = bool(failures) or (not chosen and on_no_config == "failed")
    status = FAILED if failed else COMPLETED
    store.append_event(run_id, 2, status, clock())
    return RunResult(run_id, status, failures)


def stored_run_log(store: VersionStore) -> DataFrame:
    return run_log(store.run_events(), store.entity_log())


__all__ = ["ConfigError", "EntityFailure", "Limits", "RunResult", "process", "recover", "run", "run_entity", "stored_run_log"]
