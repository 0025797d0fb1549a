"""Composed apply: the next state of a target, as frames.

Keys are told apart with narrow columns first, and those that change are written and measured. Few of
them are broadcast: then neither the snapshot nor the active slice is exchanged as whole rows. With
more of them each snapshot key is folded to one row, joined once with the active slice and turned into
the zero to two target rows its class asks for, with one exchange per side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.config import EntityConfig, with_key_of
from snapledger.functions.columns import (
    CONTROL_COLUMNS,
    business_columns,
    spelled_like,
    target_schema,
    ts_literal,
)
from snapledger.functions.hashing import with_row_hash
from snapledger.operators import skew
from snapledger.operators.changes import (
    BLOCKED,
    DELETE,
    INSERT,
    UNCHANGED,
    UPDATE,
    change_class,
    classify,
    update_ts,
)
from snapledger.operators.keys import active, unique_rows
from snapledger.operators.quality import count_errors, detect_errors
from snapledger.session import new_dir
from snapledger.sources.rows import no_rows

# Key bytes of changed keys that may be broadcast once they are counted.
CHANGED_KEY_BYTES = 64 * 1024 * 1024


class SchemaMismatch(ValueError):
    """The snapshot has a column the target lacks."""


def check_schema(src: DataFrame, target: T.StructType, pk: str) -> list[str]:
    """Business columns of the target that the snapshot lacks; they stay NULL in new versions."""
    new = business_columns(src, pk)
    unknown = [c for c in [pk, *new] if c not in target.fieldNames()]
    if unknown:
        raise SchemaMismatch(f"columns missing in the target: {', '.join(unknown)}")
    known = {pk, *new, *CONTROL_COLUMNS}
    return [c for c in target.fieldNames() if c not in known]


def fit(value: Column, field: T.StructField, limit: int | None) -> Column:
    """Value as the target column takes it; a text that is too long fails the write."""
    value = value.cast(field.dataType)
    if limit is not None:
        message = F.concat(
            F.lit(f"value of {field.name} is longer than {limit} characters: "), value.cast("string")
        )
        value = F.when(F.char_length(value) > limit, F.raise_error(message)).otherwise(value)
    return value.alias(field.name)


def new_version(
    target: T.StructType,
    source_fields: list[str],
    value,
    start_ts: Column,
    operation: str | Column,
    limits: dict[str, int],
    end_ts: Column | None = None,
    kept=None,
) -> list[Column]:
    """Columns of a version that starts now. ``value(name)`` reads the snapshot; ``kept(name)``,
    if given, reads the version that is overwritten."""
    control = {
        "row_hash": value("row_hash"),
        "start_ts": start_ts,
        "end_ts": F.lit(None) if end_ts is None else end_ts,
        "is_active": F.lit(True),
        "cdc_operation": operation if isinstance(operation, Column) else F.lit(operation),
    }
    columns = []
    for f in target:
        if f.name in control:
            columns.append(control[f.name].cast(f.dataType).alias(f.name))
        elif f.name in source_fields:
            columns.append(fit(value(f.name), f, limits.get(f.name)))
        elif kept is not None:
            columns.append(kept(f.name).cast(f.dataType).alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return columns


def closed_version(
    target: T.StructType, value, end_ts: Column, operation: str | None = None
) -> list[Column]:
    """Columns of an old version that ends now; its operation changes only if one is given."""
    control = {"end_ts": end_ts, "is_active": F.lit(False)}
    if operation is not None:
        control["cdc_operation"] = F.lit(operation)
    return [
        (control[f.name] if f.name in control else value(f.name)).cast(f.dataType).alias(f.name)
        for f in target
    ]


def next_rows(
    src: DataFrame,
    slice_: DataFrame,
    cfg: EntityConfig,
    run_ts,
    update_stamps: DataFrame | None = None,
) -> DataFrame:
    """All rows that follow from the active slice and a hashed snapshot, closed ones included.

    ``update_stamps`` (key, ``update_ts``) gives updates a time of their own.
    """
    pk = cfg.primary_key_column
    target = slice_.schema
    check_schema(src, target, pk)
    business = business_columns(src, pk)
    ts = ts_literal(run_ts)
    updated_at = ts

    new = (
        src.where(F.col(pk).isNotNull())
        .groupBy(pk)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.first(F.struct("row_hash", *business)).alias("_s"),
        )
    )
    carried = [f.name for f in target if f.name != pk]
    old = slice_.select(pk, F.struct(*carried).alias("_t"))
    joined = new.join(old, pk, "full_outer").withColumn(
        "_class",
        change_class(
            pk, F.col("_n"), F.col("_t").isNotNull(), F.col("_s.row_hash"), F.col("_t.row_hash")
        ),
    )

    if update_stamps is not None:
        joined = joined.join(update_stamps.select(pk, F.col("update_ts").alias("_ts")), pk, "left")
        updated_at = F.col("_ts")

    def from_new(name: str) -> Column:
        return F.col(pk) if name == pk else F.col(f"_s.{name}")

    def from_old(name: str) -> Column:
        return F.col(pk) if name == pk else F.col(f"_t.{name}")

    def opened(operation: str, start_ts: Column, **over) -> Column:
        return F.struct(
            *new_version(target, [pk, *business], from_new, start_ts, operation, cfg.length_limits, **over)
        )

    kept = F.struct(*[from_old(f.name).cast(f.dataType).alias(f.name) for f in target])
    if cfg.update_strategy == "HISTORY":
        updated = F.array(
            F.struct(*closed_version(target, from_old, updated_at)), opened("U", updated_at)
        )
    else:
        updated = F.array(opened("U", updated_at, end_ts=F.col("_t.end_ts"), kept=from_old))
    rows = F.when(F.col("_class") == INSERT, F.array(opened("I", ts))).when(
        F.col("_class") == UPDATE, updated
    )
    if cfg.delete_strategy == "SOFT":
        rows = rows.when(
            F.col("_class") == DELETE,
            F.array(F.struct(*closed_version(target, from_old, ts, "D"))),
        )
    rows = rows.when(F.col("_class").isin(UNCHANGED, BLOCKED) & F.col("_t").isNotNull(), F.array(kept))
    return joined.select(F.explode(rows).alias("_row")).select("_row.*")


def changed_keys(src: DataFrame, slice_: DataFrame, pk: str) -> DataFrame:
    """Keys to insert, update or delete: ``_key``, ``_class`` and the hash of the active row, ``_hash``."""
    moved = classify(src, slice_, pk, hashes=True).where(F.col("cdc_class").isin(INSERT, UPDATE, DELETE))
    return moved.select(F.col(pk).alias("_key"), F.col("cdc_class").alias("_class"), F.col("old_hash").alias("_hash"))


def may_broadcast(changed: DataFrame) -> bool:
    """Whether the written keys of :func:`changed_keys` are few, by rows and bytes, and each occurs once."""
    size = F.coalesce(F.sum(F.octet_length(F.col("_key").cast("string")) + 64), F.lit(0))
    total = changed.agg(F.count(F.lit(1)).alias("n"), size.alias("size")).first()
    if total.n > skew.LISTED_KEYS or total.size > CHANGED_KEY_BYTES:
        return False
    return changed.select("_key").distinct().count() == total.n


def next_rows_of_few(
    src: DataFrame,
    slice_: DataFrame,
    changed: DataFrame,
    cfg: EntityConfig,
    run_ts,
    update_stamps: DataFrame | None = None,
) -> DataFrame:
    """The rows of :func:`next_rows`, with the keys of ``changed`` broadcast; see :func:`may_broadcast`.

    Rows of the snapshot and of the slice stay where they are. Only where updates overwrite, the old
    and new rows of updated keys meet by a join of these rows alone.
    """
    pk, target, ts = cfg.primary_key_column, slice_.schema, ts_literal(run_ts)
    check_schema(src, target, pk)
    sources = [pk, *business_columns(src, pk)]
    if update_stamps is None:
        changed = changed.withColumn("_ts", ts)
    else:
        stamps = update_stamps.select(F.col(pk).alias("_of"), F.col("update_ts").alias("_ts"))
        changed = changed.join(stamps, F.col("_of") == F.col("_key"), "left").drop("_of")

    def from_new(name: str) -> Column:
        return F.col(f"_s.{name}")

    def from_old(name: str) -> Column:
        return F.col(f"_t.{name}")

    def opened(operation: str | Column, start_ts: Column, **over) -> Column:
        return F.struct(*new_version(target, sources, from_new, start_ts, operation, cfg.length_limits, **over)).alias("_row")

    keeps_history = cfg.update_strategy == "HISTORY"
    fresh = [INSERT, UPDATE] if keeps_history else [INSERT]
    arrived = src.select(F.struct("row_hash", *sources).alias("_s"))
    came = F.broadcast(changed.where(F.col("_class").isin(fresh)))
    starts = F.when(F.col("_class") == UPDATE, F.col("_ts")).otherwise(ts)
    rows = arrived.join(came, F.col(f"_s.{pk}") == F.col("_key")).select(opened(F.col("_class"), starts))

    held = slice_.select(F.struct(*slice_.columns).alias("_t"))
    left = F.broadcast(changed.where(F.col("_class").isin(UPDATE, DELETE)))
    # The hash names the row: a NULL key, or another active row of the key, is met by its own class only.
    same = F.col(f"_t.{pk}").eqNullSafe(F.col("_key")) & F.col("_t.row_hash").eqNullSafe(F.col("_hash"))
    old = F.when(F.col("_class").isNull(), F.struct(*[from_old(f.name).cast(f.dataType).alias(f.name) for f in target]))
    if keeps_history:
        old = old.when(F.col("_class") == UPDATE, F.struct(*closed_version(target, from_old, F.col("_ts"))))
    if cfg.delete_strategy == "SOFT":
        old = old.when(F.col("_class") == DELETE, F.struct(*closed_version(target, from_old, ts, "D")))
    rows = rows.unionByName(held.join(left, same, "left").select(old.alias("_row")).where(F.col("_row").isNotNull()))

    if not keeps_history:
        updated = F.broadcast(changed.where(F.col("_class") == UPDATE))
        before = held.join(updated, same).select("_key", "_t", "_ts")
        after = arrived.join(updated.select(F.col("_key").alias("_of")), F.col(f"_s.{pk}") == F.col("_of"))
        over = opened("U", F.col("_ts"), end_ts=F.col("_t.end_ts"), kept=from_old)
        rows = rows.unionByName(after.join(before, F.col("_of") == F.col("_key")).select(over))
    return rows.select("_row.*")


def run_metrics(changes: DataFrame, errors: DataFrame) -> DataFrame:
    """One row with the seven counters of an entity run; ``errors`` has its three error counters."""
    classes = {
        "rows_inserted": INSERT,
        "rows_updated": UPDATE,
        "rows_deleted": DELETE,
        "rows_unchanged": UNCHANGED,
    }
    counted = changes.agg(*[F.count_if(F.col("cdc_class") == c).alias(n) for n, c in classes.items()])
    both = counted.unionByName(errors, allowMissingColumns=True)
    return both.agg(*[F.max(c).cast("long").alias(c) for c in both.columns])


@dataclass(frozen=True)
class CdcResult:
    """Outcome of one comparison as lazy frames; each is planned when it is first asked for."""

    hashed: DataFrame
    previous: DataFrame
    cfg: EntityConfig
    run_ts: object
    run_id: int
    #: There was no target before.
    is_first: bool = False

    @cached_property
    def target(self) -> DataFrame:
        """The next state of the whole target, closed history included.

        Asking for it runs jobs over narrow columns: the keys that change (on a first load, those that
        are repeated) are written and counted, and update times of their own are numbered.
        """
        cfg, pk, stamps = self.cfg, self.cfg.primary_key_column, None
        if self.is_first:
            def value(name: str) -> Column:
                return F.col(f"`{name}`")

            sources = [pk, *business_columns(self.hashed, pk)]
            opened = new_version(self.previous.schema, sources, value, ts_literal(self.run_ts), "I", cfg.length_limits)
            return unique_rows(self.hashed, pk).select(*opened)
        slice_ = active(self.previous)
        path = new_dir(self.hashed.sparkSession, "changed")
        found = changed_keys(self.hashed, slice_, pk)
        found.write.parquet(path)
        changed = self.hashed.sparkSession.read.schema(found.schema).parquet(path)
        if cfg.distinct_update_ts and cfg.update_strategy == "HISTORY":
            updates = changed.where(F.col("_class") == UPDATE).select(F.col("_key").alias(pk))
            stamps = update_ts(updates, pk, self.run_ts, tie_break=True)
        if may_broadcast(changed):
            rows = next_rows_of_few(self.hashed, slice_, changed, cfg, self.run_ts, stamps)
        else:
            rows = next_rows(self.hashed, slice_, cfg, self.run_ts, stamps)
        return rows.unionByName(self.previous.where(~F.col("is_active")))

    @cached_property
    def changes(self) -> DataFrame:
        """Every key with its class."""
        pk = self.cfg.primary_key_column
        return classify(self.hashed, self.previous, pk).drop("old_end_ts")

    @cached_property
    def errors(self) -> DataFrame:
        """Error rows in the form of the error log."""
        cfg = self.cfg
        return detect_errors(
            self.hashed,
            cfg.primary_key_column,
            self.run_id,
            cfg.entity_name,
            self.run_ts,
            cfg.dup_includes_empty_key,
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """One row with the seven counters."""
        cfg = self.cfg
        return run_metrics(self.changes, count_errors(self.hashed, cfg.primary_key_column, cfg.dup_includes_empty_key))


def apply_cdc(
    src: DataFrame,
    tgt: DataFrame | None,
    cfg: EntityConfig,
    run_ts,
    run_id: int = 1,
) -> CdcResult:
    """Compare a snapshot with a target and describe the next target, lazily.

    ``tgt`` is None for a first load. Nothing is computed or written here, but the frame ``target``
    needs a job over narrow columns when it is asked for.
    """
    cfg = with_key_of(cfg.validate(), src.columns if tgt is None else tgt.columns)
    pk = cfg.primary_key_column
    if tgt is not None:
        src = spelled_like(src, tgt.columns)
    hashed = with_row_hash(src, cfg.hash_nulls)
    is_first = tgt is None
    if is_first:
        tgt = no_rows(src.sparkSession, target_schema(src.schema, pk))
    check_schema(hashed, tgt.schema, pk)
    return CdcResult(hashed, tgt, cfg, run_ts, run_id, is_first)
