"""Change feed of a stored target, read from its commits.

Every run leaves the rows that it opened and the keys that it ended. The feed between two commits is
made of these alone, so it costs as much as has changed; neither state of the target is read. The
offset of a reader is the number of a commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.columns import CONTROL_COLUMNS
from snapledger.sources import fs
from snapledger.sources.rows import no_rows
from snapledger.sources.store import ADOPT, RESET, RUN, Commit, VersionStore


class FeedGap(RuntimeError):
    """Commits that the feed would need are no longer there."""


def _business(columns: T.StructType) -> list[str]:
    return [f.name for f in columns if f.name not in CONTROL_COLUMNS]


def feed_schema(columns: T.StructType) -> T.StructType:
    """Columns of the feed for a target with these columns."""
    business = [columns[n] for n in _business(columns)]
    extra = T.StructType.fromDDL("action string, is_update boolean, row_id string")
    return T.StructType([*business, *extra])


def _row_id(pk: str) -> Column:
    return F.sha2(F.col(pk).cast("string"), 256)


def _present(store: VersionStore, record: Commit, part: str, versions: list[int]) -> None:
    there = set(fs.list_names(store.spark, f"{store.root}/{record.location}/{part}"))
    lost = [v for v in versions if f"version={v}" not in there]
    if lost:
        raise FeedGap(f"commit {record.number} of {record.entity_name}: {len(lost)} versions of {part} rows were removed")


def _events(store: VersionStore, before: Commit, record: Commit, columns: T.StructType) -> DataFrame | None:
    """(key, n, sign, is_update, row) of one commit: -1 for a row that it ended, 1 for one that it opened."""
    opened = [v for v in record.opened if v not in before.opened]
    ended = [v for v in record.ended if v not in before.ended]
    pk, business = record.primary_key, [n for n in _business(columns) if n != record.primary_key]
    row = F.struct("row_hash", *[F.col(f"`{c}`") for c in business])
    parts = []

    def events(rows: DataFrame, sign: int, is_update: Column) -> DataFrame:
        n = F.lit(record.number).cast("long")
        return rows.select(F.col(pk).alias("key"), n.alias("n"), F.lit(sign).alias("sign"), is_update.alias("is_update"), row.alias("row"))

    if opened:
        _present(store, record, "opened", opened)
        is_update = F.col("cdc_operation") == "U" if record.kind == RUN else F.lit(False)
        parts.append(events(store.rows_of(record, "opened", opened), 1, is_update))
    if record.before is not None:
        _present(store, record, "before", [record.before])
        parts.append(events(store.rows_before(record), -1, ~F.col("is_deleted")))
    elif ended:
        # The run kept no rows of before: they are looked up in the versions that had opened them.
        _present(store, record, "ended", ended)
        gone = store.ended_rows(record, ended)
        # At most one row per version that the target had.
        sources = [r.opened_version for r in gone.select("opened_version").distinct().collect()]
        _present(store, record, "opened", sources)
        keys = gone.select(F.col(pk).alias("_key"), F.col("opened_version").alias("_version"), (F.col("cdc_operation") == "D").alias("_deleted"))
        rows = store.rows_of(record, "opened", sources)
        found = rows.join(keys, (F.col(pk) == F.col("_key")) & (F.col("version") == F.col("_version")))
        parts.append(events(found, -1, ~F.coalesce("_deleted", F.lit(False))))
    return reduce(DataFrame.unionByName, parts) if parts else None


def commit_feed(store: VersionStore, entity: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """What commits after number ``after``, up to ``upto`` (the last, if None), have changed in the active rows.

    The columns of the target without the control columns, and ``action`` (INSERT or DELETE),
    ``is_update`` and ``row_id``, a hash of the key. It equals :func:`snapledger.operators.feed.change_feed` of the
    active rows after both commits: several changes of a key are netted, and a row that comes back as it was is left out.
    One commit needs no exchange, several need one by key, whose rows are folded on the map side.

    A reset ends what came before; a feed from 0 begins after the last one. Raises :class:`FeedGap` if
    the feed begins before a reset or before the first record, or if files that it needs are gone.
    """
    records = store.records(entity, max(0, after - 1), upto)
    last = records[-1] if records else None
    if last is None or last.number <= after:
        known = store.schema(entity)
        if known is None:
            raise FeedGap(f"entity {entity} has no target")
        return no_rows(store.spark, feed_schema(known))
    resets = [r.number for r in records if r.kind == RESET and r.number > after]
    if resets and after:
        raise FeedGap(f"the target of {entity} was reset by commit {resets[-1]}, after {after}")
    start = resets[-1] if resets else after
    if start + 1 < records[0].number or (start and start < records[0].number):
        raise FeedGap(f"the first commit of {entity} that is left is {records[0].number}, after {start}")
    columns = last.columns()
    if columns is None:
        raise FeedGap(f"entity {entity} has no target")
    by_number = {r.number: r for r in records}
    empty = Commit(entity, last.location)
    changing = [r for r in records if r.number > start and r.kind in (RUN, ADOPT)]
    parts = [_events(store, by_number.get(r.number - 1, empty), r, columns) for r in changing]
    parts = [p for p in parts if p is not None]
    if not parts:
        return no_rows(store.spark, feed_schema(columns))
    pk = last.primary_key
    events = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        # Of a key only the row that its first event ended and the one that its last event opened count.
        place, event = F.struct("n", "sign"), F.struct("sign", "row")
        ends = events.groupBy("key").agg(F.min_by(event, place).alias("first"), F.max_by(event, place).alias("last"))
        old = F.when(F.col("first.sign") == -1, F.col("first.row"))
        new = F.when(F.col("last.sign") == 1, F.col("last.row"))
        both = ends.select("key", old.alias("old"), new.alias("new"))
        same = F.coalesce(F.col("old.row_hash") == F.col("new.row_hash"), F.lit(False))
        is_update = F.col("old").isNotNull() & F.col("new").isNotNull()
        turns = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
        events = both.where(~same).select("key", is_update.alias("is_update"), F.explode(turns).alias("t"))
        events = events.where("t.row is not null").select("key", "is_update", F.col("t.sign").alias("sign"), F.col("t.row").alias("row"))
    business = [F.col("key").alias(pk) if n == pk else F.col(f"row.`{n}`").alias(n) for n in _business(columns)]
    action = F.when(F.col("sign") == 1, "INSERT").otherwise("DELETE").alias("action")
    return events.select(*business, action, "is_update").withColumn("row_id", _row_id(pk))


def consume_commits(store: VersionStore, entity: str, consumer: str, sink: str) -> DataFrame:
    """Append what is new in the feed to a folder, once, and return all that the consumer has read.

    The offset of the consumer is the number of a commit and moves after the rows are written, in a
    folder named by it; a repeated call overwrites rows that were written without moving the offset.
    Without a new commit nothing is written. :meth:`VersionStore.vacuum` keeps what the consumer has not read.
    """
    spark = store.spark
    last = store.latest(entity)
    after = store.offsets(entity).get(consumer, 0)
    if last is not None and last.number > after:
        commit_feed(store, entity, after, last.number).write.mode("overwrite").parquet(f"{sink}/upto={last.number}")
        store.move_offset(entity, consumer, last.number)
    done = store.offsets(entity).get(consumer, 0)
    schema = feed_schema(store.schema(entity))
    batches = [n for n in fs.list_names(spark, sink) if n.startswith("upto=") and int(n.partition("=")[2]) <= done]
    if not batches:
        return no_rows(spark, schema)
    return spark.read.schema(schema).parquet(*[f"{sink}/{n}" for n in batches])
