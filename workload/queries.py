"""One query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.config import CONFIG_SCHEMA, OPTIONAL_SCHEMA, EntityConfig
from snapledger.functions.columns import CONTROL_COLUMNS, ts_literal
from snapledger.functions.hashing import with_row_hash
from snapledger.operators import changes as ch
from snapledger.operators import corrections, feed, intervals, keys, quality, reports, skew
from snapledger.plans import commit_feed as commits
from snapledger.plans import run as runs
from snapledger.plans import runlog
from snapledger.plans.apply import apply_cdc
from snapledger.session import new_dir
from snapledger.sources import generate, staging
from snapledger.sources.rows import no_rows
from snapledger.sources.store import COUNTERS, VersionStore
from snapledger.streaming import manifest
from workload import snapshots as w

Query = Callable[[SparkSession, str], DataFrame]
PK = w.ORDERS_PK


def shown(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text and decimals as doubles, so that any engine shows the same values."""
    out = []
    for f in df.schema:
        if names and f.name not in names:
            continue
        kind = f.dataType.typeName()
        col = F.col(f.name)
        if kind.startswith("timestamp"):
            col = col.cast("string")
        elif kind.startswith("decimal"):
            col = col.cast("double")
        out.append(col.alias(f.name))
    return df.select(*out)


def stack(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def orders_src(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_hash(w.orders_staging(spark, sf))


def whole_src(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_hash(w.orders_delivery(spark, sf))


def documents_src(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_hash(w.documents(spark, sf))


def applied(spark: SparkSession, sf: str, update: str = "HISTORY", delete: str = "SOFT", first: bool = False):
    if first:
        return apply_cdc(w.orders_delivery(spark, sf), None, w.orders_config(update, delete), w.RUN_TS)
    return apply_cdc(w.orders_staging(spark, sf), w.orders_target(spark, sf), w.orders_config(update, delete), w.RUN_TS)


# Stored runs


def ticking(*stamps: str) -> runs.Clock:
    """A clock for tests: the given times in turn, the last one from then on."""
    times: Iterator[datetime] = iter([datetime.fromisoformat(s) for s in stamps])
    last = datetime.fromisoformat(stamps[-1])

    def now() -> datetime:
        return next(times, last)

    return now


def fixed(stamp: str) -> runs.Clock:
    return ticking(stamp)


def two_runs(
    spark: SparkSession,
    sf: str,
    configs: list[EntityConfig],
    second: list[EntityConfig] | None = None,
    broken: bool = False,
) -> VersionStore:
    """A store after a run on the snapshots at the cut-off and a run on today's snapshots."""
    store = VersionStore(spark, new_dir(spark, "store"))
    before = {"STAGING.S_Order": w.orders_before, "STAGING.S_Customer": w.customers_before}
    today = {"STAGING.S_Order": w.orders_staging, "STAGING.S_Customer": w.customers_staging}

    def source(tables) -> runs.Source:
        return lambda s, name: tables[name](s, sf)

    runs.run(spark, store, configs, source(before), clock=fixed(w.LOADED_TS))
    if broken:
        today = {k: (lambda s, d, f=f: f(s, d).withColumn("not_in_target", F.lit(1))) for k, f in today.items()}
    runs.run(spark, store, second or configs, source(today), clock=fixed(w.RUN_TS))
    return store


def publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    return shown(two_runs(spark, sf, [w.orders_config()]).read_target("Order"))


def append_errors(spark: SparkSession, sf: str) -> DataFrame:
    errors = two_runs(spark, sf, [w.orders_config()]).error_log()
    row = F.from_json("error_row", f"{PK} string, row_hash string")
    return (
        errors.withColumn("row", row)
        .groupBy("run_id", "entity_name", "error_code", F.col(f"row.{PK}").alias(PK), F.col("row.row_hash").alias("row_hash"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def error_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of the faulty rows of a second run, by path out of the stored objects."""
    objects = two_runs(spark, sf, [w.orders_config()]).error_objects()
    fields = reports.error_fields(objects, {PK: "string", "o_custkey": "bigint", "o_totalprice": "decimal(18,2)", "cnt": "bigint"})
    return shown(fields.drop("error_id", "occured_at"))


def counted(base: DataFrame, **frames: DataFrame) -> DataFrame:
    """One row: the columns of ``base`` (one row, if any) and the number of rows of each frame."""
    parts = [base] + [f.agg(F.count(F.lit(1)).alias(n)) for n, f in frames.items()]
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return one.agg(*[F.max(c).alias(c) for c in one.columns])


def reset(spark: SparkSession, sf: str) -> DataFrame:
    """Logs, target, configuration and snapshot before and after a reset."""
    root = new_dir(spark, "store")
    store = VersionStore(spark, root)
    config = [(1, "Order", f"{root}/staging", "T_Order", PK, None, None, None, True)]
    spark.createDataFrame(config, CONFIG_SCHEMA).write.parquet(f"{root}/config")
    w.orders(spark, sf).write.parquet(f"{root}/staging")
    runs.run(spark, store, spark.read.parquet(f"{root}/config"), clock=fixed(w.LOADED_TS))
    before = store.read_target("Order").agg(F.count(F.lit(1)).alias("rows_before")).checkpoint()
    store.reset("Order")
    for path in (f"{root}/config", f"{root}/staging"):
        staging.empty_table(spark, path)
    empty = no_rows(spark, "x int")
    return counted(
        before,
        rows_after=store.read_target("Order") if store.schema("Order") else empty,
        log_rows=store.entity_log(),
        config_rows=spark.read.parquet(f"{root}/config"),
        staging_rows=spark.read.parquet(f"{root}/staging"),
    )


def last_run(store: VersionStore) -> DataFrame:
    return reports.latest_run(runs.stored_run_log(store)).select("run_id", "status")


def error_strategy_stop(spark: SparkSession, sf: str) -> DataFrame:
    store = two_runs(spark, sf, [w.orders_config()], [w.orders_config(error_strategy="STOP")])
    return counted(last_run(store), target_rows=store.read_target("Order"))


def failure(store: VersionStore, entity: str) -> DataFrame:
    second = F.col("run_id") == 2
    return counted(
        last_run(store),
        target_rows=store.read_target(entity),
        entity_log_rows=store.entity_log().where(second),
        runtime_errors=store.error_log().where(second & (F.col("error_code") == quality.RUNTIME_ERROR)),
    )


def failed_entity(spark: SparkSession, sf: str) -> DataFrame:
    return failure(two_runs(spark, sf, [w.orders_config()], broken=True), "Order")


def too_long_value(spark: SparkSession, sf: str) -> DataFrame:
    """The whole documents, declared narrower for a second delivery that is one mark longer."""
    store = VersionStore(spark, new_dir(spark, "store"))
    docs = w.table(spark, sf, "documents").select("doc_id", "text", "source")
    cfg = EntityConfig(1, "Document", "STAGING.S_Document", "T_Document", "doc_id")
    longest = docs.agg(F.max(F.char_length("text"))).first()[0]
    limited = replace(cfg, length_limits={"text": longest})
    longer = docs.withColumn("text", F.concat("text", F.lit("!")))
    for snapshot, stamp in ((docs, w.LOADED_TS), (longer, w.RUN_TS)):
        runs.run(spark, store, [limited], lambda s, n, df=snapshot: df, clock=fixed(stamp))
    return failure(store, "Document")


def rehashed(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes of the active rows after two runs and a change of the treatment of NULL, and a run that finds nothing to do."""
    store = two_runs(spark, sf, [w.orders_config()])
    store.rehash("Order", "drop")
    runs.run(spark, store, [w.orders_config(hash_nulls="drop")], lambda s, n: store.read_active("Order").select(*w.orders(s, sf).columns), clock=fixed(w.LATER_TS))
    return shown(store.read_active("Order"), PK, "row_hash", "start_ts")


def compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The target after three runs and a compaction between them."""
    store = two_runs(spark, sf, [w.orders_config()])
    store.compact("Order")
    runs.run(spark, store, [w.orders_config()], lambda s, n: w.orders_staging(s, sf).limit(0), clock=fixed(w.LATER_TS))
    store.vacuum("Order", older_than=0)
    return shown(store.read_target("Order"))


def stored_active(spark: SparkSession, sf: str) -> DataFrame:
    """The active rows after two runs, read with deletion vectors."""
    return shown(two_runs(spark, sf, [w.orders_config()]).read_active("Order"))


def commit_feed_query(spark: SparkSession, sf: str, images: bool = True, after: int | None = None) -> DataFrame:
    """The feed of the second of two runs, or of both, from the commit records."""
    store = two_runs(spark, sf, [w.orders_config(before_images=images)])
    first = store.records("Order", 0)[0].number
    return shown(commits.commit_feed(store, "Order", first if after is None else after))


def consume_commits(spark: SparkSession, sf: str) -> DataFrame:
    """All that a consumer gets that reads after each run of two, and once more."""
    root = new_dir(spark, "commits")
    store = VersionStore(spark, f"{root}/store")
    for snapshot, stamp in ((w.orders_before, w.LOADED_TS), (w.orders_staging, w.RUN_TS)):
        runs.run(spark, store, [w.orders_config()], lambda s, n, f=snapshot: f(s, sf), clock=fixed(stamp))
        commits.consume_commits(store, "Order", "reader", f"{root}/sink")
    return shown(commits.consume_commits(store, "Order", "reader", f"{root}/sink"))


def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A run on a text of all orders: partly delivered ones have no price, urgent closed ones lack values."""
    root = new_dir(spark, "rejects")
    book = w.orders(spark, sf)
    short = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    whole = F.concat_ws(",", PK, "o_custkey", "o_orderstatus", price, F.col("o_orderdate").cast("string"), "o_orderpriority")
    book.select(F.when(short, F.concat_ws(",", PK, "o_custkey")).otherwise(whole).alias("value")).write.text(f"{root}/text")
    store = VersionStore(spark, f"{root}/store")
    source = lambda s, n: staging.stage_csv(s, f"{root}/text", book.schema, f"{root}/staged", header=False)
    runs.run(spark, store, [w.orders_config()], source, clock=fixed(w.RUN_TS))
    row = F.from_json("error_row", "line string, columns array<string>")
    lines = store.error_log().where(F.col("error_code") == quality.REJECTED_LINE).withColumn("row", row)
    rejected = lines.select(
        F.split("row.line", ",")[0].alias(PK),
        F.lit(None).cast("double").alias("o_totalprice"),
        F.concat(F.lit("rejected:"), F.array_join("row.columns", ",")).alias("problem"),
    )
    stored = store.read_active("Order").select(PK, F.col("o_totalprice").cast("double").alias("o_totalprice"), F.lit(None).cast("string").alias("problem"))
    return stored.unionByName(rejected)


def configured_by_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Entity log of two runs of an entity whose settings all come from a table."""
    root = new_dir(spark, "store")
    schema = T.StructType([*CONFIG_SCHEMA, *OPTIONAL_SCHEMA])
    settings = [(1, "Order", f"{root}/staging", "T_Order", PK, "HARD", "CONTINUE", "OVERWRITE", True, "drop", False, None, True, None, None)]
    spark.createDataFrame(settings, schema).write.parquet(f"{root}/config")
    store = VersionStore(spark, root)
    for snapshot, stamp in ((w.orders_before, w.LOADED_TS), (w.orders_staging, w.RUN_TS)):
        snapshot(spark, sf).write.mode("overwrite").parquet(f"{root}/staging")
        runs.run(spark, store, spark.read.parquet(f"{root}/config"), clock=fixed(stamp))
    return store.entity_log().select("run_id", "entity_name", *COUNTERS)


def adopted(spark: SparkSession, sf: str) -> DataFrame:
    """A target with history from elsewhere, adopted and run once."""
    store = VersionStore(spark, new_dir(spark, "store"))
    store.adopt("Order", "TARGET.T_Order", PK, w.orders_target(spark, sf))
    runs.run(spark, store, [w.orders_config()], lambda s, n: w.orders_staging(s, sf), clock=fixed(w.RUN_TS))
    return shown(store.read_target("Order"))


def run_two_entities(spark: SparkSession, sf: str) -> DataFrame:
    store = two_runs(spark, sf, [w.orders_config(), w.customers_config()])
    return store.entity_log().select("run_id", "entity_name", *COUNTERS)


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    store = two_runs(spark, sf, [w.orders_config(), w.customers_config()])
    return runs.stored_run_log(store).select("run_id", "status", *COUNTERS)


def stream_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots are announced one after the other and consumed; a third call finds nothing."""
    root = new_dir(spark, "stream")
    store = VersionStore(spark, f"{root}/store")
    for snapshot_id, snapshot in enumerate([w.orders_before(spark, sf), w.orders_staging(spark, sf)], start=1):
        path = f"{root}/snapshots/{snapshot_id}"
        snapshot.write.parquet(path)
        manifest.announce(spark, f"{root}/manifest", snapshot_id, "Order", path)
        manifest.stream_cdc(spark, f"{root}/manifest", w.orders_config(), store, f"{root}/checkpoint")
    manifest.stream_cdc(spark, f"{root}/manifest", w.orders_config(), store, f"{root}/checkpoint")
    return store.entity_log().select("run_id", *COUNTERS)


def load_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "csv")
    snapshot = w.customers_delivery(spark, sf)
    snapshot.write.option("header", True).csv(path)
    return shown(staging.load_snapshot_csv(spark, path, snapshot.schema))


def generate_employees(spark: SparkSession, sf: str) -> DataFrame:
    """An employee for each order."""
    return shown(generate.employees_for(w.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))))


# Queries on frames


def debtor_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of all orders of customers in debt."""
    debtors = w.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return skew.flag_keys(w.orders(spark, sf), debtors, "o_custkey", "in_debt").where("in_debt").select(PK)


def patch_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    raised = {"o_totalprice": (F.col("o_totalprice") + 400).cast("decimal(18,2)")}
    return shown(corrections.patch_snapshot(w.orders_delivery(spark, sf), PK, debtor_orders(spark, sf), raised))


def drop_keys(spark: SparkSession, sf: str) -> DataFrame:
    return shown(corrections.drop_keys(w.orders_delivery(spark, sf), PK, debtor_orders(spark, sf)))


def hash_nested(spark: SparkSession, sf: str) -> DataFrame:
    book = w.orders(spark, sf)
    amounts = F.array("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))
    named = F.create_map(F.col("o_orderstatus"), F.col("o_custkey"), F.lit("A"), F.lit(None).cast("long"))
    nested = book.select(PK, F.struct("o_orderdate", amounts.alias("amounts"), named.alias("named")).alias("detail"))
    return with_row_hash(nested).select(PK, "row_hash")


def hash_events(spark: SparkSession, sf: str) -> DataFrame:
    no_props = F.when(F.col("event_type") != "error", F.col("props"))
    events = w.table(spark, sf, "events").withColumn("value", w.money("value")).withColumn("props", no_props)
    return with_row_hash(events, nulls="drop").select("event_id", "row_hash")


def error_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.key_errors(whole_src(spark, sf), PK)
    return rows.select(quality.error_row(rows).alias("error_row"))


def detected_errors(spark: SparkSession, sf: str) -> DataFrame:
    errors = quality.detect_errors(whole_src(spark, sf), PK, 1, "Order", w.RUN_TS)
    row = F.from_json("error_row", f"{PK} string, row_hash string")
    return shown(
        errors.withColumn("row", row).select(
            "run_id", "entity_name", "error_code", "occured_at", F.col(f"row.{PK}").alias(PK), F.col("row.row_hash").alias("row_hash")
        )
    )


def error_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_errors(whole_src(spark, sf), PK)


def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    docs = w.table(spark, sf, "documents")
    return quality.length_violations(docs, {"text": 2000, "source": 8}).select("doc_id", "lang", "source", "n_chars")


def on_orders(operator: Callable[[DataFrame, DataFrame, str], DataFrame]) -> Query:
    return lambda s, d: shown(operator(orders_src(s, d), w.orders_target(s, d), PK))


def on_whole_book(operator: Callable[[DataFrame, DataFrame, str], DataFrame]) -> Query:
    return lambda s, d: shown(operator(whole_src(s, d), w.whole_target(s, d), PK))


def on_snapshot(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda s, d: shown(operator(whole_src(s, d), PK, **options))


def reactivated(spark: SparkSession, sf: str) -> DataFrame:
    target = w.orders_target(spark, sf)
    new = ch.detect_inserts(orders_src(spark, sf), target, PK)
    return shown(new.join(target.select(PK).distinct(), PK, "left_semi"))


def update_stamps(spark: SparkSession, sf: str) -> DataFrame:
    updates = ch.detect_updates(whole_src(spark, sf), w.whole_target(spark, sf), PK).select(PK)
    return shown(ch.update_ts(updates, PK, w.RUN_TS, tie_break=True))


def target_where(condition, update: str = "HISTORY", delete: str = "SOFT") -> Query:
    return lambda s, d: shown(applied(s, d, update, delete).target.where(condition()))


def full_target(update: str, delete: str) -> Query:
    return lambda s, d: shown(applied(s, d, update, delete).target)


def empty_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    nothing = w.orders_staging(spark, sf).where(F.lit(False))
    return shown(apply_cdc(nothing, w.orders_target(spark, sf), w.orders_config(), w.RUN_TS).target)


def entity_log_row(spark: SparkSession, sf: str) -> DataFrame:
    return shown(runlog.entity_log_row(applied(spark, sf).metrics, 7, "Order", w.RUN_TS, w.RUN_TS))


def run_ids(spark: SparkSession, sf: str) -> DataFrame:
    return w.table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"))


LABELS = ("orders", "users")


def on_run_logs(report: Callable[..., DataFrame]) -> Query:
    return lambda s, d: shown(report(w.order_runs(s, d), w.user_runs(s, d), LABELS))


def compare_runs(spark: SparkSession, sf: str) -> DataFrame:
    compared = reports.compare_runs(w.order_runs(spark, sf), w.user_runs(spark, sf), LABELS)
    return compared.withColumn("duration_difference", F.round("duration_difference", 3))


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = w.orders_staging(spark, sf)
    return reports.reconcile(snapshot, w.orders_target(spark, sf), snapshot.columns, both_ways=True)


def reconcile_equal(spark: SparkSession, sf: str) -> DataFrame:
    """The whole order book against a target that holds it."""
    book = w.orders(spark, sf)
    target = apply_cdc(book, None, w.orders_config(), w.RUN_TS).target
    return reports.reconcile(book, target, book.columns, both_ways=True)


def checks(spark: SparkSession, sf: str) -> DataFrame:
    src, active = whole_src(spark, sf), keys.active(w.whole_target(spark, sf))
    rows = F.count(F.lit(1))
    return stack(
        reports.check("active rows", active, rows, F.col("value") > 0, "active"),
        reports.check("no missing keys", quality.key_errors(src, PK), rows, F.col("value") == 0, "key_errors"),
        reports.check("highest customer", src, F.max("o_custkey"), F.col("value") >= 0, "customer"),
    )


def counts(spark: SparkSession, sf: str) -> DataFrame:
    target = w.whole_target(spark, sf)
    is_open = F.col("is_active") & (F.col("o_orderstatus") == "O")
    wanted = {"active": F.col("is_active"), "closed": ~F.col("is_active"), "open orders": is_open}
    return stack(*[reports.count_where(target, p).select(F.lit(n).alias("what"), "total_rows") for n, p in wanted.items()])


BETWEEN_TS = "2025-06-01 00:00:00"


def stored_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The order book as it held between two runs, after the second."""
    return shown(intervals.as_of(two_runs(spark, sf, [w.orders_config()]).read_target("Order"), BETWEEN_TS), PK, "o_orderstatus", "start_ts")


def customer_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A version of each customer per order that is larger than all before, as a level that holds until the next."""
    book = w.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("customer"), "o_orderdate", "o_totalprice")
    days = book.groupBy("customer", "o_orderdate").agg(F.max("o_totalprice").alias("level"))
    order = Window.partitionBy("customer").orderBy("o_orderdate")
    ends = F.when(F.col("level") < 250000, F.lead("o_orderdate").over(order))  # a high level is not followed: it overlaps
    return days.select(
        "customer", "level", F.col("o_orderdate").cast("timestamp_ntz").alias("start_ts"), ends.cast("timestamp_ntz").alias("end_ts"), F.lit("U").alias("cdc_operation")
    )


def interval_errors(spark: SparkSession, sf: str) -> DataFrame:
    return shown(intervals.interval_errors(customer_versions(spark, sf), "customer"))


def lines_with_level(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line with the status that its order's customer had, by a shorter history, when it was shipped."""
    book = w.table(spark, sf, "orders")
    days = book.groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("level"))
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    ends = F.least(F.lead("o_orderdate").over(order), F.col("o_orderdate") + F.expr("interval 400 days"))
    versions = days.select("o_custkey", "level", F.col("o_orderdate").cast("timestamp_ntz").alias("start_ts"), ends.cast("timestamp_ntz").alias("end_ts"))
    lines = w.table(spark, sf, "lineitem").join(book.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    facts = lines.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", F.col("l_shipdate").alias("shipped"))
    return intervals.as_of_join(facts, versions, "o_custkey", "shipped", "o_custkey", ["level"]).drop("shipped")


def today(spark: SparkSession, sf: str) -> DataFrame:
    return w.orders(spark, sf).where(F.col("o_orderdate") >= ts_literal(w.RETAINED_FROM))


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    return shown(feed.change_feed(w.orders_before(spark, sf), today(spark, sf), PK))


def consume_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The feed is published and consumed; the second call finds the offset moved and adds nothing."""
    root = new_dir(spark, "feed")
    out = feed.change_feed(w.orders_before(spark, sf), today(spark, sf), PK)
    out.write.parquet(f"{root}/feed")
    for _ in range(2):
        consumed = manifest.consume_feed(spark, f"{root}/feed", out.schema, f"{root}/sink", f"{root}/checkpoint")
    return shown(consumed)


def change_feed_repeated_rows(spark: SparkSession, sf: str) -> DataFrame:
    before = w.documents(spark, sf)
    after = before.withColumn("text", F.replace("text", F.lit("e"), F.lit("E")))
    return feed.change_feed(before, after, "lang").select(
        "lang", F.md5("text").alias("text_md5"), "action", "is_update", "row_id"
    )


def started():
    return F.col("start_ts") == ts_literal(w.RUN_TS)


def ended():
    return F.col("end_ts") == ts_literal(w.RUN_TS)


def operation(name: str):
    return F.col("cdc_operation") == name


QUERIES: dict[str, Query] = {
    "src01_load_snapshot_csv": load_csv,
    "src01_rejected_lines": rejected_lines,
    "src02_read_staging": lambda s, d: staging.read_staging(s, f"{d}/orders.parquet").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")
    ),
    "src03_active": lambda s, d: shown(keys.active(w.orders_target(s, d))),
    "src03_stored_active": stored_active,
    "src05_generate_employees": generate_employees,
    "snk01_publish_versions": publish_versions,
    "snk01_compacted": compacted,
    "snk01_adopted": adopted,
    "snk02_append_errors": append_errors,
    "snk03_reset": reset,
    "snk04_append_load": lambda s, d: shown(corrections.append_load([w.orders_once(s, d), w.orders_delivery(s, d)], PK)),
    "snk06_patch_snapshot": patch_snapshot,
    "snk06_drop_keys": drop_keys,
    "h01_row_hash_keep": lambda s, d: whole_src(s, d).select(PK, "row_hash"),
    "h02_row_hash_drop": lambda s, d: with_row_hash(w.orders_delivery(s, d), nulls="drop").select(PK, "row_hash"),
    "h02_rehash": rehashed,
    "h01_row_hash_nested": hash_nested,
    "h01_row_hash_documents": lambda s, d: with_row_hash(w.table(s, d, "documents")).select("doc_id", "row_hash"),
    "h02_row_hash_events": hash_events,
    "dq01_duplicate_inserts": on_snapshot(quality.duplicate_inserts),
    "dq01_duplicate_inserts_no_empty_key": on_snapshot(quality.duplicate_inserts, include_empty_key=False),
    "dq01_duplicate_inserts_documents": lambda s, d: quality.duplicate_inserts(documents_src(s, d), "lang").select("lang", "row_hash", "cnt"),
    "dq02_duplicate_updates": on_snapshot(quality.duplicate_updates),
    "dq02_duplicate_updates_no_empty_key": on_snapshot(quality.duplicate_updates, include_empty_key=False),
    "dq02_duplicate_updates_lines": lambda s, d: quality.duplicate_updates(with_row_hash(w.lineitems(s, d)), "line_key").select("line_key", "row_hash"),
    "dq02_duplicate_updates_documents": lambda s, d: quality.duplicate_updates(documents_src(s, d), "lang").select("lang", "row_hash"),
    "dq03_key_errors": on_snapshot(quality.key_errors),
    "dq04_error_row": error_rows,
    "dq05_detect_errors": detected_errors,
    "dq05_error_fields": error_fields,
    "dq06_error_counts": error_totals,
    "dq07_length_violations": length_violations,
    "dq07_too_long_value": too_long_value,
    "dq09_error_strategy_stop": error_strategy_stop,
    "c01_unique_rows": on_snapshot(keys.unique_rows),
    "c02_detect_inserts": on_orders(ch.detect_inserts),
    "c03_apply_inserts": lambda s, d: shown(applied(s, d, first=True).target),
    "c04_reactivated": reactivated,
    "c05_detect_updates": on_whole_book(ch.detect_updates),
    "c06_history_close": target_where(lambda: ended() & ~operation("D")),
    "c07_history_open": target_where(lambda: started() & operation("U")),
    "c06_as_of": stored_as_of,
    "c07_interval_errors": interval_errors,
    "c07_as_of_join": lines_with_level,
    "c08_overwrite": target_where(lambda: started() & operation("U"), update="OVERWRITE"),
    "c09_detect_deletes": on_orders(ch.detect_deletes),
    "c10_soft_delete": target_where(lambda: operation("D")),
    "c10_hard_delete": target_where(lambda: F.col("is_active"), delete="HARD"),
    "c11_update_ts": update_stamps,
    "c12_frozen": on_whole_book(ch.frozen_rows),
    "c13_detect_unchanged": on_whole_book(ch.detect_unchanged),
    "c14_apply_history_soft": full_target("HISTORY", "SOFT"),
    "c14_apply_history_hard": full_target("HISTORY", "HARD"),
    "c14_apply_overwrite_soft": full_target("OVERWRITE", "SOFT"),
    "c14_apply_overwrite_hard": full_target("OVERWRITE", "HARD"),
    "c14_changes": lambda s, d: applied(s, d).changes.select(PK, "cdc_class"),
    "c14_metrics": lambda s, d: applied(s, d).metrics,
    "c16_empty_snapshot": empty_snapshot,
    "l01_next_run_id": lambda s, d: runlog.next_run_id(run_ids(s, d)),
    "l02_run_status": lambda s, d: shown(runlog.run_status(w.user_run_events(s, d))),
    "l03_entity_log_row": entity_log_row,
    "l04_rollup_run": lambda s, d: runlog.rollup_run(w.order_entity_log(s, d)),
    "l05_failed_entity": failed_entity,
    "l07_run_two_entities": run_two_entities,
    "l07_run_log": run_log,
    "l07_configured_by_rows": configured_by_rows,
    "a01_run_durations": on_run_logs(reports.run_durations),
    "a02_rows_per_run": on_run_logs(reports.rows_per_run),
    "a03_compare_runs": compare_runs,
    "a04_reconcile": reconcile,
    "a04_reconcile_equal": reconcile_equal,
    "a05_checks": checks,
    "a06_latest_run": lambda s, d: shown(reports.latest_run(w.order_runs(s, d))),
    "a07_count_where": counts,
    "a08_history": lambda s, d: shown(reports.history(w.orders_target(s, d), PK)),
    "s01_change_feed": change_feed,
    "s01_change_feed_repeated_rows": change_feed_repeated_rows,
    "s01_commit_feed": commit_feed_query,
    "s01_commit_feed_looked_up": lambda s, d: commit_feed_query(s, d, images=False),
    "s01_commit_feed_netted": lambda s, d: commit_feed_query(s, d, after=0),
    "s02_consume_commits": consume_commits,
    "s02_stream_cdc": stream_cdc,
    "s02_consume_feed": consume_feed,
}

__all__ = ["CONTROL_COLUMNS", "QUERIES", "shown"]
