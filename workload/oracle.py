"""DuckDB statements that state each result by plain joins, EXISTS and counts per key."""

from __future__ import annotations

from snapledger.sources.generate import DEPARTMENTS, MANAGERS
from workload.snapshots import (
    CLOSED_FROM_TS,
    CUT_OFF,
    LOADED_TS,
    OPEN_SINCE,
    LATER_TS,
    RETAINED_FROM,
    RUN_TS,
)

CONTROL = "row_hash, start_ts, end_ts, is_active, cdc_operation"
ORDER_COLUMNS = ["order_key", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLUMNS = ["customer_key", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINE_COLUMNS = ["line_key", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"]
DOCUMENT_COLUMNS = ["lang", "text"]


def row_hash(columns: list[str], nulls: str = "keep") -> str:
    parts = []
    for c in sorted(columns):
        absent = f"'{c}=N;'" if nulls == "keep" else "''"
        parts.append(
            f"coalesce('{c}=V' || length(cast({c} as varchar)) || ':' || cast({c} as varchar) || ';', {absent})"
        )
    return "sha256(" + " || ".join(parts) + ")"


# How a column is shown: the same on both sides, whatever its engine type.
SHOWN = {
    "start_ts": "cast(start_ts as varchar)",
    "end_ts": "cast(end_ts as varchar)",
    "o_orderdate": "cast(o_orderdate as varchar)",
    "o_totalprice": "cast(o_totalprice as double)",
    "c_acctbal": "cast(c_acctbal as double)",
    "l_shipdate": "cast(l_shipdate as varchar)",
    "l_quantity": "cast(l_quantity as double)",
    "l_extendedprice": "cast(l_extendedprice as double)",
    "update_ts": "cast(update_ts as varchar)",
    "occured_at": "cast(occured_at as varchar)",
}


def shown(columns: list[str], alias: str = "") -> str:
    out = []
    for c in columns:
        expr = SHOWN.get(c, c)
        if alias:
            expr = expr.replace(c, f"{alias}.{c}")
        out.append(f"{expr} AS {c}")
    return ", ".join(out)


ORDERS = f"""
book AS (
  SELECT 'O' || lpad(cast(o_orderkey as varchar), 9, '0') AS order_key, o_custkey, o_orderstatus,
         cast(o_totalprice as decimal(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders),
today AS (SELECT * FROM book WHERE o_orderdate >= timestamp '{RETAINED_FROM}'),
delivered AS (
  SELECT * FROM today
  UNION ALL SELECT * FROM today WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT * REPLACE ('Z' AS o_orderstatus) FROM today
            WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'
  UNION ALL SELECT * REPLACE (cast(NULL as varchar) AS order_key) FROM today
            WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
  UNION ALL SELECT * REPLACE ('' AS order_key) FROM today
            WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'),
before AS (
  SELECT * REPLACE (CASE WHEN o_orderdate >= timestamp '{OPEN_SINCE}' THEN 'O' ELSE o_orderstatus END AS o_orderstatus)
  FROM book WHERE o_orderdate < timestamp '{CUT_OFF}'),
older AS (
  SELECT * REPLACE ('H' AS o_orderstatus) FROM book
  WHERE o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'),
staging AS (SELECT *, {row_hash(ORDER_COLUMNS)} AS row_hash FROM delivered),
target AS (
  SELECT {row_hash(ORDER_COLUMNS)} AS row_hash, timestamp '{LOADED_TS}' AS start_ts,
         cast(NULL as timestamp) AS end_ts, true AS is_active, 'I' AS cdc_operation, * FROM before
  UNION ALL
  SELECT {row_hash(ORDER_COLUMNS)}, timestamp '{CLOSED_FROM_TS}', timestamp '{LOADED_TS}', false, 'I', * FROM older)
"""

CUSTOMERS = f"""
people AS (
  SELECT 'C' || lpad(cast(c_custkey as varchar), 9, '0') AS customer_key, c_name, c_nationkey,
         cast(c_acctbal as decimal(18,2)) AS c_acctbal, c_mktsegment
  FROM customer),
c_delivered AS (
  SELECT * FROM people WHERE c_mktsegment <> 'FURNITURE'
  UNION ALL SELECT * FROM people WHERE c_acctbal > 9000 AND c_mktsegment = 'MACHINERY'
  UNION ALL SELECT * REPLACE ('' AS customer_key) FROM people WHERE c_acctbal > 9000 AND c_mktsegment = 'HOUSEHOLD'
  UNION ALL SELECT * REPLACE (cast(NULL as varchar) AS customer_key) FROM people
            WHERE c_acctbal > 9000 AND c_mktsegment = 'BUILDING'),
c_before AS (
  SELECT * REPLACE (greatest(c_acctbal, cast(0 as decimal(18,2))) AS c_acctbal) FROM people
  WHERE c_mktsegment <> 'AUTOMOBILE'),
c_staging AS (SELECT *, {row_hash(CUSTOMER_COLUMNS)} AS row_hash FROM c_delivered),
c_target AS (
  SELECT {row_hash(CUSTOMER_COLUMNS)} AS row_hash, cast(NULL as timestamp) AS end_ts, true AS is_active, * FROM c_before)
"""

LINES = f"""
line AS (
  SELECT 'L' || lpad(cast(l_orderkey as varchar), 9, '0') || '-' || cast(l_linenumber as varchar) AS line_key,
         l_partkey, l_suppkey, cast(l_quantity as decimal(18,2)) AS l_quantity,
         cast(l_extendedprice as decimal(18,2)) AS l_extendedprice, l_linestatus, l_shipdate
  FROM lineitem),
line_staging AS (SELECT *, {row_hash(LINE_COLUMNS)} AS row_hash FROM line)
"""

DOCUMENTS = f"""
doc_staging AS (SELECT lang, text, {row_hash(DOCUMENT_COLUMNS)} AS row_hash FROM documents)
"""


def sets(staging: str, target: str, pk: str, p: str = "") -> str:
    """Key and row sets that every change statement is made of."""
    return f"""
{p}once AS (SELECT {pk} FROM {staging} WHERE {pk} <> '' GROUP BY {pk} HAVING count(*) = 1),
{p}current AS (SELECT * FROM {target} WHERE is_active),
{p}ins AS (
  SELECT s.* FROM {staging} s WHERE s.{pk} IN (SELECT {pk} FROM {p}once)
  AND NOT EXISTS (SELECT 1 FROM {p}current t WHERE t.{pk} = s.{pk})),
{p}upd AS (
  SELECT s.*, t.end_ts AS old_end_ts FROM {staging} s JOIN {p}current t ON t.{pk} = s.{pk}
  WHERE s.{pk} IN (SELECT {pk} FROM {p}once) AND s.row_hash <> t.row_hash),
{p}same AS (
  SELECT s.* FROM {staging} s JOIN {p}current t ON t.{pk} = s.{pk}
  WHERE s.{pk} IN (SELECT {pk} FROM {p}once) AND s.row_hash = t.row_hash),
{p}del AS (
  SELECT t.* FROM {p}current t WHERE NOT EXISTS (SELECT 1 FROM {staging} s WHERE s.{pk} = t.{pk})),
{p}dup_ins AS (
  SELECT s.*, g.n AS cnt FROM {staging} s
  JOIN (SELECT {pk}, row_hash, count(*) AS n FROM {staging} WHERE {pk} IS NOT NULL GROUP BY {pk}, row_hash) g
  ON g.{pk} = s.{pk} AND g.row_hash = s.row_hash WHERE g.n > 1),
{p}dup_upd AS (
  SELECT s.* FROM {staging} s WHERE s.{pk} IS NOT NULL
  AND EXISTS (SELECT 1 FROM {staging} o WHERE o.{pk} = s.{pk} AND o.row_hash <> s.row_hash)),
{p}key_err AS (SELECT * FROM {staging} WHERE {pk} IS NULL OR {pk} = '')
"""


ORDER_SETS = ORDERS + "," + sets("staging", "target", "order_key")
B = shown(ORDER_COLUMNS)
TARGET_SHOWN = shown(["row_hash", "start_ts", "end_ts", "is_active", "cdc_operation", *ORDER_COLUMNS])


def with_orders(query: str) -> str:
    return f"WITH {ORDER_SETS} {query}"


def replaced(sql: str, old: str, new: str) -> str:
    """``sql`` with ``new`` for ``old``, which it must hold."""
    if old not in sql:
        raise ValueError(f"not in the statement: {old}")
    return sql.replace(old, new)


def of_all_orders(sql: str) -> str:
    """The same statement on a delivery of the whole order book."""
    return replaced(sql, f"SELECT * FROM book WHERE o_orderdate >= timestamp '{RETAINED_FROM}'", "SELECT * FROM book")


def of_whole_book(sql: str) -> str:
    """The same statement on a delivery of the whole order book and a target that holds all its orders."""
    return replaced(of_all_orders(sql), f"FROM book WHERE o_orderdate < timestamp '{CUT_OFF}'", "FROM book")


def next_target(update: str, delete: str) -> str:
    """The target after the statements of a run: insert, update, delete."""
    business = ", ".join(ORDER_COLUMNS)
    parts = [
        f"SELECT {CONTROL}, {business} FROM target WHERE NOT is_active",
        f"SELECT row_hash, timestamp '{RUN_TS}', cast(NULL as timestamp), true, 'I', {business} FROM ins",
        f"""SELECT {CONTROL}, {business} FROM current t
            WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.order_key = t.order_key)
            AND NOT EXISTS (SELECT 1 FROM del d WHERE d.order_key = t.order_key)""",
    ]
    if update == "HISTORY":
        parts += [
            f"""SELECT row_hash, start_ts, timestamp '{RUN_TS}', false, cdc_operation, {business} FROM current t
                WHERE EXISTS (SELECT 1 FROM upd u WHERE u.order_key = t.order_key)""",
            f"SELECT row_hash, timestamp '{RUN_TS}', cast(NULL as timestamp), true, 'U', {business} FROM upd",
        ]
    else:
        parts.append(f"SELECT row_hash, timestamp '{RUN_TS}', old_end_ts, true, 'U', {business} FROM upd")
    if delete == "SOFT":
        parts.append(f"SELECT row_hash, start_ts, timestamp '{RUN_TS}', false, 'D', {business} FROM del")
    return "after_run AS (" + " UNION ALL ".join(parts) + ")"


def counters(p: str = "") -> str:
    return f"""
(SELECT count(*) FROM {p}ins) AS rows_inserted, (SELECT count(*) FROM {p}upd) AS rows_updated,
(SELECT count(*) FROM {p}del) AS rows_deleted, (SELECT count(*) FROM {p}same) AS rows_unchanged,
(SELECT count(*) FROM {p}dup_ins) AS duplicate_inserts, (SELECT count(*) FROM {p}dup_upd) AS duplicate_updates,
(SELECT count(*) FROM {p}key_err) AS key_errors"""


def first_load(table: str) -> str:
    return f"""(SELECT count(*) FROM {table}) AS rows_inserted, 0 AS rows_updated, 0 AS rows_deleted,
0 AS rows_unchanged, 0 AS duplicate_inserts, 0 AS duplicate_updates, 0 AS key_errors"""


def order_json(extra: str = "") -> str:
    """The order row as JSON text in the column order of the snapshot; only the key can be NULL."""
    return (
        "'{' || coalesce('\"order_key\":\"' || order_key || '\",', '') || '\"o_custkey\":' || o_custkey"
        " || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"o_totalprice\":' || cast(o_totalprice as varchar)"
        " || ',\"o_orderdate\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '\",\"o_orderpriority\":\"' || o_orderpriority"
        f" || '\",\"row_hash\":\"' || row_hash || '\"'{extra} || '}}'"
    )


ALL_ERRORS = """
errors AS (
  SELECT 'DUPLICATE_INSERT' AS error_code, order_key, row_hash FROM dup_ins
  UNION ALL SELECT 'DUPLICATE_UPDATE', order_key, row_hash FROM dup_upd
  UNION ALL SELECT 'PRIMARY_KEY_ERROR', order_key, row_hash FROM key_err)"""

CHANGES = """
classes AS (
  SELECT order_key, 'I' AS cdc_class FROM ins UNION ALL SELECT order_key, 'U' FROM upd
  UNION ALL SELECT order_key, 'N' FROM same UNION ALL SELECT order_key, 'D' FROM del
  UNION ALL SELECT DISTINCT order_key, 'BLOCKED' FROM staging
  WHERE order_key IS NOT NULL AND order_key NOT IN (SELECT order_key FROM once))"""

LOGS = """
order_runs AS (SELECT l_orderkey AS run_id, min(l_shipdate) AS start_ts, max(l_shipdate) AS end_ts,
  count(*) AS rows_inserted FROM lineitem GROUP BY l_orderkey),
user_runs AS (SELECT user_id AS run_id, min(ts) AS start_ts, max(ts) AS end_ts,
  count(*) AS rows_inserted FROM events GROUP BY user_id),
durations AS (
  SELECT 'orders' AS variant, *, date_diff('millisecond', start_ts, end_ts) / 1000.0 AS duration FROM order_runs
  UNION ALL
  SELECT 'users', *, date_diff('millisecond', start_ts, end_ts) / 1000.0 FROM user_runs)"""


def draw(salt: str, n: int, seed: int = 42) -> str:
    digits = f"substr(md5(cast(id as varchar) || '|{salt}|{seed}'), 1, 8)"
    return f"(cast('0x' || {digits} as bigint) % {n})"


def pick(names: list[str], salt: str) -> str:
    return f"([{', '.join(repr(n) for n in names)}])[{draw(salt, len(names))} + 1]"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources and sinks
    sql["src01_load_snapshot_csv"] = (
        replaced(f"WITH {CUSTOMERS} SELECT {shown(CUSTOMER_COLUMNS)} FROM c_delivered", "SELECT * FROM people WHERE c_mktsegment <> 'FURNITURE'", "SELECT * FROM people")
    )
    sql["src05_generate_employees"] = f"""
        WITH d AS (SELECT o_orderkey AS id FROM orders)
        SELECT 'R' || lpad(cast(id as varchar), 12, '0') AS employee_id,
          cast({draw('salary', 8000)} + 2000 as double) AS salary,
          {pick(MANAGERS, 'manager')} AS manager, {pick(DEPARTMENTS, 'department')} AS department FROM d"""
    sql["src02_read_staging"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as varchar) AS o_orderdate, o_orderpriority FROM orders"
    bad_line = "CASE WHEN o_orderstatus = 'P' THEN 'rejected:o_totalprice' WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'rejected:' END"
    sql["src01_rejected_lines"] = (
        f"WITH {ORDERS}, lines AS (SELECT order_key, o_totalprice, {bad_line} AS problem FROM book) "
        "SELECT order_key, CASE WHEN problem IS NULL THEN cast(o_totalprice as double) END AS o_totalprice, problem FROM lines"
    )
    sql["src03_stored_active"] = f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')} SELECT {TARGET_SHOWN} FROM after_run WHERE is_active"
    sql["src03_active"] = with_orders(f"SELECT {TARGET_SHOWN} FROM current")
    # the stored target starts from the cut-off snapshot, so it has no older versions
    sql["snk01_publish_versions"] = (
        f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')} SELECT {TARGET_SHOWN} FROM after_run "
        f"WHERE end_ts IS NULL OR end_ts <> timestamp '{LOADED_TS}'"
    )
    sql["snk02_append_errors"] = (
        f"WITH {ORDER_SETS}, {ALL_ERRORS} SELECT 2::bigint AS run_id, 'Order' AS entity_name, error_code, order_key, row_hash, count(*) AS n "
        "FROM errors GROUP BY ALL"
    )
    later = f"timestamp '{LATER_TS}'"
    sql["snk01_compacted"] = (
        f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')}, stored AS (SELECT * FROM after_run WHERE end_ts IS NULL OR end_ts <> timestamp '{LOADED_TS}') "
        f"SELECT {TARGET_SHOWN} FROM (SELECT * REPLACE (CASE WHEN is_active THEN {later} ELSE end_ts END AS end_ts, false AS is_active, "
        "CASE WHEN is_active THEN 'D' ELSE cdc_operation END AS cdc_operation) FROM stored)"
    )
    sql["snk01_adopted"] = f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')} SELECT {TARGET_SHOWN} FROM after_run"
    sql["snk03_reset"] = (
        f"WITH {ORDERS} SELECT (SELECT count(*) FROM book) AS rows_before, 0::bigint AS rows_after, 0::bigint AS log_rows, "
        "0::bigint AS config_rows, 0::bigint AS staging_rows"
    )
    sql["snk04_append_load"] = f"WITH {ORDERS} SELECT {B} FROM (SELECT * FROM before UNION ALL SELECT * FROM delivered)"
    in_debt = "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
    sql["snk06_patch_snapshot"] = (
        f"WITH {ORDERS} SELECT order_key, o_custkey, o_orderstatus, "
        f"cast(CASE WHEN order_key IN (SELECT order_key FROM book WHERE {in_debt}) THEN o_totalprice + 400 ELSE o_totalprice END as double) AS o_totalprice, "
        "cast(o_orderdate as varchar) AS o_orderdate, o_orderpriority FROM delivered"
    )
    sql["snk06_drop_keys"] = (
        f"WITH {ORDERS} SELECT {B} FROM delivered d WHERE NOT EXISTS "
        f"(SELECT 1 FROM book b WHERE b.order_key = d.order_key AND b.{in_debt})"
    )

    # row hash
    sql["h01_row_hash_keep"] = f"WITH {ORDERS} SELECT order_key, row_hash FROM staging"
    sql["h02_row_hash_drop"] = f"WITH {ORDERS} SELECT order_key, {row_hash(ORDER_COLUMNS, 'drop')} AS row_hash FROM delivered"
    sql["h02_rehash"] = (
        f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')} SELECT order_key, {row_hash(ORDER_COLUMNS, 'drop')} AS row_hash, "
        "cast(start_ts as varchar) AS start_ts FROM (SELECT * EXCLUDE (row_hash) FROM after_run) WHERE is_active"
    )
    mark = lambda text: f"coalesce('V' || length({text}) || ':' || {text} || ';', 'N;')"
    price, closed_price = "cast(o_totalprice as varchar)", "CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice as varchar) END"
    entry = mark("o_orderstatus") + " || " + mark("cast(o_custkey as varchar)")
    detail = (
        f"'o_orderdate=' || {mark('cast(o_orderdate as varchar)')} || 'amounts=' || {mark('amounts')} || 'named=' || {mark('named')}"
    )
    sql["h01_row_hash_nested"] = f"""
        WITH {ORDERS}, n AS (SELECT *, {mark(price)} || {mark(closed_price)} AS amounts,
          list_aggregate(list_sort([{entry}, 'V1:A;N;']), 'string_agg', '') AS named FROM book),
        d AS (SELECT *, {detail} AS detail FROM n)
        SELECT order_key, {row_hash(['order_key', 'detail'])} AS row_hash FROM d"""
    sql["h01_row_hash_documents"] = (
        f"SELECT doc_id, {row_hash(['doc_id', 'text', 'lang', 'source', 'n_chars'])} AS row_hash FROM documents"
    )
    sql["h02_row_hash_events"] = (
        "WITH e AS (SELECT event_id, ts, user_id, event_type, cast(value as decimal(18,2)) AS value, "
        "CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props FROM events) "
        f"SELECT event_id, {row_hash(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props'], 'drop')} AS row_hash FROM e"
    )

    # data quality
    sql["dq01_duplicate_inserts"] = with_orders(f"SELECT {B}, row_hash, cnt FROM dup_ins")
    sql["dq01_duplicate_inserts_no_empty_key"] = with_orders(f"SELECT {B}, row_hash, cnt FROM dup_ins WHERE order_key <> ''")
    sql["dq01_duplicate_inserts_documents"] = (
        f"WITH {DOCUMENTS} SELECT lang, row_hash, cnt FROM (SELECT *, count(*) OVER (PARTITION BY lang, row_hash) AS cnt FROM doc_staging) WHERE cnt > 1"
    )
    sql["dq02_duplicate_updates"] = with_orders(f"SELECT {B}, row_hash FROM dup_upd")
    sql["dq02_duplicate_updates_no_empty_key"] = with_orders(f"SELECT {B}, row_hash FROM dup_upd WHERE order_key <> ''")
    sql["dq02_duplicate_updates_lines"] = (
        f"WITH {LINES} SELECT line_key, row_hash FROM line_staging s WHERE EXISTS "
        "(SELECT 1 FROM line_staging o WHERE o.line_key = s.line_key AND o.row_hash <> s.row_hash)"
    )
    sql["dq02_duplicate_updates_documents"] = (
        f"WITH {DOCUMENTS} SELECT lang, row_hash FROM doc_staging WHERE lang IN "
        "(SELECT lang FROM doc_staging GROUP BY lang HAVING count(DISTINCT row_hash) > 1)"
    )
    sql["dq03_key_errors"] = with_orders(f"SELECT {B}, row_hash FROM key_err")
    sql["dq04_error_row"] = with_orders(f"SELECT {order_json()} AS error_row FROM key_err")
    sql["dq05_detect_errors"] = (
        f"WITH {ORDER_SETS}, {ALL_ERRORS} SELECT 1::bigint AS run_id, 'Order' AS entity_name, error_code, "
        f"'{RUN_TS}' AS occured_at, order_key, row_hash FROM errors"
    )
    faulty = "2::bigint AS run_id, 'Order' AS entity_name, '{}' AS error_code, order_key, o_custkey, cast(o_totalprice as double) AS o_totalprice, {} AS cnt"
    sql["dq05_error_fields"] = with_orders(
        f"SELECT {faulty.format('DUPLICATE_INSERT', 'cnt')} FROM dup_ins UNION ALL SELECT {faulty.format('DUPLICATE_UPDATE', 'NULL')} FROM dup_upd "
        f"UNION ALL SELECT {faulty.format('PRIMARY_KEY_ERROR', 'NULL')} FROM key_err"
    )
    sql["dq06_error_counts"] = with_orders(
        "SELECT (SELECT count(*) FROM dup_ins) AS duplicate_inserts, (SELECT count(*) FROM dup_upd) AS duplicate_updates, "
        "(SELECT count(*) FROM key_err) AS key_errors"
    )
    sql["dq07_length_violations"] = "SELECT doc_id, lang, source, n_chars FROM documents WHERE length(text) > 2000 OR length(source) > 8"
    sql["dq07_too_long_value"] = (
        "SELECT 2::bigint AS run_id, 'FAILED' AS status, count(*) AS target_rows, 0::bigint AS entity_log_rows, 1::bigint AS runtime_errors "
        "FROM documents"
    )
    sql["dq09_error_strategy_stop"] = (
        f"WITH {ORDERS} SELECT 2::bigint AS run_id, 'FAILED' AS status, (SELECT count(*) FROM before) AS target_rows"
    )

    # changes
    sql["c01_unique_rows"] = with_orders(f"SELECT {shown(ORDER_COLUMNS, 's')}, s.row_hash FROM staging s JOIN once o ON o.order_key = s.order_key")
    sql["c02_detect_inserts"] = with_orders(f"SELECT {B}, row_hash FROM ins")
    sql["c03_apply_inserts"] = (
        f"WITH {ORDERS}, once AS (SELECT order_key FROM staging WHERE order_key <> '' GROUP BY order_key HAVING count(*) = 1) "
        f"SELECT row_hash, '{RUN_TS}' AS start_ts, cast(NULL as varchar) AS end_ts, true AS is_active, 'I' AS cdc_operation, {B} "
        "FROM staging WHERE order_key IN (SELECT order_key FROM once)"
    )
    sql["c04_reactivated"] = with_orders(
        f"SELECT {B}, row_hash FROM ins i WHERE EXISTS (SELECT 1 FROM target t WHERE t.order_key = i.order_key)"
    )
    sql["c05_detect_updates"] = with_orders(f"SELECT {B}, row_hash FROM upd")

    def after(update: str, delete: str, where: str) -> str:
        return f"WITH {ORDER_SETS}, {next_target(update, delete)} SELECT {TARGET_SHOWN} FROM after_run WHERE {where}"

    run_ts = f"timestamp '{RUN_TS}'"
    sql["c06_history_close"] = after("HISTORY", "SOFT", f"end_ts = {run_ts} AND cdc_operation <> 'D'")
    sql["c07_history_open"] = after("HISTORY", "SOFT", f"start_ts = {run_ts} AND cdc_operation = 'U'")
    sql["c06_as_of"] = (
        f"WITH {ORDERS} SELECT order_key, o_orderstatus, '{LOADED_TS}' AS start_ts FROM before"
    )
    sql["c07_interval_errors"] = """
        WITH v AS (SELECT cast(o_custkey as varchar) AS customer, o_orderdate AS s, max(o_totalprice) AS level FROM orders GROUP BY ALL),
        i AS (SELECT *, CASE WHEN level < 250000 THEN (SELECT min(n.s) FROM v n WHERE n.customer = v.customer AND n.s > v.s) END AS e FROM v)
        SELECT b.customer, cast(b.s as varchar) AS start_ts, cast(NULL as varchar) AS previous_end, 'OVERLAP' AS error
        FROM i a JOIN i b ON a.customer = b.customer AND b.s = (SELECT min(n.s) FROM v n WHERE n.customer = a.customer AND n.s > a.s)
        WHERE a.e IS NULL"""
    sql["c07_as_of_join"] = """
        WITH v AS (SELECT o_custkey, o_orderdate AS s, max(o_totalprice) AS level FROM orders GROUP BY ALL),
        i AS (SELECT o_custkey, level, s, least(lead(s) OVER (PARTITION BY o_custkey ORDER BY s), s + interval 400 day) AS e FROM v),
        f AS (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT l_orderkey, l_linenumber, l_partkey, f.o_custkey, level
        FROM f LEFT JOIN i ON i.o_custkey = f.o_custkey AND s <= l_shipdate AND (e IS NULL OR e > l_shipdate)"""
    sql["c08_overwrite"] = after("OVERWRITE", "SOFT", f"start_ts = {run_ts} AND cdc_operation = 'U'")
    sql["c09_detect_deletes"] = with_orders(f"SELECT {TARGET_SHOWN} FROM del")
    sql["c10_soft_delete"] = after("HISTORY", "SOFT", "cdc_operation = 'D'")
    sql["c10_hard_delete"] = after("HISTORY", "HARD", "is_active")
    sql["c11_update_ts"] = with_orders(
        f"SELECT order_key, cast({run_ts} + to_microseconds(row_number() OVER (ORDER BY order_key) - 1) as varchar) AS update_ts FROM upd"
    )
    sql["c12_frozen"] = with_orders(
        f"SELECT {TARGET_SHOWN} FROM current t WHERE (SELECT count(*) FROM staging s WHERE s.order_key = t.order_key) > 1"
    )
    sql["c13_detect_unchanged"] = with_orders(f"SELECT {B}, row_hash FROM same")
    for update in ("HISTORY", "OVERWRITE"):
        for delete in ("SOFT", "HARD"):
            sql[f"c14_apply_{update.lower()}_{delete.lower()}"] = after(update, delete, "true")
    sql["c14_changes"] = f"WITH {ORDER_SETS}, {CHANGES} SELECT order_key, cdc_class FROM classes"
    sql["c14_metrics"] = with_orders(f"SELECT {counters()}")
    sql["c16_empty_snapshot"] = with_orders(
        f"SELECT row_hash, cast(start_ts as varchar) AS start_ts, CASE WHEN is_active THEN '{RUN_TS}' ELSE cast(end_ts as varchar) END AS end_ts, "
        f"false AS is_active, CASE WHEN is_active THEN 'D' ELSE cdc_operation END AS cdc_operation, {B} FROM target"
    )

    # logs
    sql["l01_next_run_id"] = "SELECT coalesce(max(o_orderkey), 0) + 1 AS next_run_id FROM orders"
    sql["l02_run_status"] = """
        WITH e AS (SELECT user_id AS run_id, event_id AS seq, ts, CASE event_type WHEN 'error' THEN 'FAILED'
          WHEN 'purchase' THEN 'COMPLETED' ELSE 'RUNNING' END AS status FROM events)
        SELECT run_id, cast(min(ts) as varchar) AS start_ts,
          cast(max(CASE WHEN status <> 'RUNNING' THEN ts END) as varchar) AS end_ts,
          (SELECT l.status FROM e l WHERE l.run_id = e.run_id ORDER BY l.seq DESC LIMIT 1) AS status
        FROM e GROUP BY run_id"""
    sql["l03_entity_log_row"] = with_orders(
        f"SELECT 7::bigint AS run_id, '{RUN_TS}' AS start_ts, '{RUN_TS}' AS end_ts, 'Order' AS entity_name, {counters()}"
    )
    sql["l04_rollup_run"] = """
        SELECT l_orderkey AS run_id, count(*) FILTER (l_linestatus = 'O') AS rows_inserted,
          count(*) FILTER (l_linestatus = 'F') AS rows_updated, count(*) FILTER (l_discount > 0.05) AS rows_deleted,
          count(*) FILTER (l_tax > 0.04) AS rows_unchanged, count(*) FILTER (l_quantity > 40) AS duplicate_inserts,
          count(*) FILTER (l_quantity < 5) AS duplicate_updates, count(*) FILTER (l_linenumber > 5) AS key_errors
        FROM lineitem GROUP BY l_orderkey"""
    sql["l05_failed_entity"] = (
        f"WITH {ORDERS} SELECT 2::bigint AS run_id, 'FAILED' AS status, (SELECT count(*) FROM before) AS target_rows, "
        "0::bigint AS entity_log_rows, 1::bigint AS runtime_errors"
    )
    both = ORDER_SETS + "," + CUSTOMERS + "," + sets("c_staging", "c_target", "customer_key", "c_")
    sql["l07_run_two_entities"] = f"""
        WITH {both}
        SELECT 1::bigint AS run_id, 'Order' AS entity_name, {first_load('before')}
        UNION ALL SELECT 1, 'Customer', {first_load('c_before')}
        UNION ALL SELECT 2, 'Order', {counters()}
        UNION ALL SELECT 2, 'Customer', {counters('c_')}"""
    sql["l07_run_log"] = f"""
        WITH {both}, entity AS (
        SELECT 1::bigint AS run_id, {first_load('before')}
        UNION ALL SELECT 1, {first_load('c_before')}
        UNION ALL SELECT 2, {counters()}
        UNION ALL SELECT 2, {counters('c_')})
        SELECT run_id, 'COMPLETED' AS status, """ + ", ".join(
        f"cast(sum({c}) as bigint) AS {c}"
        for c in [
            "rows_inserted", "rows_updated", "rows_deleted", "rows_unchanged",
            "duplicate_inserts", "duplicate_updates", "key_errors",
        ]
    ) + " FROM entity GROUP BY run_id"

    # empty keys are left out of the duplicate checks, and no column of an order but its key is NULL
    checked = replaced(counters(), "FROM dup_ins", "FROM dup_ins WHERE order_key <> ''")
    checked = replaced(checked, "FROM dup_upd", "FROM dup_upd WHERE order_key <> ''")
    sql["l07_configured_by_rows"] = f"""
        WITH {ORDER_SETS}
        SELECT 1::bigint AS run_id, 'Order' AS entity_name, {first_load('before')}
        UNION ALL SELECT 2, 'Order', {checked}"""

    # reports
    sql["a01_run_durations"] = f"WITH {LOGS} SELECT variant, run_id, cast(start_ts as varchar) AS start_ts, cast(end_ts as varchar) AS end_ts, cast(duration as double) AS duration FROM durations"
    sql["a02_rows_per_run"] = f"WITH {LOGS} SELECT variant, run_id, cast(sum(rows_inserted) as bigint) AS total_rows_inserted FROM durations GROUP BY variant, run_id"
    sql["a03_compare_runs"] = f"""
        WITH {LOGS} SELECT run_id,
          cast(max(CASE WHEN variant = 'orders' THEN duration END) as double) AS orders_duration,
          cast(max(CASE WHEN variant = 'users' THEN duration END) as double) AS users_duration,
          round(cast(max(CASE WHEN variant = 'users' THEN duration END) as double)
            - cast(max(CASE WHEN variant = 'orders' THEN duration END) as double), 3) AS duration_difference,
          cast(sum(rows_inserted) as bigint) AS total_rows_inserted
        FROM durations GROUP BY run_id"""
    columns = ", ".join(ORDER_COLUMNS)
    minus = f"(SELECT {columns} FROM {{}} EXCEPT SELECT {columns} FROM {{}})"
    sql["a04_reconcile"] = with_orders(
        "SELECT 'STAGING' AS source, count(*) AS row_count FROM staging UNION ALL SELECT 'TARGET', count(*) FROM current "
        f"UNION ALL SELECT 'DIFFERENCES', count(*) FROM {minus.format('staging', 'current')} "
        f"UNION ALL SELECT 'DIFFERENCES_REVERSE', count(*) FROM {minus.format('current', 'staging')}"
    )
    sql["a04_reconcile_equal"] = (
        f"WITH {ORDERS} SELECT 'STAGING' AS source, count(*) AS row_count FROM book UNION ALL SELECT 'TARGET', count(*) FROM book "
        "UNION ALL SELECT 'DIFFERENCES', 0 UNION ALL SELECT 'DIFFERENCES_REVERSE', 0"
    )
    sql["a05_checks"] = with_orders(
        "SELECT 'active rows' AS test_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'active=' || count(*) AS details FROM current "
        "UNION ALL SELECT 'no missing keys', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 'key_errors=' || count(*) FROM key_err "
        "UNION ALL SELECT 'highest customer', CASE WHEN max(o_custkey) >= 0 THEN 'PASS' ELSE 'FAIL' END, 'customer=' || coalesce(max(o_custkey), 0) FROM staging"
    )
    sql["a06_latest_run"] = f"WITH {LOGS} SELECT run_id, cast(start_ts as varchar) AS start_ts, cast(end_ts as varchar) AS end_ts, rows_inserted FROM order_runs QUALIFY row_number() OVER (ORDER BY run_id DESC) = 1"
    sql["a07_count_where"] = with_orders(
        "SELECT 'active' AS what, count(*) AS total_rows FROM current UNION ALL SELECT 'closed', count(*) FROM target WHERE NOT is_active "
        "UNION ALL SELECT 'open orders', count(*) FROM current WHERE o_orderstatus = 'O'"
    )
    sql["a08_history"] = with_orders(f"SELECT {TARGET_SHOWN} FROM target")

    # change feed and stream
    sql["s01_change_feed"] = f"""
        WITH {ORDERS},
        gone AS (SELECT * FROM before b WHERE NOT EXISTS (SELECT 1 FROM book n WHERE n.order_key = b.order_key
          AND n.o_orderdate >= timestamp '{RETAINED_FROM}' AND n.o_orderstatus = b.o_orderstatus)),
        came AS (SELECT * FROM today n WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.order_key = n.order_key AND b.o_orderstatus = n.o_orderstatus))
        SELECT {B}, 'DELETE' AS action, order_key IN (SELECT order_key FROM came) AS is_update, sha256(order_key) AS row_id FROM gone
        UNION ALL
        SELECT {B}, 'INSERT', order_key IN (SELECT order_key FROM gone), sha256(order_key) FROM came"""
    sql["s01_change_feed_repeated_rows"] = f"""
        WITH {DOCUMENTS}, earlier AS (SELECT lang, text FROM documents), later AS (SELECT lang, replace(text, 'e', 'E') AS text FROM documents),
        net AS (SELECT lang, text, sum(s) AS n FROM (SELECT *, -1 AS s FROM earlier UNION ALL SELECT *, 1 FROM later) GROUP BY lang, text),
        each AS (SELECT lang, text, n, unnest(range(abs(n)::bigint)) AS i FROM net WHERE n <> 0)
        SELECT lang, md5(text) AS text_md5, CASE WHEN n > 0 THEN 'INSERT' ELSE 'DELETE' END AS action,
          (SELECT min(n) < 0 AND max(n) > 0 FROM net k WHERE k.lang = each.lang AND k.n <> 0) AS is_update, sha256(lang) AS row_id FROM each"""
    sql["s02_consume_feed"] = sql["s01_change_feed"]

    def event(rows: str, action: str, is_update: str, where: str = "true") -> str:
        return f"SELECT {B}, '{action}' AS action, {is_update} AS is_update, sha256(order_key) AS row_id FROM {rows} WHERE {where}"

    updated = "order_key IN (SELECT order_key FROM upd)"
    second = [
        event("current", "DELETE", "true", updated), event("del", "DELETE", "false"), event("ins", "INSERT", "false"), event("upd", "INSERT", "true"),
    ]
    sql["s01_commit_feed"] = with_orders(" UNION ALL ".join(second))
    sql["s01_commit_feed_looked_up"] = sql["s01_commit_feed"]
    sql["s01_commit_feed_netted"] = f"WITH {ORDER_SETS}, {next_target('HISTORY', 'SOFT')} " + event("after_run", "INSERT", "false", "is_active")
    sql["s02_consume_commits"] = with_orders(" UNION ALL ".join([event("before", "INSERT", "false"), *second]))
    for name in (
        "h01_row_hash_keep", "h02_row_hash_drop", "dq01_duplicate_inserts", "dq01_duplicate_inserts_no_empty_key", "dq02_duplicate_updates",
        "dq02_duplicate_updates_no_empty_key", "dq03_key_errors", "dq04_error_row", "dq05_detect_errors", "dq06_error_counts",
        "c01_unique_rows", "c03_apply_inserts", "snk06_patch_snapshot", "snk06_drop_keys",
    ):
        sql[name] = of_all_orders(sql[name])
    for name in ("c05_detect_updates", "c11_update_ts", "c12_frozen", "c13_detect_unchanged", "a05_checks", "a07_count_where", "snk04_append_load"):
        sql[name] = of_whole_book(sql[name])
    sql["s02_stream_cdc"] = f"""
        WITH {ORDER_SETS}
        SELECT 1::bigint AS run_id, {first_load('before')} UNION ALL SELECT 2, {counters()}"""
    return sql
