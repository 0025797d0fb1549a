"""A run as the plain statement sequence on DuckDB tables: insert, update, delete."""

from __future__ import annotations

import duckdb


def literal_run(target_rows, staging_rows, update: str, delete: str) -> list[tuple]:
    """Rows ``(hash, started, ended, is_active, op, pk, v)`` of the target after the statements.

    Hashes are the values themselves. ``started`` and ``ended`` say whether a time is that of this
    run (2), an earlier one (1) or missing (None).
    """
    con = duckdb.connect()
    con.execute("CREATE TABLE t (h VARCHAR, s INT, e INT, a BOOLEAN, op VARCHAR, pk VARCHAR, v VARCHAR)")
    con.execute("CREATE TABLE src (pk VARCHAR, v VARCHAR, h VARCHAR)")
    if target_rows:
        con.executemany("INSERT INTO t VALUES (?,?,?,?,?,?,?)", target_rows)
    if staging_rows:
        con.executemany("INSERT INTO src VALUES (?,?,?)", [(k, v, f"{k}/{v}") for k, v in staging_rows])
    once = "src.pk IS NOT NULL AND src.pk <> '' AND (SELECT count(*) FROM src x WHERE x.pk = src.pk) = 1"
    con.execute(
        f"""INSERT INTO t SELECT src.h, 2, NULL, TRUE, 'I', src.pk, src.v
            FROM src LEFT JOIN t ON t.pk = src.pk AND t.a WHERE t.pk IS NULL AND {once}"""
    )
    con.execute(
        f"""CREATE TABLE changed AS SELECT src.* FROM src JOIN t ON t.pk = src.pk AND t.a
            WHERE src.h <> t.h AND {once}"""
    )
    if update == "HISTORY":
        con.execute("UPDATE t SET a = FALSE, e = 2 FROM changed c WHERE t.a AND t.pk = c.pk")
        con.execute("INSERT INTO t SELECT h, 2, NULL, TRUE, 'U', pk, v FROM changed")
    else:
        con.execute("UPDATE t SET h = c.h, s = 2, op = 'U', v = c.v FROM changed c WHERE t.a AND t.pk = c.pk")
    gone = "t.a AND NOT EXISTS (SELECT 1 FROM src WHERE src.pk = t.pk)"
    if delete == "SOFT":
        con.execute(f"UPDATE t SET a = FALSE, e = 2, op = 'D' WHERE {gone}")
    else:
        con.execute(f"DELETE FROM t WHERE {gone}")
    return con.execute("SELECT * FROM t").fetchall()
