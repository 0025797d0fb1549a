"""Data-quality errors of a snapshot: repeated rows, conflicting rows, missing keys.

The classes overlap on purpose: in ``{A, A, B}`` of one key both ``A`` are duplicate inserts and
all three rows are duplicate updates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.columns import key_text, ts_literal, valid_key
from snapledger.functions.hashing import with_row_hash
from snapledger.operators.keys import repeated_keys
from snapledger.operators.skew import count_copies, expand_copies, flag_keys, match_keys

# The error codes.
DUPLICATE_INSERT = "DUPLICATE_INSERT"
DUPLICATE_UPDATE = "DUPLICATE_UPDATE"
PRIMARY_KEY_ERROR = "PRIMARY_KEY_ERROR"
RUNTIME_ERROR = "RUNTIME_ERROR"
REJECTED_LINE = "REJECTED_LINE"

ERROR_COUNTERS = ["duplicate_inserts", "duplicate_updates", "key_errors"]

ERROR_SCHEMA = (
    "error_id string, run_id bigint, entity_name string, error_code string, "
    "error_row string, occured_at timestamp_ntz"
)


def missing_key(pk: str) -> Column:
    return F.col(pk).isNull() | (key_text(pk) == "")


def _in_duplicate_checks(pk: str, include_empty_key: bool) -> Column:
    return F.col(pk).isNotNull() if include_empty_key else valid_key(pk)


def repeated_rows(
    src: DataFrame,
    pk: str,
    include_empty_key: bool = True,
    keys: DataFrame | None = None,
    keys_fit: bool = False,
) -> DataFrame:
    """Distinct rows of all repeated keys with ``_copies`` and ``_conflict``.

    ``keys`` may hold the repeated keys if they are known already (see :func:`repeated_keys`), and
    ``keys_fit`` that they were measured and fit a broadcast.
    """
    if keys is None:
        keys = repeated_keys(src, pk, sized=True)
    sizes = [F.col("n_bytes").alias("_bytes")] if "n_bytes" in keys.columns else []
    keys = keys.where(_in_duplicate_checks(pk, include_empty_key)).select(
        pk, F.col("n_rows").alias("_rows"), F.col("is_conflict").alias("_conflict"), *sizes
    )
    matched = match_keys(src, keys, pk, weight="_rows", keys_fit=keys_fit, size="_bytes" if sizes else None)
    return count_copies(matched.drop("_rows", "_bytes"))


def duplicate_inserts(src: DataFrame, pk: str, include_empty_key: bool = True) -> DataFrame:
    """Every row that has an equal twin, with ``cnt`` = number of equal rows.

    Equal rows have equal hashes, so hashes alone are counted first; whole rows are compared, and travel,
    only where a hash occurs again.
    """
    checked = src.where(_in_duplicate_checks(pk, include_empty_key))
    again = checked.groupBy("row_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("row_hash")
    likely = flag_keys(checked, again, "row_hash", "_again").where("_again").select(*[F.col(f"`{c}`") for c in src.columns])
    groups = count_copies(likely).where(F.col("_copies") > 1)
    rows = groups.withColumn("cnt", F.col("_copies"))
    return expand_copies(rows).select(*src.columns, "cnt")


def duplicate_updates(src: DataFrame, pk: str, include_empty_key: bool = True) -> DataFrame:
    """Every row whose key also occurs with other contents."""
    keys = (
        repeated_keys(src, pk, sized=True)
        .where(F.col("is_conflict") & _in_duplicate_checks(pk, include_empty_key))
        .select(pk, F.col("n_rows").alias("_rows"), F.col("n_bytes").alias("_bytes"))
    )
    return match_keys(src, keys, pk, weight="_rows", size="_bytes").select(*src.columns)


def key_errors(src: DataFrame, pk: str) -> DataFrame:
    """Rows whose key is NULL or ``''``."""
    return src.where(missing_key(pk))


def error_row(df: DataFrame, *extra: str) -> Column:
    """The whole row as a JSON object, NULL fields left out."""
    return F.to_json(F.struct(*df.columns, *extra))


def length_violations(src: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a value longer than the target holds."""
    too_long = F.lit(False)
    for name, limit in limits.items():
        too_long = too_long | F.coalesce(F.char_length(name) > limit, F.lit(False))
    return src.where(too_long)


def detect_errors(
    src: DataFrame,
    pk: str,
    run_id: int,
    entity_name: str,
    ts,
    include_empty_key: bool = True,
    keys: DataFrame | None = None,
    keys_fit: bool = False,
    hash_nulls: str | None = None,
) -> DataFrame:
    """All error rows of a snapshot (``src`` carries ``row_hash``) in the form of the error log.

    With ``hash_nulls`` the snapshot comes without hashes and ``keys`` are known: then only rows that
    are errors are hashed. The JSON is built once per distinct row and only then written once per copy. ``error_id`` is a
    hash of the run, the row and the number of the copy, so a retry yields the same ids.
    """
    repeated = repeated_rows(src, pk, include_empty_key, keys, keys_fit)
    lacking = count_copies(key_errors(src, pk))
    columns = src.columns
    if hash_nulls is not None:
        repeated, lacking = (with_row_hash(rows, hash_nulls, columns) for rows in (repeated, lacking))
        columns = [*columns, "row_hash"]
    plain = F.to_json(F.struct(*columns))
    counted = F.to_json(F.struct(*columns, F.col("_copies").alias("cnt")))
    logged = F.array_compact(
        F.array(
            F.when(
                F.col("_copies") > 1,
                F.struct(F.lit(DUPLICATE_INSERT).alias("code"), counted.alias("row")),
            ),
            F.when(
                F.col("_conflict"),
                F.struct(F.lit(DUPLICATE_UPDATE).alias("code"), plain.alias("row")),
            ),
        )
    )
    duplicates = repeated.select("_copies", F.explode(logged).alias("_e")).select(
        F.col("_e.code").alias("error_code"), F.col("_e.row").alias("error_row"), "_copies"
    )
    missing = lacking.select(
        F.lit(PRIMARY_KEY_ERROR).alias("error_code"), plain.alias("error_row"), "_copies"
    )
    rows = expand_copies(duplicates.unionByName(missing))
    identity = F.concat_ws(
        "|",
        F.lit(str(run_id)),
        F.lit(entity_name),
        F.col("error_code"),
        F.col("_ordinal").cast("string"),
        F.col("error_row"),
    )
    return rows.select(
        F.sha2(identity, 256).alias("error_id"),
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(entity_name).alias("entity_name"),
        "error_code",
        "error_row",
        ts_literal(ts).alias("occured_at"),
    )


def rejected_errors(rejected: DataFrame, run_id: int, entity_name: str, ts) -> DataFrame:
    """Quarantined lines (``file``, ``line``, ``columns``) in the form of the error log. Equal lines of a file
    are numbered, so that each has an id of its own and a retry yields the same ids."""
    rows = expand_copies(count_copies(rejected.select("file", "line", "columns")))
    identity = F.to_json(F.struct(F.lit(run_id), F.lit(entity_name), "file", "line", "_ordinal"))
    return rows.select(
        F.sha2(identity, 256).alias("error_id"),
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(entity_name).alias("entity_name"),
        F.lit(REJECTED_LINE).alias("error_code"),
        F.to_json(F.struct("file", "line", "columns")).alias("error_row"),
        ts_literal(ts).alias("occured_at"),
    )


def count_errors(src: DataFrame, pk: str, include_empty_key: bool = True) -> DataFrame:
    """The three counters of a snapshot, added up from copies: no error row is written out."""
    repeated = repeated_rows(src.select(pk, "row_hash"), pk, include_empty_key)
    copies = F.col("_copies")
    duplicates = repeated.agg(
        F.coalesce(F.sum(F.when(copies > 1, copies)), F.lit(0)).cast("long").alias("duplicate_inserts"),
        F.coalesce(F.sum(F.when(F.col("_conflict"), copies)), F.lit(0)).cast("long").alias("duplicate_updates"),
    )
    missing = key_errors(src, pk).agg(F.count(F.lit(1)).alias("key_errors"))
    both = duplicates.unionByName(missing, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def error_counts(errors: DataFrame, *by: str) -> DataFrame:
    """Number of error rows per code as the three counters of the entity log."""
    def counter(code: str) -> Column:
        return F.coalesce(F.count_if(F.col("error_code") == code), F.lit(0)).cast("long")

    return errors.groupBy(*by).agg(
        counter(DUPLICATE_INSERT).alias("duplicate_inserts"),
        counter(DUPLICATE_UPDATE).alias("duplicate_updates"),
        counter(PRIMARY_KEY_ERROR).alias("key_errors"),
    )
