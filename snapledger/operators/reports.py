"""Reports over run logs, targets and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.hashing import with_row_hash
from snapledger.operators import digests
from snapledger.operators.keys import active


def _millis(ts: str) -> Column:
    """Whole milliseconds since the epoch, so that a difference counts millisecond boundaries."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(ts)) / F.lit(1000).cast("decimal(4,0)"))


def _durations(log: DataFrame, label: str) -> DataFrame:
    millis = (_millis("end_ts") - _millis("start_ts")).cast("double")
    return log.select(
        F.lit(label).alias("variant"),
        "run_id",
        "start_ts",
        "end_ts",
        (millis / 1000.0).alias("duration"),
    )


def run_durations(log_a: DataFrame, log_b: DataFrame, labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Run durations in seconds of two variants, one below the other."""
    return _durations(log_a, labels[0]).unionByName(_durations(log_b, labels[1]))


def rows_per_run(log_a: DataFrame, log_b: DataFrame, labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Rows inserted per run of two variants, one below the other."""
    def per_run(log: DataFrame, label: str) -> DataFrame:
        return log.groupBy("run_id").agg(
            F.lit(label).alias("variant"), F.sum("rows_inserted").cast("long").alias("total_rows_inserted")
        )

    return per_run(log_a, labels[0]).unionByName(per_run(log_b, labels[1]))


def compare_runs(log_a: DataFrame, log_b: DataFrame, labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Per run id the duration of both variants, their difference and the rows they inserted.

    Durations and row counts are joined on variant and run id, so that every row count enters the
    total once.
    """
    durations = run_durations(log_a, log_b, labels)
    counts = rows_per_run(log_a, log_b, labels)
    per_run = (
        durations.groupBy("variant", "run_id")
        .agg(F.max("duration").alias("duration"))
        .join(counts, ["variant", "run_id"], "left")
    )

    def of(label: str) -> Column:
        return F.max(F.when(F.col("variant") == label, F.col("duration")))

    return (
        per_run.groupBy("run_id")
        .agg(
            of(labels[0]).alias(f"{labels[0]}_duration"),
            of(labels[1]).alias(f"{labels[1]}_duration"),
            (of(labels[1]) - of(labels[0])).alias("duration_difference"),
            F.sum("total_rows_inserted").cast("long").alias("total_rows_inserted"),
        )
        .orderBy("run_id")
    )


def reconcile(src: DataFrame, tgt: DataFrame, columns: list[str], both_ways: bool = False) -> DataFrame:
    """Row counts of snapshot and active target, and the number of distinct snapshot rows that the
    active target lacks. ``both_ways`` adds the count of the opposite difference.

    Rows are compared by a hash of their contents, where NULLs are equal, as in a set difference. A
    first job compares digests of groups of hashes, one row per group and task; where they agree, both
    sides hold the same rows. Only rows of the other groups are exchanged, as hash and side.
    """
    def side(df: DataFrame, new: bool) -> DataFrame:
        return df.select(*columns, F.lit(new).alias("_new"))

    both = with_row_hash(side(src, True).unionByName(side(active(tgt), False)), columns=columns)
    group = digests.group_of(digests.bucket("row_hash"))
    named = F.concat_ws(":", F.col("_new").cast("string"), group.cast("string"))
    # At most one row per side and group.
    sums = digests.as_dict(digests.added_up(both.select(named.alias("bucket"), *digests.row_sums("row_hash")), F.col("bucket")))
    by_side = {new: {k.partition(":")[2]: v for k, v in sums.items() if k.startswith(str(new).lower())} for new in (True, False)}
    known = {"STAGING": sum(v[0] for v in by_side[True].values()), "TARGET": sum(v[0] for v in by_side[False].values())}
    groups = digests.differing_groups(by_side[True], by_side[False])
    wanted = ["DIFFERENCES", "DIFFERENCES_REVERSE"] if both_ways else ["DIFFERENCES"]
    rest = both.where(group.isin(groups) if groups else F.lit(False))
    contents = rest.groupBy("row_hash").agg(F.max("_new").alias("_new"), F.max(~F.col("_new")).alias("_old"))
    only = {"DIFFERENCES": F.col("_new") & ~F.col("_old"), "DIFFERENCES_REVERSE": F.col("_old") & ~F.col("_new")}
    totals = contents.agg(*[F.count_if(only[n]).alias(n) for n in wanted])
    counts = [F.struct(F.lit(n).alias("source"), F.lit(c).cast("long").alias("row_count")) for n, c in known.items()]
    counts += [F.struct(F.lit(n).alias("source"), F.col(n).alias("row_count")) for n in wanted]
    return totals.select(F.explode(F.array(*counts)).alias("r")).select("r.*")


def error_fields(objects: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Error rows (``error_object``) with some fields of the faulty row as columns: name -> type. A field
    that the row lacks, or that does not fit the type, is NULL. Fields are read by path; no text is parsed."""
    def path(name: str) -> str:
        quote = "'" if '"' in name else '"'
        if quote in name:
            raise ValueError(f"no path can name the field {name!r}")
        return f"$[{quote}{name}{quote}]"

    values = [F.try_variant_get("error_object", path(n), t).alias(n) for n, t in fields.items()]
    return objects.select(*[c for c in objects.columns if c != "error_object"], *values)


def check(name: str, df: DataFrame, value: Column, expected: Column | None = None, label: str = "value") -> DataFrame:
    """One check row: name, PASS or FAIL, details. ``value`` is an aggregate over ``df``; the check
    passes if ``expected`` (a predicate on the column ``value``) holds."""
    predicate = F.col("value") > 0 if expected is None else expected
    return df.agg(value.alias("value")).select(
        F.lit(name).alias("test_name"),
        F.when(predicate, "PASS").otherwise("FAIL").alias("status"),
        F.concat(F.lit(f"{label}="), F.coalesce(F.col("value"), F.lit(0)).cast("string")).alias("details"),
    )


def latest_run(log: DataFrame) -> DataFrame:
    """The row of the newest run (top-1 by run id)."""
    return log.orderBy(F.desc("run_id")).limit(1)


def count_where(df: DataFrame, predicate: Column, name: str = "total_rows") -> DataFrame:
    """Number of rows for which the predicate holds."""
    return df.where(predicate).agg(F.count(F.lit(1)).alias(name))


def history(tgt: DataFrame, pk: str) -> DataFrame:
    """All versions in order of key and start."""
    return tgt.orderBy(pk, "start_ts")
