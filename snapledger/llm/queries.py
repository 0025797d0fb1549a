"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import bpe, decontaminate, embeddings, exact_dedup, hard_negatives, hilbert_shards, langid, packing, periodic, quality, simhash, suffix_dedup, warc
from snapledger.llm.common import written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % parts


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return found.drop("spans", "kept", "kept_text", "rest")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn_profiles(docs.filter(remainder(5) != 0))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode_corpus(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)
    return found.drop("ids", "decoded")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pieces.drop("ids")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(quality.with_statistics(table(spark, sf_dir, "documents")), "stats")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(stats.filter(remainder(4) != 2).join(labels, "doc_id"))
    scored = quality.score(stats, model)
    return scored.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(True)).alias("held_out"), "score", "predicted")


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``planted`` text: that of every tenth id goes on from some word with a period of its own."""
    tenth = docs.withColumn("h", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    sized = tenth.withColumn("words", words).withColumn("n", F.nullif(F.size("words"), F.lit(0)))
    sized = sized.withColumn("a", F.expr("cast(h div 10 % n as int)"))
    sized = sized.withColumn("p", F.expr("cast(1 + (n - a) div (3 + h div 10 % 8) as int)"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("cast(ceil((n - a) / p) as int)")))
    new = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return sized.withColumn("planted", F.when(F.col("n").isNull(), F.col("text")).otherwise(F.array_join(new, " ")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), "planted")
    order = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.array_max(order)).select(
        "rest.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "rest.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_simhash": op4_simhash,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_hilbert_shards": op9_hilbert_shards,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontaminate": op12_decontaminate,
    "op13_hard_negatives": op13_hard_negatives,
}
