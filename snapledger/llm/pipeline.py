"""The stages of the corpus pipeline.

Each takes and returns the columns of ``documents``; the last one returns pieces of sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import exact_dedup, langid, near_copies, packing, simhash, suffix_dedup


def in_training(parts: int = 5):
    """Documents that profiles are learned from: all but those with crc32 of the id divisible by ``parts``."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % parts != 0


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go: those that are NULL or have no letter."""
    return langid.without_unknown(docs, langid.learn_profiles(docs.filter(in_training())))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the kind and length of white space, the row with the smallest id stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked, directly or by way of others, the one with the smallest id stays. Linked are
    those whose fingerprints differ in 4 bits at most, and those whose sets of five-word shingles have a Jaccard
    similarity of 0.8 or more. Rows count one by one where ids are NULL or repeated."""
    return simhash.without_near_copies(docs, find=near_copies.near_copy_groups)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings go out of the texts, and documents that consist of them altogether go too."""
    carried = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    found = suffix_dedup.remove_repeats(docs, carried=carried).filter("n_removed < n_bytes or n_bytes = 0")
    columns = {c: F.col("rest").getField(c) for c in carried}
    columns["text"] = F.col("kept_text")
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; one row per piece of a document, with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: SQL has neither the fingerprints of the third stage nor the tokenizer of the last.
ORACLE_SQL = None
