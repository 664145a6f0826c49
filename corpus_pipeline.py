"""Training-data pipeline: documents -> kept, unique, clean, redacted, encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  Rows of one doc_id stay or go as each
operator states in its docstring; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import bbit_minhash, chunk_bpe, decontaminate, pii_boost, quality
from rentscope.llm.tables import kept, table

ORACLE_SQL = None  # hashing, alignment, boosted trees and BPE are no SQL; tests/llm has the brute-force versions


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or a certified cutoff rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays."""
    return bbit_minhash.keep_first(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also edited, go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; n_chars follows the text."""
    out = pii_boost.redacted(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' token ids (little-endian unsigned 32-bit) and their number."""
    import public_tokenizers
    encoded = chunk_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.withColumn("n_tokens", F.floor(F.length("ids") / 4).cast("long")).drop("text")


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", pii),
    ("BPE encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
