"""Documents cleaned in order and packed: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.llm import langid, lines, packing, secrets, shingles
from geopulse.workspace import scratch


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled ones outside the held-out fold."""
    return langid.accepted(docs, langid.fit(docs.where(~langid.held_out())))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal to an earlier one go, and lines within an edit a ten characters of it, two at most; blank lines stay.

    Documents stay, with their new length.
    """
    return _measured(lines.deduplicate(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, stays of each group linked by a Jaccard index of five-word shingles of 0.8 or more.

    SimHash over the popcount grid proposes what it can prove, MinHash bands the rest, whole sets decide. Documents without an id stay.
    """
    gone = shingles.near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; documents stay, with their new length."""
    return _measured(secrets.redacted(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, placed in sequences."""
    return packing.pack(docs)


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language id", keep_identified),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]
#: Centroids and randomness tests are not stated in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
