"""A training-data pipeline over ``documents``: each stage takes (spark, docs, sf_dir) and returns what it keeps.

All stages but the last return the columns of documents. Between stages the rows are written as Parquet to the folder that
all executors share and read again, so a lost executor repeats one stage at most; a stage's rows go when the next one's are
written, the last one's with the application.

Defined results, for every stage: an empty table gives no rows; texts of any length are processed whole; columns beyond
doc_id and text pass through whatever their names, nulls included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm import bpe, decontamination, pii, quality, simhash
from docframe.llm.common import discard, read_table, small_batches, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. Null and empty texts are judged by their (equal) statistics, repeated rows alike; a null doc_id never trains."""
    small_batches(spark)
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies stays: the smallest doc_id, null last.

    Links are those of op9's fingerprints (two bits at most, by ball hashing) and beyond them those of texts whose five-word
    shingles have a similarity of 0.8 or more. Null and empty texts are copies of each other; of repeated rows one stays.
    """
    small_batches(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go. Null and empty texts stay; repeated rows go or stay together, by doc_id (null too) and text."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind; n_chars follows. Null and empty texts stay as they are; repeated rows are changed alike."""
    small_batches(spark)
    out = docs.withColumn("text", pii.redact_column(F.col("text"), pii.fit(docs)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and whether the ids decode to the text. A row for each document; null and empty texts have no ids."""
    small_batches(spark)
    coded = docs.select("doc_id", bpe.checked_column(F.col("text"), *bpe.vocabulary()).alias("c")).select("doc_id", "c.*")
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decodes")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    last = None
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    return docs


QUERIES = {"pipeline": run}
#: The fitted and hashed stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None
