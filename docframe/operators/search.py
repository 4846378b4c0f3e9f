"""Full-text search: BM25 over words.

``score_documents`` reads the documents: no index, and no shuffle of documents. ``SearchIndex`` is a stored postings table
(word, key, occurrences, length of the document) in buckets by a hash of the word and sorted by it: a search reads the row
groups of its words only, whatever the number of documents.

Scores follow the published formula (k1 = 1.2, b = 0.75, idf = ln(1 + (N - n + 0.5) / (n + 0.5))). Words are runs of
letters and digits in lower case. One pre-aggregated row of corpus statistics is broadcast; each document is scored in place.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K1, B = 1.2, 0.75


def query_words(query: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


def words_in(text: str) -> Column:
    """Words of a column; none where it is missing."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


@dataclass(frozen=True)
class SearchIndex:
    """Postings below ``path``: ``postings`` by bucket, and one row of corpus figures in ``corpus``."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    @classmethod
    def build(cls, df: DataFrame, key: str, text: str, path: str, buckets: int = 64) -> SearchIndex:
        """Words are counted before the shuffle by bucket; a frequent word's postings are dealt on by key, so no task holds them all."""
        rows = df.select(F.col(key).alias("key"), words_in(text).alias("words"))
        rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).write.parquet(f"{path}/corpus")
        counts = rows.select("key", F.size("words").alias("length"), F.explode("words").alias("word")).groupBy("key", "length", "word").agg(F.count(F.lit(1)).alias("times"))
        dealt = counts.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")).repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(4)))
        dealt.sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{path}/postings")
        return cls(df.sparkSession, path, key, buckets)

    def scores(self, query: str) -> DataFrame:
        """(key, score) of the documents with a word of the query."""
        words = query_words(query)
        corpus = self.spark.read.parquet(f"{self.path}/corpus")
        postings = self.spark.read.parquet(f"{self.path}/postings")
        asked = self.spark.range(1).select(F.explode(F.array(*map(F.lit, words)).cast("array<string>")).alias("word"))
        hit = sorted({r[0] for r in asked.select(F.pmod(F.xxhash64("word"), F.lit(self.buckets)).cast("int")).collect()})  # a row for each word of the query
        mine = postings.where(F.col("bucket").isin(hit) & F.col("word").isin(words))
        found = mine.groupBy("word").agg(F.count(F.lit(1)).alias("found"))
        idf = F.log(1 + (F.col("n") - F.col("found") + 0.5) / (F.col("found") + 0.5))
        known = mine.join(F.broadcast(found), "word").join(F.broadcast(corpus))  # a row for each word of the query; one row
        score = idf * F.col("times") * (K1 + 1) / (F.col("times") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
        return known.groupBy(F.col("key").alias(self.key)).agg(F.sum(score).alias("score"))


def _occurrences(word: str):
    return F.size(F.filter("__hits", lambda t: t == word))


def score_documents(df: DataFrame, query: str, text: str = "text", matching: bool = False) -> DataFrame:
    """``df`` with a column ``score``, 0 where no word of the query occurs; a missing text scores 0.

    ``matching`` keeps only documents with a word of the query, found by one pattern before any text is split.
    """
    words = query_words(query)
    if not words:
        scored = df.withColumn("score", F.lit(0.0))
        return scored.limit(0) if matching else scored
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    tokens = words_in(text)
    split = df.select(tokens.alias("__tokens"))
    stats = split.agg(F.count(F.lit(1)).alias("__n"), F.avg(F.size("__tokens")).alias("__mean"), *[F.count_if(F.array_contains("__tokens", w)).alias(f"__n{i}") for i, w in enumerate(words)])
    rows = df.where(lower.rlike(rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(words)})(?:$|[^\p{{L}}\p{{N}}])")) if matching else df
    counted = rows.withColumn("__tokens", tokens).withColumns({"__length": F.size("__tokens"), "__hits": F.filter("__tokens", lambda t: t.isin(words))}).drop("__tokens")
    both = counted.join(F.broadcast(stats))  # one row
    score = F.lit(0.0)
    for i, w in enumerate(words):
        idf = F.log(1 + (F.col("__n") - F.col(f"__n{i}") + 0.5) / (F.col(f"__n{i}") + 0.5))
        f = _occurrences(w).cast("double")
        score = score + F.when(f > 0, idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__length") / F.col("__mean")))).otherwise(0.0)
    return both.withColumn("score", score).select(*df.columns, "score")
