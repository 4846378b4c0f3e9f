"""Language-model scores by stupid backoff (Brants et al., 2007), computed over n-gram count tables partitioned by hash.

An n-gram counted ``min_count`` times or more scores log(count / count of its first n - 1 words); a rarer one backs off to
log(alpha) plus the score of the shorter one; a word alone scores log(count / total). Scores are summed per document.
Counts cover all documents.

Documents are dealt to groups by a hash, a few megabytes of text each. A group's exploded n-grams are first counted inside
the group, so a common n-gram leaves it once, however often it occurs. These partial tables are cut by ranges of the
64-bit n-gram hash and shuffled by range: there the ranges of all groups are joined into the count table of that hash
range, and every group gets back the corpus counts of just its own n-grams. Last they are joined to the group's exploded
n-grams and summed per document. From three words on, n-grams are only asked for if both their shorter parts reach
``min_count``; no other can reach it. A row holds one group's part of one range in columns, at most one row for each of
its n-grams; there are 64 ranges, more beyond 1 GB of text, so that no task holds more than some megabytes of either, and
no key gathers rows: a document's group does not depend on its words.

Words are runs without ASCII white space in lower case, told apart by 64-bit hashes. Defined results: a row for each row
of the input, also for repeated ones; null and empty texts have no words and score 0; a null doc_id is no different; an
empty table gives no rows; a text of any length is scored whole, in one group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import read_table, stage

ORDER = 3
MIN_COUNT = 2
ALPHA = 0.4
GROUP_BYTES = 6_000_000
RANGE_BYTES = 16_000_000
LEAST_RANGES = 64


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, compressed with the bytes of equal weight next to each other."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one after the other, and the number of words of each text."""
    from xxhash import xxh64_intdigest

    known: dict[bytes, int] = {}
    ids, lengths = [], np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        words = (t or "").lower().encode("utf-8", "surrogatepass").split()
        lengths[k] = len(words)
        for w in words:
            ids.append(known.setdefault(w, len(known)))
    table = np.fromiter((xxh64_intdigest(w) for w in known), np.uint64, len(known))
    return table[np.array(ids, np.int64)] if ids else table, lengths


def ngrams(words: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For each n up to ``order`` the hashes of the n-grams that begin at each word; 0 where the text ends before."""
    left = np.repeat(lengths, lengths) - (np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths))
    out = [np.where(words == 0, np.uint64(1), words)]
    for n in range(2, order + 1):
        longer = np.zeros_like(words)
        fits = np.flatnonzero(left >= n)
        mixed = out[-1][fits] * np.uint64(0x9E3779B97F4A7C15) ^ (words[fits + n - 1] + np.uint64(n)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        longer[fits] = np.maximum(mixed ^ (mixed >> np.uint64(32)), np.uint64(1))
        out.append(longer)
    return out


def cuts(table: np.ndarray, ranges: int) -> list[int]:
    """Where each hash range begins in a sorted table; the end is last."""
    starts = np.array([(k << 64) // ranges for k in range(ranges)], np.uint64)
    return [*np.searchsorted(table, starts).tolist(), len(table)]


def corpus_counts(grams: list[np.ndarray], answers: pd.DataFrame, upto: int, ranges: int, min_count: int) -> list[np.ndarray]:
    """For each n up to ``upto`` the corpus counts of the n-grams that begin at each word; 0 where none was asked for."""
    out: list[np.ndarray] = []
    answers = answers.sort_values("key")
    keys = answers["key"].to_numpy() // ranges
    for n in range(upto):
        mine = [unpacked(x, np.uint64) for x in answers["totals"][keys == n]]
        asked = candidates(grams, out, n, min_count)
        full = np.zeros(len(asked))
        if mine:
            full[asked] = np.concatenate(mine)[np.searchsorted(np.unique(grams[n][asked]), grams[n][asked])]
        out.append(full)
    return out


def candidates(grams: list[np.ndarray], counts: list[np.ndarray], n: int, min_count: int) -> np.ndarray:
    """Where an (n + 1)-gram begins that may reach ``min_count``; up to two words every one is counted."""
    exists = grams[n] > 0
    if n < 2:
        return exists
    before = counts[n - 1]
    return exists & (before >= min_count) & (np.append(before[1:], 0) >= min_count)


def requests(group: pd.DataFrame, answers: pd.DataFrame | None, sizes: list[int], ranges: int, min_count: int) -> pd.DataFrame:
    """The group's partial count tables for n-grams of ``sizes``, a row for each n and hash range in use."""
    rows = []
    grams = ngrams(*hashed_words(group["text"].tolist()), max(sizes))
    counts = [] if answers is None else corpus_counts(grams, answers, max(sizes) - 1, ranges, min_count)
    for n in sizes:
        table, local = np.unique(grams[n - 1][candidates(grams, counts, n - 1, min_count)], return_counts=True)
        at = cuts(table, ranges)
        rows += [((n - 1) * ranges + k, int(group["g"].iloc[0]), packed(np.diff(table[a:b], prepend=np.uint64(0))), packed(local[a:b].astype(np.uint32))) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b]
    return pd.DataFrame(rows, columns=["key", "g", "grams", "counts"])


def replies(rows: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Joins the partial tables of one n and hash range; each group gets the corpus counts of its n-grams, in its order."""
    tables = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in rows["grams"]]
    _, where = np.unique(np.concatenate(tables), return_inverse=True)
    totals = np.bincount(where, np.concatenate([unpacked(x, np.uint32) for x in rows["counts"]])).astype(np.uint64)
    ends = np.cumsum([len(t) for t in tables])
    key = int(rows["key"].iloc[0])
    words = np.zeros(len(rows), np.int64)
    words[0] = totals.sum() if key < ranges else 0  # n = 1: this range's share of all tokens
    return pd.DataFrame({"g": rows["g"], "key": rows["key"], "totals": [packed(part) for part in np.split(totals[where], ends[:-1])], "n_words": words})


def score_group(docs: pd.DataFrame, answers: pd.DataFrame, order: int, ranges: int, total: int, min_count: int, alpha: float) -> pd.DataFrame:
    words, lengths = hashed_words(docs["text"].tolist())
    grams = ngrams(words, lengths, order)
    counts = corpus_counts(grams, answers, order, ranges, min_count)
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    score = np.log(counts[0] / max(1, total)) if len(words) else np.zeros(0)
    for n in range(2, order + 1):
        at = np.flatnonzero(place >= n - 1)
        many, context = counts[n - 1][at - n + 1], counts[n - 2][at - n + 1]
        hit = many >= min_count
        score[at] = np.where(hit, np.log(np.where(hit, many, 1)) - np.log(np.where(hit, context, 1)), score[at] + math.log(alpha))
    sums = np.bincount(np.repeat(np.arange(len(docs)), lengths), score, len(docs))
    return pd.DataFrame({"doc_id": docs["doc_id"], "n_tokens": lengths, "score": np.round(sums, 3)})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, min_count: int = MIN_COUNT, alpha: float = ALPHA, group_bytes: int = GROUP_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, score) for each row. ``min_count`` is 1 at least."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(size // group_bytes + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = max(LEAST_RANGES, int(size // range_bytes + 1))
    dealt = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.lit("group"), id_col, text_col), F.lit(groups)).cast("int").alias("g"))

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        return replies(rows, ranges)

    def ask_for(sizes: list[int], answered: DataFrame | None) -> DataFrame:
        columns = "key long, g int, grams binary, counts binary"
        if answered is None:
            return dealt.groupBy("g").applyInPandas(lambda group: requests(group, None, sizes, ranges, min_count), columns)
        return dealt.groupBy("g").cogroup(answered.groupBy("g")).applyInPandas(lambda group, answers: requests(group, answers, sizes, ranges, min_count), columns)

    answered = None
    for sizes in ([1, 2][:order], *([n] for n in range(3, order + 1))):
        found = ask_for(sizes, answered).groupBy("key").applyInPandas(answer, "g int, key long, totals binary, n_words long")
        found = stage(found, "counts")
        answered = found if answered is None else answered.union(found)
    total = answered.agg(F.sum("n_words")).first()[0] or 0

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return score_group(left, right, order, ranges, total, min_count, alpha)

    return dealt.groupBy("g").cogroup(answered.groupBy("g")).applyInPandas(score, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, score double")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
t AS (SELECT doc_id, w, i, lag(w, 1) OVER v AS b, lag(w, 2) OVER v AS a FROM x WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
u AS (SELECT w, count(*) AS n FROM t GROUP BY w),
p AS (SELECT b, w, count(*) AS n FROM t WHERE i > 1 GROUP BY b, w),
q AS (SELECT a, b, w, count(*) AS n FROM t WHERE i > 2 GROUP BY a, b, w),
s AS (SELECT t.doc_id, CASE WHEN t.i > 2 AND q.n >= 2 THEN ln(q.n) - ln(ab.n)
        ELSE CASE WHEN t.i > 2 THEN ln(0.4) ELSE 0 END + CASE WHEN t.i > 1 AND p.n >= 2 THEN ln(p.n) - ln(ub.n)
        ELSE CASE WHEN t.i > 1 THEN ln(0.4) ELSE 0 END + ln(u.n) - ln((SELECT count(*) FROM t)) END END AS score
      FROM t JOIN u ON u.w = t.w LEFT JOIN p ON p.b = t.b AND p.w = t.w LEFT JOIN q ON q.a = t.a AND q.b = t.b AND q.w = t.w
      LEFT JOIN p ab ON ab.b = t.a AND ab.w = t.b LEFT JOIN u ub ON ub.w = t.b)
SELECT d.doc_id, CAST(any_value(len(ws)) AS BIGINT) AS n_tokens, round(coalesce(sum(s.score), 0), 3) AS score
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id"""

QUERIES = {"op8_lm_score": op8_lm_score}
ORACLE_SQL = {"op8_lm_score": SQL}
